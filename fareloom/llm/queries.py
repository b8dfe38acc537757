"""The registered query of every operator of this package, and the SQL that checks it.

Each query applies its operator to a whole table with production parameters and derives the
columns of its contract from the operator's own output.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm import (
    binary_records,
    bpe,
    exact_dedup,
    hard_negatives,
    language_id,
    mixing,
    neighbours,
    pii,
    prefix_trie,
    quality,
    secret_scan,
    simhash,
    substring_dedup,
)
from fareloom.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]

#: Where the vocabulary files of public tokenizers are; unset, the installed package has them.
TOKENIZERS = os.environ.get("FARELOOM_TOKENIZERS", "")

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
n AS (SELECT doc_id, w, len(w) AS n FROM d),
s AS (SELECT doc_id, w, unnest(range(n - 49)) AS p FROM n WHERE n >= 50),
k AS (SELECT doc_id, p, md5(array_to_string(w[p + 1:p + 50], ' ')) AS k FROM s),
f AS (SELECT k, min(doc_id) AS lo FROM k GROUP BY k),
g AS (SELECT doc_id, list_distinct(flatten(list(range(p, p + 50)))) AS gone
      FROM k JOIN f USING (k) WHERE lo < doc_id GROUP BY doc_id)
SELECT n.doc_id, n AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(coalesce(array_to_string(
         list_transform(list_filter(range(n), lambda i: NOT list_contains(coalesce(gone, []), i)), lambda i: w[i + 1]),
         ' '), '')) AS kept_sha256
FROM n LEFT JOIN g USING (doc_id)
"""


@query("op1_substring_dedup", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup_substrings(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def tokenizer_file(name: str) -> bytes:
    """A vocabulary file, read where the driver runs; executors get it from there."""
    if TOKENIZERS:
        path = os.path.join(TOKENIZERS, name)
    else:
        import public_tokenizers

        path = public_tokenizers.path(name)
    with open(path, "rb") as f:
        return f.read()


@query("op2_binary_token_records")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokenizer_file("byte_bpe_50k.json").decode()
    found = binary_records.round_trip(read(spark, sf_dir, "documents"), vocabulary, end_id=0)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op3_simhash_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(read(spark, sf_dir, "documents"))


def span_columns(kinds: dict[str, str]) -> list:
    """Counts of base spans per kind (name of the column: kind), their digest, and all spans as text."""
    text = "transform(filter(spans, s -> {0}), s -> concat_ws(':', s.kind, s.start, s.end))"
    return [
        *[F.expr(f"CAST(size(filter(spans, s -> s.base AND s.kind = '{kind}')) AS BIGINT)").alias(name) for name, kind in kinds.items()],
        F.expr(f"sha2(CAST(concat_ws(',', {text.format('s.base')}) AS BINARY), 256)").alias("base_sha256"),
        F.expr(f"concat_ws(',', {text.format('true')})").alias("spans"),
    ]


def _rule_sql(rule: secret_scan.Rule, number: int) -> str:
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    return f"""
  SELECT doc_id, {number} AS number, '{rule.kind}' AS kind, {str(rule.base).lower()} AS base, upto - length(m) AS b, upto AS e
  FROM (SELECT doc_id, m, g, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT AS upto
        FROM (SELECT doc_id, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(gs) AS g, unnest(gaps[1:len(ms)]) AS gap
              FROM (SELECT doc_id, regexp_extract_all(text, {pattern}) AS ms, regexp_extract_all(text, {pattern}, {rule.group}) AS gs,
                           string_split_regex(text, {pattern}) AS gaps FROM d)))
  WHERE length(g) >= {rule.least}"""


OP4_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(_rule_sql(rule, n) for n, rule in enumerate(secret_scan.RULES))}),
t AS (SELECT doc_id, kind, base, concat(kind, ':', b, ':', e) AS span, b, number FROM s)
SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
       count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY b, number) FILTER (base), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY b, number), '') AS spans
FROM d LEFT JOIN t USING (doc_id) GROUP BY doc_id
"""


@query("op4_secret_scan", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf_dir, "documents"))
    return found.select("doc_id", *span_columns({"n_assign": "assign", "n_access": "access", "n_hex": "hex"}))


def byte_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@query("op5_byte_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = tokenizer_file("byte_bpe_multi_50k.tiktoken")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, ranks, byte_pattern(), decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op6_source_mixing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, sources = mixing.mix(read(spark, sf_dir, "documents"), F.array("source"))
    rows = mixed.select("doc_id", F.element_at("_fl_pattern", 1).alias("member"), F.col("_fl_size").alias("size"), "_fl_copies")
    taken = (F.col("size") * F.col("_fl_copies")).alias("taken")
    return rows.join(sources, "member").select("doc_id", "size", "source_size", "target", taken)


@query("op7_personal_data")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = pii.find(docs, pii.learn(docs))
    return found.select("doc_id", *span_columns({f"n_{kind}": kind for kind in pii.KINDS}))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM d WINDOW same AS (PARTITION BY text_sha256)
"""


@query("op8_exact_dedup", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.flags(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language_id.learn(docs.where(~language_id.held_out("doc_id")))
    found = language_id.classify(docs, model)
    return found.select("doc_id", language_id.held_out("doc_id").alias("held_out"), "lang_pred", "score", "margin", "rejected")


@query("op10_nearest_neighbours")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


OP11_SQL = r"""
WITH crc AS (
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce(range(8), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS v
        FROM range(256) r(i))),
o AS (
  SELECT conv_id AS c, turn, coalesce(text, '') AS text,
         sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS d
  FROM conversations WHERE conv_id IS NOT NULL),
t AS (
  SELECT c, d, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w,
         row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, d) AS r
  FROM o),
k AS (
  SELECT c, c - c % 20 AS b,
         xor(list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
                         lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM t), crc),
u AS (
  SELECT k.c, 0 AS part, t.r, t.d, t.w FROM k JOIN t ON t.c = k.b WHERE t.r <= h
  UNION ALL SELECT k.c, 1, t.r, t.d, t.w FROM k JOIN t ON t.c = k.c WHERE t.r > h),
s AS (SELECT c, list(d ORDER BY part, r) AS ds, list(w ORDER BY part, r) AS ws FROM u GROUP BY c),
p AS (
  SELECT c, ds, ws, unnest(range(len(ds) + 1)) AS depth
  FROM (SELECT k.c, coalesce(ds, []) AS ds, coalesce(ws, []) AS ws FROM k LEFT JOIN s USING (c))),
n AS (
  SELECT ds[1:depth] AS key, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(coalesce(ws[depth], 0)) AS w,
         count(*) FILTER (len(ds) = depth) AS n_ends, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(ds) = depth) AS ends
  FROM p GROUP BY ALL),
e AS (SELECT key, depth, unnest(range(depth + 1)) AS up, n_ends = n_convs AS leaf, (n_convs - 1) * w AS saved FROM n),
g AS (
  SELECT key[1:up] AS key, up AS depth, count(*) FILTER (up = depth - 1) AS n_children, count(*) FILTER (leaf) AS n_leaves,
         sum(saved)::BIGINT AS saved_tokens
  FROM e GROUP BY key[1:up], up)
SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens,
       sha256(coalesce(n.ends, '')) AS ends_sha256
FROM n JOIN g USING (key, depth) LEFT JOIN n m ON m.depth = n.depth - 1 AND m.key = n.key[1:n.depth - 1]
"""


@query("op11_prefix_trie", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = prefix_trie.conversation_turns(read(spark, sf_dir, "conversations"))
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % 4
    return prefix_trie.trie(prefix_trie.spliced(ranked, F.col("conv") - F.col("conv") % 20, head, 3))


@query("op12_quality_classifier")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, kept = read(spark, sf_dir, "documents"), quality.held_out("doc_id")
    model = quality.learn(docs.where(~kept), read(spark, sf_dir, "labels").where(~kept))
    found = quality.score(docs, model)
    return found.select("doc_id", kept.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


OP13_SQL = """
WITH e AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS a, b.id AS b, a.l = b.l AS same, list_dot_product(a.v, b.v)::BIGINT AS s
  FROM e a JOIN e b ON a.id % 50 = 0 AND a.id <> b.id),
p AS (SELECT a, b, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, (row_number() OVER near)::INTEGER AS rank, n.b AS negative_id,
       p.s AS positive_score, n.s AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 50 * p.s <= 100 * n.s AND 100 * n.s <= 95 * p.s
WINDOW near AS (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b)
QUALIFY row_number() OVER near <= 3
"""


@query("op13_hard_negatives", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)
