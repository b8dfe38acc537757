"""Secrets by rules, with a trigram inverted index to find the documents worth a look.

A Boolean query over trigrams is derived from the pattern of every rule. The index holds, for
each trigram that some query asks for, the documents it occurs in (in lower case, so it serves
rules that ignore case as well). A rule's postings are intersected and united as its query says,
and only the remaining candidates are searched by its pattern. A rule without a mandatory
trigram searches every document. All of it is built from Spark's own functions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm import trigrams
from fareloom.llm.common import given_id, ordered_id, settle


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and without overlaps, are secrets if ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    base: bool = False
    group: int = 0
    least: int = 0


#: Base rules in the order of their report, then added ones. A run with a least length
#: that nothing may follow is written with that length; what matches is the same.
RULES = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", True, 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}", True),
    Rule("hex", r"[0-9a-f]{16,}", True),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_api", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("url_login", r"://[^\x00-\x20:@/]+:[^\x00-\x20:@/]+@"),
)


#: Spans of a text that are gathered in one list before they join the others.
TOGETHER = 256


def index(docs: DataFrame, wanted: list[str]) -> DataFrame:
    """Postings (trigram, oid, text_hash) of the ``wanted`` trigrams."""
    low = docs.select("oid", "text_hash", F.lower("text").alias("low"))
    held = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in wanted])
    return low.select("oid", "text_hash", F.explode(F.array_compact(held)).alias("trigram"))


def candidates(postings: DataFrame, queries: dict[str, trigrams.Query]) -> DataFrame:
    """(oid, text_hash, rules): the rules whose query a document satisfies, for those with any."""
    wanted = sorted({t for q in queries.values() for s in q for t in s})
    number = {t: i for i, t in enumerate(wanted)}
    words = range((len(wanted) + 62) // 63)
    at = F.create_map(*[F.lit(x) for t, i in number.items() for x in (t, i)])[F.col("trigram")]
    bit = F.expr("shiftleft(1L, n % 63)")
    held = postings.withColumn("n", at).groupBy("oid", "text_hash")
    bits = held.agg(*[F.bit_or(F.when(F.floor(F.col("n") / 63) == w, bit).otherwise(F.lit(0).cast("long"))).alias(f"bits{w}") for w in words])

    def whole(trigrams_: frozenset[str]) -> Column:
        masks = [sum(1 << number[t] % 63 for t in trigrams_ if number[t] // 63 == w) for w in words]
        return reduce(Column.__and__, [F.col(f"bits{w}").bitwiseAND(m) == m for w, m in zip(words, masks)])

    holds = [F.when(reduce(Column.__or__, map(whole, q)), F.lit(kind)) for kind, q in queries.items()]
    found = bits.select("oid", "text_hash", F.array_compact(F.array(*holds)).alias("rules"))
    return found.where(F.size("rules") > 0)


def _spans(rule: Rule, number: int) -> Column:
    """Spans of a rule in ``text``: the lengths of what lies between and in its matches add up to their places."""
    pattern = "r'" + rule.pattern.replace("'", "\\x27") + "'"
    parts = (
        f"zip_with(regexp_extract_all(text, {pattern}, 0), regexp_extract_all(text, {pattern}, {rule.group}), (m, g) -> struct(m, g))"
    )
    span = f"struct(a.at + length(x.gap) AS start, {number} AS number, a.at + length(x.gap) + length(x.p.m) AS end)"
    spans = "array<struct<start:bigint,number:int,end:bigint>>"
    # An append copies its list, so spans gather in lists of TOGETHER, and those in one list of lists.
    return F.expr(
        f"""aggregate(
          transform(
            array(filter(zip_with(split(text, {pattern}, -1), {parts}, (gap, p) -> struct(gap, p)), x -> x.p IS NOT NULL)),
            all -> transform(sequence(0, size(all) div {TOGETHER}), n -> slice(all, n * {TOGETHER} + 1, {TOGETHER})))[0],
          struct(0L AS at, CAST(array() AS array<{spans}>) AS out),
          (done, some) -> transform(
            array(aggregate(
              some,
              struct(done.at AS at, CAST(array() AS {spans}) AS out),
              (a, x) -> struct(
                a.at + length(x.gap) + length(x.p.m) AS at,
                if(length(x.p.g) >= {rule.least}, array_append(a.out, {span}), a.out) AS out))),
            r -> struct(r.at AS at, array_append(done.out, r.out) AS out))[0],
          done -> flatten(done.out))"""
    )


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id and spans (kind, start, end, base), by start, then kind.

    Places are code points, the end exclusive. A missing or empty text has no spans. Every rule
    reports on its own, so spans of two rules may overlap.
    """
    rows = docs.select(
        ordered_id(id_col).alias("oid"),
        F.xxhash64(text_col).alias("text_hash"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    asked = {r.kind: trigrams.query(r.pattern) for r in rules}
    queries = {kind: q for kind, q in asked.items() if q}
    wanted = sorted({t for q in queries.values() for s in q for t in s})
    found = candidates(settle(index(rows, wanted), "postings"), queries)
    looked = rows.join(settle(found, "candidates"), ["oid", "text_hash"], "left")
    none = F.expr("CAST(array() AS array<struct<start:bigint,number:int,end:bigint>>)")
    parts = []
    for number, rule in enumerate(rules):
        worth = F.array_contains("rules", rule.kind) if rule.kind in queries else F.col("text").rlike(rule.pattern)
        parts.append(F.when(worth, _spans(rule, number)).otherwise(none))
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    base = F.array(*[F.lit(r.base) for r in rules])
    spans = F.transform(
        F.array_sort(F.concat(*parts)),
        lambda s: F.struct(F.get(kinds, s["number"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.get(base, s["number"]).alias("base")),
    )
    return looked.select(given_id("oid").alias("doc_id"), spans.alias("spans"))
