"""The prefix trie of conversations, summed up by bands of depth.

A node is a distinct sequence of first turns; conversations that start with it are its members. A node is
known by the digest of its parent's digest, role and text, chained from the root, so equal prefixes
of any two conversations meet in one row without comparing texts. Texts are digested before anything is
shuffled.

Sums over subtrees. Levels are cut into bands of ``BAND``. A node hands what it has to itself and to
its ancestors inside its band only; one aggregation does that for all bands. Then, from the deepest
band up, the completed totals of a band's top nodes are handed to the at most ``BAND`` ancestors in
the band above. A row is thus never copied more than ``BAND`` + 1 times, and there are as many
rounds as bands, not as levels. Prefixes are made distinct before they are copied, with partial counts
before the shuffle, so a turn that a third of all conversations start with is one row.

Turns of one conversation are read in order by one task, which holds one band of digests at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import WORD, settle, ship

BAND = 16
#: Ids that are joined to one text before they are shuffled to their node.
TOGETHER = 4096
ROOT = bytes(16)


def turn_digest(role: str, text: str) -> Column:
    """SHA-256 of role and text; the role's length keeps the two apart."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))


def words(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def _chain(band: int):
    """For rows sorted by conversation and place, a row per prefix: its digest, and those of its ancestors that it reports to.

    A row without a turn (``turn`` null) opens each conversation and is the root's.
    """

    names = ["conv", "depth", "node", "words", "last", "up"]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.bool_(), pa.list_(pa.binary())]

    def out(rows: list[list], last: list[bool]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        columns.insert(4, last)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        depth, node, above, rows = 0, ROOT, [], []
        for batch in batches:
            for conv, turn, n in zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "words"))):
                if turn is None:
                    depth, node, above = 0, ROOT, []
                else:
                    above = [node] if depth % band == 0 else [*above, node]
                    node, depth = hashlib.sha256(node + turn).digest()[:16], depth + 1
                rows.append([conv, depth, node, n, above])
            # Whether a prefix is its conversation's last shows in the row after it.
            if len(rows) > 1:
                yield out(rows[:-1], [r[1] == 0 for r in rows[1:]])
                rows = rows[-1:]
        if rows:
            yield out(rows, [True])

    return run


def prefixes(turns: DataFrame, band: int = BAND) -> DataFrame:
    """(conv, depth, node, words, last, up): a row per conversation and prefix, the empty one included.

    ``turns`` holds (conv, place, turn, words), with a row (conv, null, null, 0) for every conversation; ``place``
    is any ordered type, distinct within a conversation. ``up`` lists the digests from the top of the band down to
    the parent; of a band's top node, the whole band above.
    """
    ship(turns.sparkSession)
    ordered = turns.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("place"))
    return ordered.select("conv", "turn", "words").mapInArrow(_chain(band), "conv long, depth long, node binary, words long, last boolean, up array<binary>")


def _ends(rows: DataFrame) -> DataFrame:
    """(node, sha256) over the decimal ids, in order and joined by commas, of the conversations that end at a node.

    Ids are joined to texts of ``TOGETHER`` where they are sorted, spread over tasks by node and id, so
    what meets at a node is few rows; the checksum then reads these one after the other.
    """

    def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.binary()), ("first", pa.int64()), ("text", pa.string())])
        node, held = None, []
        for batch in batches:
            done = []
            for n, c in zip(batch.column("node").to_pylist(), batch.column("conv").to_pylist()):
                if held and (n != node or len(held) == TOGETHER):
                    done.append((node, held[0], ",".join(map(str, held))))
                    held = []
                node = n
                held.append(c)
            if done:
                yield batch_of(done, schema)
        if held:
            yield batch_of([(node, held[0], ",".join(map(str, held)))], schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
        node, seen = None, None
        for batch in batches:
            done = []
            for n, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist()):
                if n == node:
                    seen.update(b",")
                else:
                    if seen:
                        done.append((node, seen.hexdigest()))
                    node, seen = n, hashlib.sha256()
                seen.update(text.encode())
            if done:
                yield batch_of(done, schema)
        if seen:
            yield batch_of([(node, seen.hexdigest())], schema)

    last = rows.where("last").select("node", "conv")
    dealt = last.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv")
    joined = dealt.mapInArrow(join, "node binary, first long, text string")
    return joined.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends_sha256 string")


def subtree_sums(nodes: DataFrame, band: int = BAND) -> DataFrame:
    """(node, n_children, n_leaves, saved_tokens) for every row of (node, depth, up, leaf, saved)."""
    top = F.col("depth") % band == 0
    # A top node reports to its own band by itself; the band above hears of it only that it is a child.
    heard = F.when(top, F.slice("up", -1, 1)).otherwise(F.col("up"))
    heard = F.when(F.size("up") == 0, F.array().cast("array<binary>")).otherwise(heard)
    share = F.when(top, 0).otherwise(1)
    parent = F.try_element_at("up", F.lit(-1))
    told = nodes.select(
        F.explode(F.concat(F.array("node"), heard)).alias("to"), "node", parent.alias("parent"), share.alias("share"), "leaf", "saved"
    )
    own = F.col("to") == F.col("node")
    part = F.when(own, 1).otherwise(F.col("share"))
    told = told.select(
        F.col("to").alias("node"),
        F.when(F.col("to") == F.col("parent"), 1).otherwise(0).alias("child"),
        (F.col("leaf") * part).alias("leaf"),
        (F.col("saved") * part).alias("saved"),
    )
    sums = [F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens")]
    partial = settle(told.groupBy("node").agg(F.sum("child").alias("n_children"), *sums), "band-sums")
    tops = nodes.where(top & (F.col("depth") > 0)).select("node", "depth", "up")
    tops = settle(tops.join(partial, "node").select("node", "depth", "up", "n_leaves", "saved_tokens"), "band-tops")
    deepest = tops.agg(F.max("depth")).first()[0] or 0
    below, inherited = None, None
    for depth in range(deepest, 0, -band):
        now = tops.where(F.col("depth") == depth).select("node", "up", "n_leaves", "saved_tokens")
        if below is not None:
            more = below.select("node", F.col("n_leaves").alias("l"), F.col("saved_tokens").alias("s"))
            total = [(F.col(c) + F.coalesce(m, F.lit(0))).alias(c) for c, m in (("n_leaves", "l"), ("saved_tokens", "s"))]
            now = now.join(more, "node", "left").select("up", *total)
        told = now.select(F.explode("up").alias("node"), F.col("n_leaves").alias("leaf"), F.col("saved_tokens").alias("saved"))
        below = settle(told.groupBy("node").agg(*sums), "band-below")
        inherited = below if inherited is None else inherited.union(below)
    if inherited is None:
        return partial
    # Each node has one band below it, so it is in at most one of these tables.
    more = inherited.select("node", F.col("n_leaves").alias("l"), F.col("saved_tokens").alias("s"))
    total = [(F.col(c) + F.coalesce(m, F.lit(0))).alias(c) for c, m in (("n_leaves", "l"), ("saved_tokens", "s"))]
    return partial.join(more, "node", "left").select("node", "n_children", *total)


def trie(turns: DataFrame, band: int = BAND) -> DataFrame:
    """A row per node of the trie over ``turns`` as in ``prefixes``.

    conv_id (the smallest member), depth, parent_conv_id (the parent's; null at the root), n_convs (members), n_children,
    n_leaves (nodes without children in the subtree, the node included), saved_tokens (over the subtree, members
    beyond the first times the words of the node's last text), ends_sha256 (of the members that end here).
    No conversations, no rows, not even a root.
    """
    rows = settle(prefixes(turns, band), "prefixes")
    members = [F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(F.col("last").cast("long")).alias("n_ends")]
    nodes = settle(rows.groupBy("node", "depth", "words", "up").agg(*members), "trie-nodes")
    leaf = (F.col("n_ends") == F.col("n_convs")).cast("long")
    counted = nodes.select("node", "depth", "up", leaf.alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    sums = subtree_sums(counted, band)
    ends = _ends(rows)
    none = F.sha2(F.lit("").cast("binary"), 256)
    full = nodes.select("node", F.try_element_at("up", F.lit(-1)).alias("parent"), "conv_id", "depth", "n_convs").join(sums, "node").join(ends, "node", "left")
    # Stored, so that the next join deals out both of its sides and can split a parent of very many children.
    full = settle(full.withColumn("ends_sha256", F.coalesce("ends_sha256", none)), "trie-sums")
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return full.join(above, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def conversation_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, rank, turn, words) per row: turns numbered from 1 in the order of ``turn`` (null first).

    Missing roles and texts are empty. Turns of equal number follow the order of their digests. Rows
    without a conversation take no part.
    """
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("at"), turn_digest(role, text).alias("turn"), words(text).alias("words")
    )
    rank = F.row_number().over(Window.partitionBy("conv").orderBy(F.asc_nulls_first("at"), "turn"))
    return rows.select("conv", rank.cast("long").alias("rank"), "turn", "words")


def spliced(ranked: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """Turns for ``prefixes``, each conversation rebuilt from the head of another.

    Of (conv, rank, turn, words): the first ``head`` (at most ``most``) turns of conversation ``base``,
    both of them expressions over ``conv``, then its own turns after the first ``head``.
    """
    ranked = settle(ranked, "ranked-turns")
    convs = ranked.where("rank = 1").select("conv", base.alias("base"), head.alias("head"))
    own = ranked.where(F.col("rank") > head).select("conv", F.struct(F.lit(1).alias("part"), "rank").alias("place"), "turn", "words")
    heads = ranked.where(F.col("rank") <= most).select(F.col("conv").alias("base"), "rank", "turn", "words")
    given = convs.join(heads, "base").where("rank <= head").select("conv", F.struct(F.lit(0).alias("part"), "rank").alias("place"), "turn", "words")
    empty = [F.lit(None).cast(own.schema["place"].dataType).alias("place"), F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("long").alias("words")]
    return own.union(given).union(convs.select("conv", *empty))
