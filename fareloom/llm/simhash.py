"""SimHash near-duplicates by anchor points of a covering code.

A fingerprint has 64 bits, from 3-word shingles. Two fingerprints link if at most
``threshold`` (3) bits differ. Anchors are the words of a covering code. A fingerprint is sent
to every anchor within the covering radius plus the threshold, so two that link meet at
the anchor nearest to either of them, and only fingerprints at one anchor are compared.

One code over all 64 bits would need thousands of anchors per fingerprint. If 3 bits
differ, one 32-bit half differs in at most 1, so each half has its own code: the Hamming
code of 31 bits, which covers with radius 1, and one bit more. Radius 1 plus a threshold of 1
gives at most 17 anchors per half. The set of anchors depends only on the half's syndrome.

Equal fingerprints are one row before any of this. At an anchor a search over unvisited
fingerprints emits a spanning forest, never all pairs; a full anchor is first divided by
the bytes of the other half, of which one must agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import given_id, ordered_id, pieces, settle, ship, texts
from fareloom.llm.components import components

THRESHOLD = 3
SHINGLE = 3
SEED = 42
#: At an anchor with more fingerprints, only those that agree in a byte of the other half meet.
DIVIDE_ABOVE = 256
#: In an anchor's key the number of its table comes above this bit, that of its half and the code word below.
TABLE_BIT = 33


def _mixed(h: np.ndarray, table: int) -> np.ndarray:
    """Bits for another fingerprint from the same hashes; the first fingerprint takes them as they are."""
    if not table:
        return h
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15 + 2 * table)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def fingerprints_of(text: bytes, shingle: int = SHINGLE, tables: int = 1) -> list[int]:
    """Per table the bits set in over half the hashes of ``shingle`` words; no words give zero, few words one shingle."""
    words = text.lower().split()
    if not words:
        return [0] * tables
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    size = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:-size] + 1))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1 :].tolist())])
    h = np.frombuffer(hashes, ">u8").astype(np.uint64)
    out = []
    for table in range(tables):
        set_bits = np.zeros(64, np.int64)
        for at in range(0, len(h), 1 << 16):
            x = _mixed(h[at : at + (1 << 16)], table).astype(">u8").view(np.uint8).reshape(-1, 8)
            set_bits += np.unpackbits(x, axis=1).sum(axis=0, dtype=np.int64)
        out.append(int.from_bytes(np.packbits(2 * set_bits > len(h)).tobytes(), "big"))
    return out


def fingerprint(text: bytes) -> int:
    return fingerprints_of(text)[0]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, tables: int = 1) -> DataFrame:
    """(oid, text_hash, fps) per row; each of ``fps`` holds 64 bits as a signed long. A missing text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = [fingerprints_of(t, shingle, tables) for t in texts(batch.column("text"))]
            flat = pa.array(np.array(found, np.uint64).ravel().view(np.int64))
            fps = pa.FixedSizeListArray.from_arrays(flat, tables).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("oid"), batch.column("text_hash"), fps], ["oid", "text_hash", "fps"])

    ship(docs.sparkSession)
    rows = docs.select(ordered_id(id_col).alias("oid"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "oid long, text_hash long, fps array<long>")


def syndrome_masks() -> list[list[int]]:
    """For each syndrome of the 31-bit Hamming code, the flips that lead a half to its anchors.

    The syndrome is the exclusive or of the places (1 to 31) of all set bits; bit 31 is free.
    """
    out = [[0, 1 << 31]]
    for s in range(1, 32):
        one = 1 << (s - 1)
        two = [(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, 32) if i < (i ^ s)]
        out.append([one, one | 1 << 31, *two])
    return out


def anchors(fp: str) -> Column:
    """All anchors of a fingerprint: the half's number in bit 32 and above, the code word below."""

    def half(number: int) -> Column:
        x = F.shiftrightunsigned(F.col(fp), 32 * number).bitwiseAND(0xFFFFFFFF)
        s = F.lit(0)
        for bit in range(5):
            places = sum(1 << (i - 1) for i in range(1, 32) if i >> bit & 1)
            s = s + (F.bit_count(x.bitwiseAND(places)) % 2) * (1 << bit)
        flips = F.array(*[F.array(*[F.lit(m).cast("long") for m in masks]) for masks in syndrome_masks()])
        base = x.bitwiseOR(F.lit(number << 32).cast("long"))
        return F.transform(F.get(flips, s), lambda m: base.bitwiseXOR(m))

    return F.concat(half(0), half(1))


def _forest(fps: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links that connect what is connected among ``fps`` (distinct), at most one less than they are."""
    links, rest = [], fps
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= threshold
            if near.any():
                found, rest = rest[near], rest[~near]
                links += [(int(x), int(y)) for y in found]
                queue += list(found)
    return links


def _at_anchor(anchor: int, fps: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    if len(fps) <= DIVIDE_ABOVE:
        return _forest(fps, threshold)
    other = fps >> np.uint64(0 if anchor >> 32 else 32)
    links = []
    for byte in range(4):
        value = (other >> np.uint64(8 * byte)) & np.uint64(255)
        order = np.argsort(value, kind="stable")
        for part in np.split(fps[order], np.flatnonzero(np.diff(value[order])) + 1):
            links += _forest(part, threshold)
    return links


def links(classes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links (table, a, b) among the distinct fingerprints of (table, fp) that connect whatever ``threshold`` connects within a table.

    Without a column ``table`` all are of one.
    """
    if not 0 <= threshold <= 3:
        raise ValueError("the anchors are laid out for a threshold of 0 to 3")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
            table = pa.array([t for t, _, _ in found], pa.int32())
            ab = np.array([f[1:] for f in found], np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([table, pa.array(ab[:, 0]), pa.array(ab[:, 1])], ["table", "a", "b"])

        held_key, held = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            key = np.concatenate((held_key, batch.column("anchor").to_numpy()))
            fp = np.concatenate((held, batch.column("fp").to_numpy().view(np.uint64)))
            if not len(key):
                continue
            last = np.searchsorted(key, key[-1])  # this anchor may go on in the next batch
            yield out(_groups(key[:last], fp[:last]))
            held_key, held = key[last:], fp[last:]
        yield out(_groups(held_key, held))

    def _groups(key: np.ndarray, fp: np.ndarray) -> list[tuple[int, int, int]]:
        found = []
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(key)) + 1, [len(key)]))
        size = np.diff(cuts)
        two = cuts[:-1][size == 2]
        two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= threshold]
        found += zip((key[two] >> TABLE_BIT).tolist(), fp[two].tolist(), fp[two + 1].tolist())
        for i in np.flatnonzero(size > 2):
            table, anchor = divmod(int(key[cuts[i]]), 1 << TABLE_BIT)
            found += ((table, a, b) for a, b in _at_anchor(anchor, fp[cuts[i] : cuts[i + 1]], threshold))
        return found

    ship(classes.sparkSession)
    classes = classes if "table" in classes.columns else classes.withColumn("table", F.lit(0))
    place = F.shiftleft(F.col("table").cast("long"), TABLE_BIT)
    sent = classes.select("fp", F.explode(F.transform(anchors("fp"), lambda a: a + place)).alias("anchor"))
    return sent.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "table int, a long, b long")


def _members(docs: DataFrame, id_col: str, text_col: str, threshold: int, shingle: int, tables: int) -> DataFrame:
    """(oid, text_hash, fp, root, component) per row of ``docs``; ``root`` names its group, ``component`` is the smallest id in it.

    Nodes are the fingerprints of the first table. A fingerprint of another table stands for the smallest
    node that has it; the other nodes that have it are linked to that one.
    """
    rows = settle(fingerprints(docs, id_col, text_col, shingle, tables), "fingerprints").withColumn("fp", F.get("fps", F.lit(0)))
    nodes = settle(rows.groupBy("fp", "fps").agg(F.min("oid").alias("first")), "fingerprint-classes")
    each = nodes.select(F.posexplode("fps").alias("table", "at"), F.col("fp").alias("node"))
    named = settle(each.groupBy("table", "at").agg(F.min("node").alias("node")), "fingerprint-names")
    found = settle(links(named.select("table", F.col("at").alias("fp")), threshold), "fingerprint-links")
    if tables == 1:
        joined = found.select("a", "b")
    else:
        for side in ("a", "b"):
            name = named.select("table", F.col("at").alias(side), F.col("node").alias(f"{side}_node"))
            found = found.join(name, ["table", side])
        same = each.join(named.withColumnRenamed("node", "least"), ["table", "at"]).where("node <> least").select("least", "node")
        joined = found.select("a_node", "b_node").union(same).toDF("a", "b")
    roots = settle(components(joined), "roots")
    classes = nodes.groupBy("fp").agg(F.min("first").alias("first"))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    member = settle(rooted.join(least, "root").select("fp", "root", "component"), "members")
    return rows.drop("fps").join(member, "fp", "left")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest id that links reach, its own included; a missing id comes
    last and is the component's id only if no other is in it. Rows with equal ids or texts each
    have their row; an empty table gives no rows.
    """
    return _members(docs, id_col, text_col, threshold, SHINGLE, 1).select(
        given_id("oid").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        given_id("component").alias("component_id"),
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: int = THRESHOLD,
    shingle: int = SHINGLE,
    tables: int = 1,
) -> DataFrame:
    """One document of each group of near copies: the row with the group's smallest id.

    If several rows of a group share that id, the one with the smallest hash of its text stays; two groups may
    have the same smallest id, and each keeps its own row. Documents link if they do in any of ``tables`` fingerprints.
    """
    first = _members(docs, id_col, text_col, threshold, shingle, tables).where("oid = component")
    stay = first.groupBy("root").agg(F.min(F.struct("oid", "text_hash")).alias("r")).select(F.col("r.oid").alias("_fl_id"), F.col("r.text_hash").alias("_fl_hash"))
    marked = docs.select("*", ordered_id(id_col).alias("_fl_id"), F.xxhash64(text_col).alias("_fl_hash"))
    kept = marked.join(stay, ["_fl_id", "_fl_hash"], "left_semi")
    return kept.dropDuplicates(["_fl_id", "_fl_hash"]).select(*docs.columns)
