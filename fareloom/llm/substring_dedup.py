"""Substring dedup by relative Lempel-Ziv parsing.

Every document is parsed into factors, copies from a document with a smaller id, and literals
between them. A factor of ``window`` (50) words or more is a duplicate span and is removed.

Reference blocks. Each window of 50 words selects one seed: of its 8-word sequences the
leftmost with the smallest hash, so equal windows select equal seeds at equal places. The
longest stretch of windows that share one seed is a block; a text has about one per 22 words.
Every block whose seed occurs under two ids is indexed with the first id that holds it, once
however often it is copied.

Factors. A document copies each of its blocks that an earlier document holds whole; blocks in
a row from one document make one longer factor. Where a factor begins or ends inside a block,
the same seed leads to different blocks. Only these are opened: their single windows are looked
up in the index of the seed's windows, so a copy that block boundaries or two
sources cut in two is found to the word.

No group is compared pair by pair. An occurrence asks for the first id of its block or window:
a minimum, combined before the shuffle, and joined back by a join that adaptive execution
can split. Windows are equal if two independent 64-bit hashes agree, of seed and window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import given_id, ordered_id, pieces, settle, ship, texts

WINDOW = 50
SEED_WORDS = 8
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
CHUNK = 2 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def _leftmost_least(v: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value among ``width`` values from each place on."""
    place, span = np.arange(len(v)), 1

    def better(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        right = y < x
        return np.where(right, b, a), np.where(right, y, x)

    while 2 * span <= width:
        place, v = better(place[:-span], place[span:], v[:-span], v[span:])
        span *= 2
    if rest := width - span:
        place, v = better(place[:-rest], place[rest:], v[:-rest], v[rest:])
    return place


class Blocks:
    """The blocks of some documents, as arrays: doc, start (word in it), windows, seed, one, two."""

    def __init__(self, docs: list[list[bytes]], window: int, seed_words: int = SEED_WORDS):
        digest = xxhash.xxh3_128_digest
        lanes = np.frombuffer(b"".join([digest(w) for d in docs for w in d]), np.uint64).reshape(-1, 2)
        ends = np.cumsum([len(d) for d in docs])
        n = len(lanes)
        self.window, self.doc = window, np.empty(0, np.int64)
        self.start = self.windows = self.doc
        self.seed = self.one = self.two = np.empty(0, np.uint64)
        if n < window:
            return
        up, self._down = _powers(_BASE, n), _powers(_BACK, n)
        zero = np.zeros(1, np.uint64)
        self._sums = [np.concatenate((zero, np.cumsum(lanes[:, i] * up))) for i in (0, 1)]
        at = np.arange(n - window + 1)
        doc = np.searchsorted(ends, at, side="right")
        seeds = self.hashes(0, np.arange(n - seed_words + 1), seed_words)
        chosen = _leftmost_least(seeds, window - seed_words + 1)
        whole = at + window <= ends[doc]
        at, doc, chosen = at[whole], doc[whole], chosen[whole]
        if not len(at):
            return
        first = np.flatnonzero(np.concatenate(([True], np.diff(chosen) != 0)))
        self.windows = np.diff(np.concatenate((first, [len(at)])))
        self._at, self.doc = at[first], doc[first]
        self.start = self._at - np.concatenate(([0], ends))[self.doc]
        self.seed = seeds[chosen[first]]
        length = self.windows + window - 1
        self.one, self.two = (self.hashes(i, self._at, length) for i in (0, 1))

    def hashes(self, lane: int, at: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        s = self._sums[lane]
        return _mix((s[at + length] - s[at]) * self._down[at] + np.uint64(_BASE) * np.asarray(length, np.uint64))

    def window_hashes(self, block: int) -> bytes:
        at = self._at[block] + np.arange(self.windows[block])
        return self.hashes(1, at, self.window).tobytes()


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _seeds(rows: DataFrame, window: int) -> DataFrame:
    """(seed, oid, text_hash) of every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", CHUNK):
            b = Blocks([t.split() for t in texts(batch.column("text"))], window)
            doc = pa.array(b.doc)
            columns = [_signed(b.seed), batch.column("oid").take(doc), batch.column("text_hash").take(doc)]
            yield pa.RecordBatch.from_arrays(columns, ["seed", "oid", "text_hash"])

    return rows.mapInArrow(run, "seed long, oid long, text_hash long")


def _indexed(rows: DataFrame, window: int) -> DataFrame:
    """The blocks whose seed is among the row's ``seeds``, with the hashes of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", CHUNK):
            b = Blocks([t.split() for t in texts(batch.column("text"))], window)
            asked = batch.column("seeds")
            pairs = set(zip(np.repeat(np.arange(batch.num_rows), asked.value_lengths().to_numpy()).tolist(), asked.flatten().to_pylist()))
            take = np.flatnonzero([p in pairs for p in zip(b.doc.tolist(), b.seed.view(np.int64).tolist())])
            doc = pa.array(b.doc[take])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("oid").take(doc),
                    batch.column("text_hash").take(doc),
                    pa.array(b.start[take]),
                    pa.array(b.windows[take]),
                    _signed(b.seed[take]),
                    _signed(b.one[take]),
                    _signed(b.two[take]),
                    pa.array([np.frombuffer(b.window_hashes(i), np.int64) for i in take], pa.list_(pa.int64())),
                ],
                ["oid", "text_hash", "start", "windows", "seed", "one", "two", "hashes"],
            )

    kind = "oid long, text_hash long, start long, windows long, seed long, one long, two long, hashes array<long>"
    return rows.mapInArrow(run, kind)


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(oid, text_hash, start, windows, ref): runs of windows that document ``ref`` < oid holds first."""
    if window < 2 * SEED_WORDS:
        raise ValueError(f"a window has to have {2 * SEED_WORDS} words at least")
    ship(docs.sparkSession)
    rows = docs.select(ordered_id(id_col).alias("oid"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    seeds = settle(_seeds(rows, window), "seeds")
    shared = settle(seeds.groupBy("seed").agg(F.min("oid").alias("lo"), F.max("oid").alias("hi")).where("lo < hi").select("seed"), "shared-seeds")
    asked = seeds.join(shared, "seed", "left_semi").groupBy("oid", "text_hash").agg(F.collect_set("seed").alias("seeds"))
    blocks = settle(_indexed(rows.join(asked, ["oid", "text_hash"]), window), "blocks")

    same = ["seed", "one", "two"]
    first = settle(blocks.groupBy(*same).agg(F.min("oid").alias("ref")), "first-blocks")
    whole = blocks.drop("hashes").join(first, same).where("ref < oid").select("oid", "text_hash", "start", "windows", "ref")

    # Minima and counts are stored before they are joined back: then both sides of the join are dealt
    # out for it alone, and a seed or window of many rows can be split.
    open_seeds = settle(first.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed"), "open-seeds")
    opened = first.join(open_seeds, "seed", "left_semi").withColumnRenamed("ref", "oid")
    place, one = F.posexplode("hashes").alias("i", "window_hash"), F.lit(1).cast("long")
    single = blocks.join(opened, [*same, "oid"]).select("seed", "oid", "text_hash", "start", place)
    single = settle(single.select("seed", "window_hash", "oid", "text_hash", (F.col("start") + F.col("i")).alias("start")), "windows")
    least = single.groupBy("seed", "window_hash").agg(F.min("oid").alias("ref"), F.max("oid").alias("hi")).where("ref < hi")
    partly = single.join(settle(least, "first-windows"), ["seed", "window_hash"]).where("ref < oid").select("oid", "text_hash", "start", one.alias("windows"), "ref")
    return settle(whole.union(partly), "spans")


def _factors(found: list[dict], window: int) -> list[tuple[int, int, int]]:
    """Runs of windows joined into (start, length, ref) where they go on in the same document."""
    out: list[list[int]] = []
    for start, windows, ref in sorted((f["start"], f["windows"], f["ref"]) for f in found):
        end = start + windows - 1 + window
        if out and out[-1][2] == ref and start <= out[-1][1] - window + 1:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([start, end, ref])
    return [(a, b - a, r) for a, b, r in out]


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_text, factors (start, length, ref).

    Words are runs of anything but ASCII white space; those kept are joined by one space. A word
    goes if a window of ``window`` words over it also starts in a document with a smaller id.
    A missing text has no words; a text shorter than the window loses none. Documents
    with the same id do not remove each other's words; a missing id is larger than every other.
    """
    kind = "array<struct<start:long,length:long,ref:long>>"
    rows = docs.select(ordered_id(id_col).alias("oid"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    found = spans(docs, id_col, text_col, window)
    listed = found.groupBy("oid", "text_hash").agg(F.collect_list(F.struct("start", "windows", "ref")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", CHUNK):
            n_words, n_removed, kept, factors = [], [], [], []
            for text, runs in zip(texts(batch.column("text")), batch.column("found").to_pylist()):
                words = text.split()
                n_words.append(len(words))
                factors.append(_factors(runs or [], window))
                gone = np.zeros(len(words) + 1, np.int64)
                for start, length, _ in factors[-1]:
                    gone[start] += 1
                    gone[start + length] -= 1
                stay = np.cumsum(gone)[:-1] == 0
                n_removed.append(int(len(words) - stay.sum()))
                kept.append(b" ".join(w for w, s in zip(words, stay.tolist()) if s) if n_removed[-1] else b" ".join(words))
            structs = pa.array([[{"start": a, "length": n, "ref": r} for a, n, r in f] for f in factors], pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("ref", pa.int64())])))
            columns = [batch.column("oid"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()), structs]
            yield pa.RecordBatch.from_arrays(columns, ["oid", "n_words", "n_removed", "kept", "factors"])

    out = rows.join(listed, ["oid", "text_hash"], "left").select("oid", "text", "found")
    out = out.mapInArrow(run, f"oid long, n_words long, n_removed long, kept binary, factors {kind}")
    return out.select(given_id("oid").alias("doc_id"), "n_words", "n_removed", F.col("kept").cast("string").alias("kept_text"), "factors")
