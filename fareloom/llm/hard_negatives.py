"""Hard negatives by exact integer scores from Kronecker-packed products.

Every component is scaled and rounded down to a whole number. For ``FIELDS`` candidates at a time, the
components at one place are biased until none is negative and laid side by side in the fields of one
wide integer. An anchor's component, biased likewise, multiplies that integer once and so all candidates
at a time; the sum over the places holds every candidate's score in a field of its own, from which the
biases are taken off again. A field is as wide as the largest sum that these numbers allow, so no carry
reaches the next one and scores are exact at any size.

Anchors are a stated part of the rows and meet all rows, in blocks: an anchor belongs to one group of about
``GROUP``, a candidate to one of ``SLICES`` slices, and each group meets each slice in one task, which
reads the group and then streams the slice. Memory is bounded by a group and one block of candidates.
What a task hands on is already the best of its slice, a fixed number of rows per anchor. Slices are
dealt by a hash of the id, so a label with a third of all rows is spread like any other; inside a slice
rows are sorted by label, so a block that cannot hold a partner for an anchor is not multiplied.

Two passes: first the positives of every anchor, then, with their scores as bounds, the negatives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import settle, ship

#: Candidates packed side by side.
FIELDS = 512
#: Anchors that one task holds, about.
GROUP = 2048
SLICES = 16
LONG = (1 << 63) - 1

Found = list[tuple[int, int]]


def whole_numbers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) per component, exactly: int64 where that is wide enough, else Python's integers."""
    scaled = np.floor(vectors * float(scale))
    if not scaled.size or np.abs(scaled).max() < 1 << 31:
        return scaled.astype(np.int64)
    flat = np.array([int(x) for x in scaled.ravel()], dtype=object)
    return flat.reshape(scaled.shape)


class Packed:
    """Candidates (rows of whole numbers, one dimension) packed for products with anchors."""

    def __init__(self, rows: np.ndarray):
        self.count, self.places = rows.shape
        self.bias = -int(rows.min()) if rows.size else 0
        self.raised = rows + self.bias
        self.top = int(self.raised.max()) if rows.size else 0
        self.sums = self.raised.sum(axis=1)
        self.wide: dict[int, list[int]] = {}

    def _columns(self, width: int) -> list[int]:
        """One wide integer per place, a field of ``width`` bytes per candidate; made once per width."""
        if width not in self.wide:
            if width <= 8:
                cells = [c.tobytes() for c in np.ascontiguousarray(self.raised.T).astype(f"<u{width}")]
            else:
                cells = [b"".join(int(x).to_bytes(width, "little") for x in c) for c in self.raised.T]
            self.wide[width] = [int.from_bytes(c, "little") for c in cells]
        return self.wide[width]

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """Inner products of all candidates with one anchor."""
        if not self.places:
            return np.zeros(self.count, np.int64)
        bias = -int(anchor.min())
        raised = [int(a) + bias for a in anchor]
        bits = (sum(raised) * self.top).bit_length()
        width = 4 if bits <= 32 else 8 if bits <= 62 else -(-bits // 8)
        product = sum(map(int.__mul__, self._columns(width), raised))
        cells = product.to_bytes(width * self.count, "little")
        if width <= 8:
            total = np.frombuffer(cells, f"<u{width}").astype(np.int64)
        else:
            cut = range(0, len(cells), width)
            total = np.array([int.from_bytes(cells[i : i + width], "little") for i in cut], dtype=object)
        largest = self.places * max(abs(bias), *raised) * max(abs(self.bias), self.top)
        sums = self.sums
        if largest.bit_length() > 60:
            total, sums = total.astype(object), sums.astype(object)
        return total - bias * sums - self.bias * (sum(raised) - bias * self.places)


@dataclass
class Anchor:
    id: int
    label: int
    numbers: np.ndarray
    #: Per wanted list: its id and the lowest and highest score that it takes (None: any).
    wants: list[tuple[int, int | None, int | None]]
    best: list[Found] = field(default_factory=list)


def _merge(anchor: Anchor, ids: np.ndarray, scores: np.ndarray, fits: np.ndarray, most: int) -> None:
    """Put what fits of a block into the anchor's lists, best first, ties to the smaller id."""
    ids, scores = ids[fits], scores[fits]
    for (_, low, high), held in zip(anchor.wants, anchor.best):
        floor = held[-1][0] if len(held) == most else None
        inside = np.ones(len(scores), bool)
        if low is not None:
            inside &= (scores >= low) & (scores <= high)
        if floor is not None:
            inside &= scores >= floor
        if inside.any():
            s, i = scores[inside], ids[inside]
            if len(s) > most:
                order = np.lexsort((i, -s))[:most] if s.dtype != object else sorted(range(len(s)), key=lambda k: (-s[k], i[k]))[:most]
                s, i = s[order], i[order]
            held += zip(s.tolist(), i.tolist())
            held.sort(key=lambda x: (-x[0], x[1]))
            del held[most:]


def _stream(same: bool, most: int, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For rows sorted by unit, anchors first: the ``most`` best of each wanted list within the unit.

    ``same`` asks for candidates of the anchor's label, otherwise of any other label.
    """

    def finish(anchors: dict[int, list[Anchor]]) -> pa.RecordBatch:
        rows = [
            (a.id, want[0], n, max(-LONG - 1, min(LONG, s)))
            for at in anchors.values()
            for a in at
            for want, held in zip(a.wants, a.best)
            for s, n in held
        ]
        columns = list(zip(*rows)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "list", "id", "score"])

    def block(anchors: list[Anchor], ids: np.ndarray, labels: np.ndarray, numbers: np.ndarray) -> None:
        packed = None
        present = set(labels.tolist())
        for a in anchors:
            if (a.label not in present) if same else (present == {a.label}):
                continue
            packed = packed or Packed(numbers)
            fits = labels == a.label
            _merge(a, ids, packed.scores(a.numbers), fits & (ids != a.id) if same else ~fits, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, anchors, held = None, {}, []

        def flush() -> None:
            if held:
                ids, labels, numbers = (np.concatenate(c) for c in zip(*held))
                block(anchors.get(numbers.shape[1], []), ids, labels, numbers)
                held.clear()

        for batch in batches:
            units, kinds = batch.column("unit").to_numpy(), batch.column("kind").to_numpy()
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            vectors, wants = batch.column("vec"), batch.column("wants").to_pylist()
            sizes, flat = vectors.value_lengths().to_numpy(), vectors.flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            change = np.flatnonzero((np.diff(units) != 0) | (np.diff(kinds) != 0) | (np.diff(sizes) != 0)) + 1
            for a, b in zip([0, *change.tolist()], [*change.tolist(), len(units)]):
                if a == b:
                    continue
                if units[a] != unit:
                    flush()
                    if unit is not None:
                        yield finish(anchors)
                    unit, anchors = units[a], {}
                numbers = whole_numbers(flat[ends[a] : ends[b]].reshape(b - a, sizes[a]), scale)
                if kinds[a] == 0:
                    for k in range(a, b):
                        want = [(w["list"], w["low"], w["high"]) for w in wants[k]]
                        one = Anchor(int(ids[k]), int(labels[k]), numbers[k - a], want, [[] for _ in want])
                        anchors.setdefault(int(sizes[a]), []).append(one)
                    continue
                for k in range(0, b - a, FIELDS):
                    have = sum(len(h[0]) for h in held)
                    if held and (held[0][2].shape[1] != sizes[a] or have + min(FIELDS, b - a - k) > FIELDS):
                        flush()
                    to = slice(a + k, min(b, a + k + FIELDS))
                    held.append((ids[to], labels[to], numbers[k : k + FIELDS]))
        flush()
        if unit is not None:
            yield finish(anchors)

    return run


WANTS = "array<struct<list: long, low: long, high: long>>"


def _best(rows: DataFrame, anchors: DataFrame, groups: int, same: bool, most: int, scale: int) -> DataFrame:
    """(anchor, list, id, score, rank): the ``most`` best rows of each list that an anchor wants."""
    group, slice_ = F.pmod(F.xxhash64("id"), F.lit(groups)), F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(SLICES))
    asked = F.explode(F.transform(F.sequence(F.lit(0), F.lit(SLICES - 1)), lambda n: group * SLICES + n)).alias("unit")
    met = F.explode(F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda n: n * SLICES + slice_)).alias("unit")
    asks = anchors.select(asked, F.lit(0).alias("kind"), "id", "label", "vec", "wants")
    given = rows.select(met, F.lit(1).alias("kind"), "id", "label", "vec", F.lit(None).cast(WANTS).alias("wants"))
    order = ["unit", "kind", F.size("vec"), "label", "id"]
    dealt = asks.union(given).repartitionByRange(groups * SLICES, "unit").sortWithinPartitions(*order)
    found = dealt.mapInArrow(_stream(same, most, scale), "anchor long, list long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("anchor", "list").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= most)


def mine(
    table: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    id_col: str = "vec_id",
    label_col: str = "label",
    vec_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are the ``positives`` best other rows of its label; for each of them the
    ``negatives`` best rows of other labels whose score is ``low`` to ``high`` percent of the positive's.
    Best is the larger inner product of whole numbers, ties the smaller id. Anchors without positives,
    and positives without a negative inside the bounds, give no rows, nor does an empty table.

    Rows with a missing id, label or vector, or with a missing or non-finite component, take no part. Rows that
    share an id are one row, the one with the smallest label and then vector. Vectors of different lengths are never
    compared; those without components have a score of 0 with each other. A score beyond a long counts
    as the largest or smallest long.
    """
    ship(table.sparkSession)
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    chosen = table.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), v.alias("vec"), bad.alias("bad"), is_anchor.alias("asks"))
    chosen = chosen.where("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL AND NOT bad")
    one = chosen.groupBy("id").agg(F.min(F.struct("label", "vec", "asks")).alias("r"))
    rows = settle(one.select("id", "r.label", "r.vec", "r.asks"), "labelled-vectors")
    anchors = rows.where("asks")
    groups = max(1, -(-anchors.count() // GROUP))
    any_score = F.array(F.struct(F.lit(0).cast("long").alias("list"), F.lit(None).cast("long").alias("low"), F.lit(None).cast("long").alias("high")))
    near = settle(_best(rows, anchors.withColumn("wants", any_score), groups, True, positives, scale), "positives")
    # Whole numbers only: 100 times a score may not fit a long, but fits a decimal.
    part = "CAST({0}(CAST(score AS DECIMAL(28, 0)) * {1} / 100) AS LONG)"
    want = F.struct(F.col("id").alias("list"), F.expr(part.format("ceil", low)).alias("low"), F.expr(part.format("floor", high)).alias("high"))
    wants = near.groupBy(F.col("anchor").alias("id")).agg(F.collect_list(want).alias("wants"))
    far = settle(_best(rows, anchors.join(wants, "id"), groups, False, negatives, scale), "negatives")
    shown = near.select("anchor", F.col("id").alias("list"), F.col("score").alias("positive_score"))
    return far.join(shown, ["anchor", "list"]).select(
        F.col("anchor").alias("anchor_id"),
        F.col("list").alias("positive_id"),
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
