"""Binned rows in packed form: several features in one number, many rows in one cell of a table.

The bins of features whose numbers of bins multiply to ``CELLS`` at most are one number of two bytes. Sums per number
give the sums per feature and bin of every feature in it, exactly, so a pass adds up a few numbers per row, not every
feature; a split is looked up by number. Rows are stored in blocks of up to ``BLOCK``, numbers group by group, so that a pass
reads arrays and not rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most values of a number.
CELLS = 1024
#: Rows of a block.
BLOCK = 1 << 15
#: Points that stand for the values of a feature in a task, and rows that are sorted at a time.
POINTS, SORTED = 4096, 1 << 16
#: A tree's nodes: the feature and last bin that go left (-1: a leaf), both children, the mean, the fall of the squared error.
NODE = np.dtype([("feature", "<i4"), ("bin", "<i4"), ("left", "<i4"), ("right", "<i4"), ("value", "<f8"), ("won", "<f8")])


class Layout:
    """Which group a feature is in, what one of its bins adds to the group's number, and where its sums begin."""

    def __init__(self, widths: Sequence[int], most: int = CELLS):
        self.widths, self.most = np.array(widths, np.int64), most
        self.group, self.stride, sizes = np.full(len(widths), -1), np.ones(len(widths), np.int64), []
        for f in np.argsort(-self.widths, kind="stable"):
            w = int(self.widths[f])
            if w < 2:
                continue  # a single bin divides nothing
            at = next((k for k, size in enumerate(sizes) if size * w <= max(most, w)), len(sizes))
            if at == len(sizes):
                sizes.append(1)
            self.group[f], self.stride[f] = at, sizes[at]
            sizes[at] *= w
        self.sizes = sizes or [1]
        self.starts = np.append(0, np.cumsum(self.widths))
        self.room = max(self.sizes)

    def pack(self, bins: Iterator[np.ndarray], rows: int) -> np.ndarray:
        """Numbers, a line per group, from the bins of each feature in turn."""
        out = np.zeros((len(self.sizes), rows), np.uint16)
        for f, b in enumerate(bins):
            if self.group[f] >= 0:
                out[self.group[f]] += (b * self.stride[f]).astype(np.uint16)
        return out

    def of(self, numbers: np.ndarray, feature: int) -> np.ndarray:
        """A feature's bins, from the numbers of its group."""
        if self.group[feature] < 0:
            return np.zeros(len(numbers), np.uint16)
        number = np.arange(self.sizes[self.group[feature]])
        return (number // self.stride[feature] % self.widths[feature]).astype(np.uint16).take(numbers)

    @cached_property
    def _members(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each group the places of its features' sums, and which numbers belong to each."""
        out = []
        for k, size in enumerate(self.sizes):
            places, has = [np.empty(0, np.int64)], [np.empty((size, 0))]
            for f, w in enumerate(self.widths):
                if self.group[f] == k or (self.group[f] < 0 and k == 0):  # a single bin has all rows
                    places.append(self.starts[f] + np.arange(w))
                    has.append(np.arange(size)[:, None] // self.stride[f] % w == np.arange(w))
            out.append((np.concatenate(places), np.concatenate(has, axis=1).astype(float)))
        return out

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_members"}

    def features(self, sums: Sequence[np.ndarray], nodes: int) -> np.ndarray:
        """Sums per node and number of each group, as sums per node, feature and bin."""
        out = np.zeros((nodes, self.starts[-1]))
        for (places, has), x in zip(self._members, sums):
            out[:, places] = x @ has
        return out

    def sums(self, numbers: np.ndarray, at: np.ndarray, nodes: int, weights: Sequence[np.ndarray | None], into: list[list[np.ndarray]]) -> None:
        """Add each weight (None: one) per node and number; ``into`` has a list of groups per weight."""
        key = np.empty(len(at), np.int64)
        for k, size in enumerate(self.sizes):
            if size == 2:  # of an indicator only the rows that have it are visited
                some = np.flatnonzero(numbers[k])
                for w, sums in zip(weights, into):
                    ones = np.bincount(at[some], None if w is None else w[some], nodes)
                    sums[k] += np.stack((np.bincount(at, w, nodes) - ones, ones), axis=1)
                continue
            np.multiply(at, size, out=key)
            np.add(key, numbers[k], out=key)
            for w, sums in zip(weights, into):
                sums[k] += np.bincount(key, w, nodes * size).reshape(nodes, size)

    def empty(self, nodes: int) -> list[np.ndarray]:
        return [np.zeros((nodes, size)) for size in self.sizes]


class Walk:
    """A tree whose nodes have two adjacent children, ready to send packed rows down."""

    def __init__(self, tree: np.ndarray, layout: Layout):
        inner = tree["feature"] >= 0
        self.room, self.value = layout.room, tree["value"]
        self.first = np.where(inner, tree["left"], np.arange(len(tree))).astype(np.int64)
        self.group, self.right = turns(tree["feature"], tree["bin"], layout)
        self.depth, level = 0, np.zeros(1, np.int64)
        while len(level := level[inner[level]]):
            self.depth += 1
            level = np.concatenate((tree["left"][level], tree["right"][level])).astype(np.int64)

    def nodes(self, numbers: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        rows = numbers.shape[1]
        node = np.zeros(numbers.shape[1], np.int64)
        for _ in range(self.depth):
            right = turned(numbers, node, self.group, self.right, self.room)
            node = self.first.take(node)
            node += right
        return node


def turns(feature: np.ndarray, last: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """For nodes that split by feature (-1: none) and last bin that goes left: the group to look at, and per node and number whether it goes right."""
    inner = feature >= 0
    f = np.where(inner, feature, 0)
    bins = np.arange(layout.room)[None, :] // layout.stride[f][:, None] % layout.widths[f][:, None]
    return np.where(inner, layout.group[f], 0), ((bins > last[:, None]) & inner[:, None]).ravel()


def turned(numbers: np.ndarray, node: np.ndarray, group: np.ndarray, right: np.ndarray, room: int) -> np.ndarray:
    """Whether rows go right at their nodes."""
    rows = numbers.shape[1]
    at = group.take(node)
    at *= rows
    at += np.arange(rows)
    number = numbers.ravel().take(at)
    np.multiply(node, room, out=at)
    at += number
    return right.take(at)


def best_splits(g: np.ndarray, h: np.ndarray, layout: Layout, min_child: float = 1.0, total: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, ...]:
    """Feature (-1: none), bin, fall of the squared error, and the left side's sums, of the best split of every node; ties go to the first feature and bin."""
    n = len(g)
    all_g, all_h = total or (x[:, : layout.widths[0]].sum(axis=1) for x in (g, h))
    before = all_g**2 / np.maximum(all_h, 1)
    least = 1e-9 + 1e-12 * before
    won, which, cut, left_g, left_h = np.zeros(n), np.full(n, -1), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
    for f in np.flatnonzero(layout.widths > 1):
        a, b = layout.starts[f : f + 2]
        lg, lh = g[:, a : b - 1].cumsum(axis=1), h[:, a : b - 1].cumsum(axis=1)
        rest = all_h[:, None] - lh
        bad = (lh < min_child) | (rest < min_child)
        falls = lg**2 / np.where(bad, 1, lh) + (all_g[:, None] - lg) ** 2 / np.where(bad, 1, rest) - before[:, None]
        falls[bad] = -1.0
        k = falls.argmax(axis=1)
        here, row = falls[np.arange(n), k], np.arange(n)
        better = (here > won * (1 + 1e-12)) & (here > least)
        won[better], which[better], cut[better] = here[better], f, k[better]
        left_g[better], left_h[better] = lg[row, k][better], lh[row, k][better]
    return which, cut, won, left_g, left_h


def blocks(parts: Iterator[tuple[np.ndarray, ...]], rows: int = BLOCK) -> Iterator[tuple[np.ndarray, ...]]:
    """Pieces of arrays, the rows on the last axis, joined to ``rows`` rows or somewhat more."""
    held: list[tuple[np.ndarray, ...]] = []
    for part in parts:
        if part[0].shape[-1]:
            held.append(part)
        if sum(p[0].shape[-1] for p in held) >= rows:
            yield tuple(np.concatenate(c, axis=-1) for c in zip(*held))
            held = []
    if held:
        yield tuple(np.concatenate(c, axis=-1) for c in zip(*held))


def bins(x: np.ndarray, edges: Sequence[Sequence[float]]) -> Iterator[np.ndarray]:
    """Each feature's bins in turn, of rows of features."""
    return (np.searchsorted(e, x[:, i], "left") for i, e in enumerate(edges))


# -- edges of the bins ------------------------------------------------------------------


def runs(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.empty(0, np.int64)


def merged(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted points in order of value, equal ones as one."""
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    first = runs(values)
    return values[first], np.add.reduceat(weights, first) if len(first) else weights


def thinned(values: np.ndarray, weights: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``points`` of merged points: those in the middle of equal shares of the weight, so a rank is off by half a share."""
    if len(values) <= points:
        return values, weights
    upto = np.cumsum(weights)
    at = np.searchsorted(upto, (np.arange(points) + 0.5) * (upto[-1] / points), "left")
    return merged(values[np.minimum(at, len(values) - 1)], np.full(points, upto[-1] / points))


def edges_of(values: np.ndarray, weights: np.ndarray, low: float, high: float, bins: int) -> np.ndarray:
    """Upper edges of all bins but the last: every value but the highest if there are no more than bins, else quantiles."""
    if len(values) <= bins:
        return values[values < high]
    upto = np.cumsum(weights)
    at = np.searchsorted(upto, np.arange(1, bins) / bins * upto[-1], "left")
    found = np.unique(values[np.minimum(at, len(values) - 1)])
    if len(found) < bins - 1:
        found = np.unique(np.append(found, low))
    return found[found < high]


def quantile_edges(rows: DataFrame, features: str, width: int, bins: int) -> list[list[float]]:
    """Edges of each feature's bins, from one pass over all rows: tasks sort pieces and keep weighted points, exact for few values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.empty(0), np.empty(0))] * width
        ends = np.array([[np.inf, -np.inf]] * width)
        parts = ((b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, width).T,) for b in batches)
        for (x,) in blocks(parts, SORTED):
            for f in range(width):
                v = np.sort(x[f])  # NaN comes last
                v = v[: np.searchsorted(v, np.nan, "left")]
                if not len(v):
                    continue
                ends[f] = min(ends[f, 0], v[0]), max(ends[f, 1], v[-1])
                starts = runs(v)
                new = thinned(v[starts], np.diff(np.append(starts, len(v))).astype(float), POINTS)
                both = merged(*(np.concatenate(p) for p in zip(held[f], new)))
                held[f] = thinned(*both, POINTS) if len(both[0]) > 8 * POINTS else both
        for f, (v, w) in enumerate(held):
            if len(v):
                v, w = thinned(v, w, POINTS // 4)
                row = [[f], [v], [w], [ends[f, 0]], [ends[f, 1]]]
                kinds = [pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], ["feature", "v", "w", "low", "high"])

    def join(t: pa.Table) -> pa.Table:
        v, w = (t.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("v", "w"))
        low, high = t.column("low").to_numpy().min(), t.column("high").to_numpy().max()
        return pa.table([t.column("feature")[:1], pa.array([edges_of(*merged(v, w), low, high, bins)], pa.list_(pa.float64()))], ["feature", "edges"])

    points = rows.select(F.col(features).alias("x")).mapInArrow(run, "feature int, v array<double>, w array<double>, low double, high double")
    found = {r.feature: r.edges for r in points.groupBy("feature").applyInArrow(join, "feature int, edges array<double>").collect()}
    return [list(found.get(f, ())) for f in range(width)]
