"""Boosted trees from histograms, with early stopping.

Squared error. Features are binned once by quantile edges and stored as one byte each beside the label, so a
tree is grown on small rows. A tree sees a share of the rows (by a hash, so a repeated task sees the same) and
of the columns (drawn once per tree). A split maximises the second-order gain with an L2 penalty; leaves hold
the penalised mean of what is left to explain, times the learning rate.

A node with more than ``LOCAL_ROWS`` rows is split by sums per (node, feature, bin): every task adds up its own
rows first, and one aggregation per level serves all such nodes. A smaller node's rows meet in one task, which grows
its whole subtree; so the number of jobs per tree is the number of levels of large nodes plus one.

Every row's prediction so far is stored anew after ``CHUNK`` trees; in between it is the stored one plus that of
the trees since. After each tree the error on the validation rows is measured; training stops when it has not
fallen for ``patience`` trees, and the model keeps the trees up to the best one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom import schema as S
from fareloom.plans import packed as P
from fareloom.session import settle

LOCAL_ROWS = 250_000
CHUNK = 10
#: Most bins of a feature; a bin's number is one byte.
BINS = 64
#: Rows of one task that are added up at a time.
BATCH = 1 << 16
#: Most nodes whose sums a task holds; more are summed in further passes.
TOGETHER = 1024


@dataclass(frozen=True)
class Settings:
    trees: int = 100
    depth: int = 20
    rate: float = 0.1
    rows: float = 0.8
    columns: float = 0.8
    penalty: float = 1.0
    min_child: float = 1.0
    patience: int = 10
    seed: int = 42


@dataclass
class Tree:
    """Nodes by number: the feature and last bin that go left (-1: a leaf), both children, the leaf's value."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def __getstate__(self) -> dict:
        """To tasks a tree goes as arrays: they only look up nodes, and a deep tree has very many."""
        kinds = {f: np.float64 if f == "value" else np.int32 for f in self.__dict__}
        return {f: np.asarray(x, kinds[f]) for f, x in self.__dict__.items()}

    def split(self, node: int, feature: int, bin_: int, values: tuple[float, float]) -> tuple[int, int]:
        self.feature[node], self.bin[node] = feature, bin_
        self.left[node], self.right[node] = len(self.value), len(self.value) + 1
        for v in values:
            for column, x in zip((self.feature, self.bin, self.left, self.right, self.value), (-1, 0, 0, 0, v)):
                column.append(x)
        return self.left[node], self.right[node]

    def graft(self, node: int, other: Tree) -> None:
        """Put another tree in the place of a leaf."""
        shift = len(self.value) - 1
        place = lambda n: node if n == 0 else n + shift
        for n in range(len(other.value)):
            new = (other.feature[n], other.bin[n], place(other.left[n]), place(other.right[n]), other.value[n])
            for column, x in zip((self.feature, self.bin, self.left, self.right, self.value), new):
                if n:
                    column.append(x)
                else:
                    column[node] = x

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row of bins."""
        feature, bin_, left, right = (np.asarray(c) for c in (self.feature, self.bin, self.left, self.right))
        node, row = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while len(row := row[feature[node[row]] >= 0]):
            at = node[row]
            node[row] = np.where(bins[row, feature[at]] <= bin_[at], left[at], right[at])
        return node

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.asarray(self.value)[self.leaves(bins)]


def sampled(row: np.ndarray, tree: int, share: float, seed: int) -> np.ndarray:
    """Whether rows (by their hash) belong to a tree's sample."""
    x = row.view(np.uint64) ^ np.uint64((seed * 1_000_003 + tree) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(11)) < np.uint64(int(share * (1 << 53)))


def gain(g: Column, h: Column, penalty: float) -> Column:
    return g * g / (h + penalty)


def grow(bins: np.ndarray, g: np.ndarray, columns: Sequence[int], depth: int, s: Settings) -> Tree:
    """A tree on rows at hand, level by level; ties go to the first column, then the lowest bin."""
    tree = Tree(value=[float(-g.sum() / (len(g) + s.penalty))])
    widths = bins.max(axis=0).astype(np.int64) + 1  # an indicator has two bins
    node, names = np.zeros(len(g), np.int64), np.zeros(1, np.int64)  # place among the open nodes; their numbers
    for _ in range(depth):
        n = len(names)
        total_g, total_h = np.bincount(node, g, n), np.bincount(node, minlength=n).astype(float)
        top, which, cut = np.full(n, 1e-9), np.full(n, -1), np.zeros(n, np.int64)
        sums = np.zeros((n, 2))
        for c in columns:
            w = widths[c]
            key = node * w + bins[:, c]
            left_g = np.bincount(key, g, n * w).reshape(n, w).cumsum(axis=1)
            left_h = np.bincount(key, minlength=n * w).reshape(n, w).cumsum(axis=1).astype(float)
            right_g, right_h = total_g[:, None] - left_g, total_h[:, None] - left_h
            with np.errstate(divide="ignore", invalid="ignore"):  # an empty side without a penalty is ruled out below
                gains = left_g**2 / (left_h + s.penalty) + right_g**2 / (right_h + s.penalty) - (total_g**2 / (total_h + s.penalty))[:, None]
            gains[(left_h < s.min_child) | (right_h < s.min_child)] = -1
            b = gains.argmax(axis=1)
            here = gains[np.arange(n), b]
            better = here > top * (1 + 1e-12)
            top[better], which[better], cut[better] = here[better], c, b[better]
            sums[better] = np.stack((left_g[np.arange(n), b], left_h[np.arange(n), b]), axis=1)[better]
        opened = which >= 0
        if not opened.any():
            break
        first = np.full(n, -1)
        found = []
        for k in np.flatnonzero(opened):
            (lg, lh), rg, rh = sums[k], total_g[k] - sums[k, 0], total_h[k] - sums[k, 1]
            first[k] = len(found)
            found += tree.split(int(names[k]), int(which[k]), int(cut[k]), (float(-lg / (lh + s.penalty)), float(-rg / (rh + s.penalty))))
        keep = opened[node]
        bins, g, node = bins[keep], g[keep], node[keep]
        right = bins[np.arange(len(node)), which[node]] > cut[node]
        node, names = first[node] + right, np.array(found)
    return tree


# -- stored rows ----------------------------------------------------------------------


def quantile_edges(rows: DataFrame, features: str, width: int, bins: int = BINS, accuracy: int = 10_000) -> list[list[float]]:
    """Upper edges of each feature's bins but the last, from one pass with mergeable summaries."""
    ranks = [(i + 1) / bins for i in range(bins - 1)]
    found = rows.agg(*[F.percentile_approx(F.col(features)[i], ranks, accuracy).alias(str(i)) for i in range(width)]).first()
    return [sorted(set(found[i] or ())) for i in range(width)]


def binned(rows: DataFrame, features: str, edges: list[list[float]], label: str, validation: str | None = None, *keep: str) -> DataFrame:
    """(row, label, valid, bins, margin): one byte per feature; ``row`` is a hash of the row's own values."""
    held = [np.array(e, np.float64) for e in edges]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(held))
            cells = np.stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(held)], axis=1).astype(np.uint8)
            bins = pa.array([c.tobytes() for c in cells], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "label", "valid", "margin")), bins], ["row", "label", "valid", "margin", "bins"])

    valid = F.coalesce(F.col(validation), F.lit(False)) if validation else F.lit(False)
    given = rows.where(F.col(label).isNotNull()).select(
        F.xxhash64(features, label, *keep).alias("row"),
        F.col(label).cast("double").alias("label"),
        valid.alias("valid"),
        F.lit(0.0).alias("margin"),
        F.col(features).alias("x"),
    )
    return given.mapInArrow(run, "row long, label double, valid boolean, margin double, bins binary")


def _cells(batch: pa.RecordBatch) -> np.ndarray:
    return _bytes(batch.column("bins"))


def _bytes(column: pa.Array) -> np.ndarray:
    """The bytes of a column of equally long binary values, a row each, without a copy."""
    if not len(column):
        return np.zeros((0, 0), np.uint8)
    _, offsets, data = column.buffers()
    first, last = np.frombuffer(offsets, np.int32)[[column.offset, column.offset + len(column)]]
    return np.frombuffer(data, np.uint8)[first:last].reshape(len(column), -1)


def _left(batch: pa.RecordBatch, bins: np.ndarray, trees: list[Tree], rate: float) -> np.ndarray:
    """Prediction minus label: the gradient of half the squared error."""
    margin = batch.column("margin").to_numpy() + sum(rate * t.predict(bins) for t in trees)
    return margin - batch.column("label").to_numpy()


def _sample(batch: pa.RecordBatch, s: Settings, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The bins of the rows that a tree learns from, and which rows of the batch these are."""
    use = ~batch.column("valid").to_numpy(zero_copy_only=False).astype(bool)
    use &= sampled(batch.column("row").to_numpy(), number, s.rows, s.seed)
    return _cells(batch)[use], use


def _together(parts: Iterator[tuple[np.ndarray, ...]], rows: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Parts of arrays joined until they have ``rows`` rows; parts without a row are left out."""
    held: list[tuple[np.ndarray, ...]] = []
    for part in parts:
        if len(part[0]):
            held.append(part)
        if sum(len(p[0]) for p in held) >= rows:
            yield tuple(np.concatenate(c) for c in zip(*held))
            held = []
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


def histogram(rows: DataFrame, tree: Tree, nodes: list[int], columns: Sequence[int], since: list[Tree], s: Settings, number: int) -> DataFrame:
    """(node, feature, bin, g, h) for the given leaves of a tree: sums of gradients and rows, added up per task first."""
    place = np.full(len(tree.value), -1)
    place[nodes] = np.arange(len(nodes))
    size = len(nodes) * BINS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, len(columns), size))
        for bins, g, at in _together(used(batches), max(BATCH, size)):
            for k, c in enumerate(columns):
                key = at * BINS + bins[:, c]
                sums[0, k] += np.bincount(key, g, size)
                sums[1, k] += np.bincount(key, minlength=size)
        k, key = np.nonzero(sums[1])
        out = [np.array(nodes, np.int64)[key // BINS], np.array(columns, np.int64)[k], key % BINS, sums[0, k, key], sums[1, k, key]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["node", "feature", "bin", "g", "h"])

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            bins, use = _sample(batch, s, number)
            at = place[tree.leaves(bins)]
            batch, bins, at = batch.filter(pa.array(use)).filter(pa.array(at >= 0)), bins[at >= 0], at[at >= 0]
            yield bins, _left(batch, bins, since, s.rate), at

    cells = rows.mapInArrow(run, "node long, feature long, bin long, g double, h double")
    return cells.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def best_splits(cells: DataFrame, penalty: float = 1.0, min_child: float = 1.0) -> DataFrame:
    """(node, feature, bin, gain, left_g, left_h, g, h): the best split of every node; ties go to the first feature and bin."""
    by = Window.partitionBy("node", "feature")
    upto = by.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = cells.select("node", "feature", "bin", *[x for c in ("g", "h") for x in (F.sum(c).over(upto).alias(f"left_{c}"), F.sum(c).over(by).alias(f"all_{c}"))])
    right_g, right_h = F.col("all_g") - F.col("left_g"), F.col("all_h") - F.col("left_h")
    won = gain(F.col("left_g"), F.col("left_h"), penalty) + gain(right_g, right_h, penalty) - gain(F.col("all_g"), F.col("all_h"), penalty)
    fit = sums.where((F.col("left_h") >= min_child) & (right_h >= min_child)).withColumn("gain", won).where("gain > 1e-9")
    order = F.struct(F.col("gain"), -F.col("feature"), -F.col("bin"))
    top = F.max_by(F.struct("feature", "bin", "gain", "left_g", "left_h", F.col("all_g").alias("g"), F.col("all_h").alias("h")), order)
    return fit.groupBy("node").agg(top.alias("top")).select("node", "top.*")


def _finish(rows: DataFrame, tree: Tree, nodes: dict[int, int], columns: Sequence[int], since: list[Tree], s: Settings, number: int) -> dict[int, Tree]:
    """Whole subtrees of small leaves (number and depth that is left): each one's rows meet in one task."""
    room = np.full(len(tree.value), -1)
    room[list(nodes)] = list(nodes.values())

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, use = _sample(batch, s, number)
            node = tree.leaves(bins)
            open_ = room[node] > 0
            rest = batch.filter(pa.array(use)).filter(pa.array(open_))
            g = _left(rest, bins[open_], since, s.rate)
            yield pa.RecordBatch.from_arrays([pa.array(node[open_]), rest.column("row"), pa.array(g), rest.column("bins")], ["node", "row", "g", "bins"])

    def build(t: pa.Table) -> pa.Table:
        order = np.lexsort((t.column("g").to_numpy(), t.column("row").to_numpy()))  # sums do not depend on how rows arrive
        bins = np.concatenate([_bytes(c) for c in t.column("bins").chunks if len(c)])[order]
        node = t.column("node")[0].as_py()
        grown = grow(bins, t.column("g").to_numpy()[order], columns, int(room[node]), s)
        lists = [grown.feature, grown.bin, grown.left, grown.right, grown.value]
        return pa.table([pa.array([node]), *(pa.array([x], pa.list_(pa.float64() if x is grown.value else pa.int64())) for x in lists)], names)

    names = ["node", "feature", "bin", "left", "right", "value"]
    shape = "node long, feature array<long>, bin array<long>, left array<long>, right array<long>, value array<double>"
    picked = rows.mapInArrow(pick, "node long, row long, g double, bins binary")
    found = picked.groupBy("node").applyInArrow(build, shape).collect()
    return {r["node"]: Tree(*(list(r[c]) for c in names[1:])) for r in found}


def grow_tree(rows: DataFrame, width: int, total: float, since: list[Tree], s: Settings, number: int) -> Tree:
    """One tree on the stored rows: levels of large nodes by sums, the rest where its rows meet."""
    rng = np.random.default_rng([s.seed, number])
    columns = sorted(rng.choice(width, max(1, round(s.columns * width)), replace=False).tolist()) if s.columns < 1 else list(range(width))
    tree, large, small = Tree(), {}, {}

    def sort_in(node: int, n: float, depth: int) -> None:
        if depth:
            (large if n > LOCAL_ROWS else small)[node] = depth

    sort_in(0, total * s.rows, s.depth)
    while large:
        now, large = large, {}
        todo = list(now)
        parts = [histogram(rows, tree, todo[i : i + TOGETHER], columns, since, s, number) for i in range(0, len(todo), TOGETHER)]
        found = [r for cells in parts for r in best_splits(cells, s.penalty, s.min_child).collect()]  # a row per node with over LOCAL_ROWS rows
        for r in sorted(found, key=lambda r: r.node):
            sides = (r.left_g, r.left_h), (r.g - r.left_g, r.h - r.left_h)
            children = tree.split(r.node, r.feature, r.bin, tuple(-g / (h + s.penalty) for g, h in sides))
            for child, (_, h) in zip(children, sides):
                sort_in(child, h, now[r.node] - 1)
    if small:
        for node, other in sorted(_finish(rows, tree, small, columns, since, s, number).items()):
            tree.graft(node, other)
    return tree


# -- the model ------------------------------------------------------------------------


@dataclass
class Booster:
    edges: list[list[float]]
    base: float
    rate: float
    trees: list[Tree]
    #: Root mean squared errors on training and validation rows, one pair per tree that was tried.
    curve: list[tuple[float, float]]

    def transform(self, rows: DataFrame, features: str = "features", prediction: str = "prediction") -> DataFrame:
        """Add predictions. The model is bounded by its settings and is sent to the executors."""
        held = rows.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def predict(x):
            import pandas as pd

            return pd.Series(held.value.predict(np.stack(x.to_numpy())) if len(x) else [], dtype=float)

        return rows.withColumn(prediction, predict(_array(rows, features)))

    def predict(self, x: np.ndarray) -> np.ndarray:
        bins = np.stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(self.edges)], axis=1)
        return self.base + sum(self.rate * t.predict(bins) for t in self.trees)

    def loss_table(self, spark) -> DataFrame:
        """(iteration, train_loss, validation_loss, kept) of all trees that were tried."""
        rows = [(i + 1, a, b, i < len(self.trees)) for i, (a, b) in enumerate(self.curve)]
        return spark.createDataFrame(rows, "iteration int, train_loss double, validation_loss double, kept boolean")

    def nodes(self, spark) -> DataFrame:
        """The model as a table: tree, node, feature, edge (largest value that goes left), left, right, value."""
        rows = [
            (n, k, f if f >= 0 else None, self.edges[f][b] if f >= 0 else None, *((left, right) if f >= 0 else (None, None)), v)
            for n, t in enumerate(self.trees)
            for k, (f, b, left, right, v) in enumerate(zip(t.feature, t.bin, t.left, t.right, t.value))
        ]
        return spark.createDataFrame(rows, "tree int, node int, feature int, edge double, left int, right int, value double")


def _array(rows: DataFrame, features: str) -> Column:
    kind = rows.schema[features].dataType.simpleString()
    return vector_to_array(features) if kind == "vector" else F.col(features).cast("array<double>")


def _losses(rows: DataFrame, since: list[Tree], rate: float) -> tuple[float, float]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            squared = _left(batch, _cells(batch), since, rate) ** 2
            yield pa.RecordBatch.from_arrays([batch.column("valid"), pa.array(squared)], ["valid", "squared"])

    found = rows.mapInArrow(run, "valid boolean, squared double").groupBy("valid").agg(F.sqrt(F.avg("squared")).alias("x")).collect()
    by = {r.valid: r.x for r in found}
    return by.get(False, 0.0), by.get(True, float("inf"))


def _advanced(rows: DataFrame, since: list[Tree], rate: float) -> DataFrame:
    """The rows with the predictions of further trees put into ``margin``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = _left(batch, _cells(batch), since, rate) + batch.column("label").to_numpy()
            yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(margin))

    return rows.mapInArrow(run, rows.schema)


def fit(
    rows: DataFrame,
    settings: Settings = Settings(),
    features: str = "features",
    label: str = S.TARGET,
    validation: str | None = "is_validation",
    edges: list[list[float]] | None = None,
    keep: Sequence[str] = (),
) -> Booster:
    """Boosted trees on the rows that are not for validation; ``keep`` are further columns that tell rows apart.

    Without validation rows no tree is dropped. Rows without a label take no part.
    """
    given = rows.withColumn("_fl_x", _array(rows, features))
    learns = given.where(~F.coalesce(F.col(validation), F.lit(False))) if validation else given
    width, base, total = learns.agg(F.max(F.size("_fl_x")), F.avg(label), F.count(label)).first()
    if not total:
        raise ValueError("no rows to learn from")
    edges = edges or (quantile_edges(learns, "_fl_x", width) if total <= LOCAL_ROWS else P.quantile_edges(learns, "_fl_x", width, BINS))
    stored = settle(binned(given, "_fl_x", edges, label, validation, *keep).withColumn("margin", F.lit(float(base))), "binned")
    trees, since, curve = [], [], []
    best = 0
    for number in range(settings.trees):
        tree = grow_tree(stored, width, total, since, settings, number)
        trees.append(tree)
        since.append(tree)
        curve.append(_losses(stored, since, settings.rate))
        if curve[-1][1] < curve[best][1]:
            best = number
        elif number - best >= settings.patience and validation:
            break
        if len(since) == CHUNK:
            stored, since = settle(_advanced(stored, since, settings.rate), "margins"), []
    kept = trees[: best + 1] if validation and curve[best][1] < float("inf") else trees
    return Booster(edges, float(base), settings.rate, kept, curve)
