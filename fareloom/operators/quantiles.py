"""Exact order statistics that never gather a column into one task.

Spark's ``percentile``, ``median`` and ``mode`` keep every distinct value of a group in
one aggregation buffer, which a column of ratios over billions of rows does not allow.

``fit_quantiles`` searches by counting instead, however large the table is. The first pass
counts rows in cells of a signed logarithmic grid, a few thousand of them, which shows the cell
that holds each wanted rank. The next pass splits only those cells, evenly between their
own smallest and largest value, into ``CELLS`` cells each. A cell with a single value
ends the search; any other is split again. Values with few digits, such as money, need
two passes, arbitrary doubles three or four. Every pass is a scan in Arrow batches, in which a task
sorts some rows of a column at a time and adds up its own cells first, and no shuffle of rows; running sums
over the counts pick the cells of the wanted ranks, and only those cells reach the driver. ``quantiles_by`` does the same within the groups
of a key, all on the cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.functions.exprs import nan_to_null
from fareloom.session import settle, split_methods

CELLS = 4096
LOG_CELLS_PER_E = 64  # first-pass cells are about 1/64 wide, relative to the value
LOG_UNIT = 1e-4
SKETCH = 10000
#: Rows of one task that are sorted at a time.
BATCH = 1 << 16

Bracket = tuple[float, float]


def melt(t: DataFrame, cols: Sequence[str], by: Sequence[str] = (), kind: str = "double") -> DataFrame:
    """Long form: ``by`` + (column, value), one row per cell."""
    wide = t.select(*by, *[F.col(c).cast(kind).alias(c) for c in cols])
    return wide.unpivot(list(by), list(cols), "column", "value")


def value_counts(
    t: DataFrame, cols: Sequence[str], by: Sequence[str] = (), kind: str = "double"
) -> DataFrame:
    """``by`` + (column, value, n); nulls are not counted. A hot value is combined map-side."""
    return (
        melt(t, cols, by, kind)
        .where(F.col("value").isNotNull())
        .groupBy(*by, "column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def modes(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by`` + (column, mode, mode_count): the smallest of the most frequent values."""
    top = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value")))
    return (
        counts.groupBy(*by, "column")
        .agg(top.alias("top"), F.count(F.lit(1)).alias("distinct"), F.sum("n").alias("present"))
        .select(
            *by,
            "column",
            F.col("top.value").alias("mode"),
            (-F.col("top.neg")).alias("mode_count"),
            "distinct",
            "present",
        )
    )


def fit_modes(t: DataFrame, cols: Iterable[str], kind: str = "string") -> dict[str, object]:
    """Smallest most frequent value of each column: one scalar per column reaches the driver."""
    cols = list(cols)
    found = {r["column"]: r["mode"] for r in modes(value_counts(t, cols, kind=kind)).collect()}
    return {c: found.get(c) for c in cols}


def _disjoint(brackets: list[Bracket]) -> list[Bracket]:
    out: list[Bracket] = []
    for lo, hi in sorted(brackets):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _log_cell(v: Column) -> Column:
    """Grid of the first pass; never decreases as the value grows."""
    size = F.least(F.log1p(F.abs(v) / LOG_UNIT) * LOG_CELLS_PER_E, F.lit(1e6))
    return F.when(v < 0, -size).otherwise(size).cast("int")


def _grid(v: np.ndarray, brackets: list[Bracket]) -> np.ndarray:
    """Cells of sorted values: the logarithmic grid, or one cell below, between and above the brackets, ``CELLS`` inside each."""
    with np.errstate(over="ignore", invalid="ignore"):
        if not brackets:
            size = np.minimum(np.log1p(np.abs(v) / LOG_UNIT) * LOG_CELLS_PER_E, 1e6).astype(np.int64) + np.isinf(v)
            return np.where(v < 0, -size, size)
        lo, hi = np.array([*brackets, (np.inf, np.inf)]).T
        at = np.searchsorted(hi[:-1], v, "left")
        width = hi - lo
        share = (v - lo[at]) / np.where(width > 0, width, 1.0)[at]
        inside = np.minimum(np.floor(share * (CELLS - 1)), CELLS - 1)
        return at * (CELLS + 1) + np.where(v >= lo[at], 1 + np.nan_to_num(inside), 0).astype(np.int64)


Cells = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _count(v: np.ndarray, brackets: list[Bracket]) -> Cells:
    """Cell, rows, smallest and largest value of every cell that has rows."""
    v = np.sort(v) + 0.0  # without a negative zero
    cell = _grid(v, brackets)
    first = np.flatnonzero(np.diff(cell, prepend=cell[:1] - 1))
    n = np.diff(first, append=len(v))
    return cell[first], n, v[first], v[first + n - 1]


def _merge(a: Cells, b: Cells) -> Cells:
    cell, n, lo, hi = (np.concatenate(x) for x in zip(a, b))
    order = np.argsort(cell, kind="stable")
    cell, n, lo, hi = cell[order], n[order], lo[order], hi[order]
    first = np.flatnonzero(np.diff(cell, prepend=cell[:1] - 1))
    return cell[first], np.add.reduceat(n, first), np.minimum.reduceat(lo, first), np.maximum.reduceat(hi, first)


def _cell_counts(t: DataFrame, search: dict[str, list[Bracket]]) -> DataFrame:
    """(c, cell, n, lo, hi): rows and ends of the cells of every column, by its number; nulls are not counted."""
    grids = list(search.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[Cells | None] = [None] * len(grids)
        for batch in _joined(batches, BATCH):
            for i, brackets in enumerate(grids):
                v = batch.column(i).drop_null().to_numpy()
                if len(v):
                    counted = _count(v, brackets)
                    found[i] = counted if found[i] is None else _merge(found[i], counted)
        for i, cells in enumerate(found):
            if cells is not None:
                columns = [np.full(len(cells[0]), i, np.int32), *cells]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["c", "cell", "n", "lo", "hi"])

    parts = t.select(*search).mapInArrow(run, "c int, cell long, n long, lo double, hi double")
    return parts.groupBy("c", "cell").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def _joined(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches put together until they have ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _ranks(probs: Sequence[float], total: Column) -> Column:
    """The zero-based ranks on both sides of every quantile."""
    at = [F.lit(p) * (total - 1) for p in probs]
    return F.array_distinct(F.array(*[f(x).cast("long") for x in at for f in (F.floor, F.ceil)]))


def _pick(cells: DataFrame, keys: Sequence[str], ranks: Column) -> DataFrame:
    """``keys`` + (total, lo, hi, ranks): the cells that hold some of ``ranks``, and which."""
    whole = Window.partitionBy(*keys)
    counted = cells.withColumn("total", F.sum("n").over(whole)).withColumn("upto", F.sum("n").over(whole.orderBy("cell")))
    inside = F.filter(ranks, lambda k: (k >= F.col("upto") - F.col("n")) & (k < F.col("upto")))
    return counted.withColumn("ranks", inside).where(F.size("ranks") > 0).select(*keys, "total", "lo", "hi", "ranks")


def _wanted_cells(
    t: DataFrame, search: dict[str, list[Bracket]], probs: Sequence[float], ranks: dict[str, list[int]]
) -> dict[str, list]:
    """Cells of the wanted ranks: all that ``probs`` need in the first pass, ``ranks`` later."""
    counts = _cell_counts(t, search)
    names = list(search)
    if ranks:
        known = [F.array(*[F.lit(k).cast("long") for k in ranks[c]]) for c in names]
        wanted = F.get(F.array(*known), F.col("c"))
    else:
        wanted = _ranks(probs, F.col("total"))
    out: dict[str, list] = {c: [] for c in search}
    with split_methods(t.sparkSession):
        picked = _pick(counts, ["c"], wanted).collect()
    for r in picked:
        out[names[r["c"]]].append(r)
    return out


def fit_quantiles(
    t: DataFrame, cols: Iterable[str], probs: Sequence[float], exact: bool = True
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each column, nulls and NaN left out.

    ``exact=False`` returns the sketch values of one pass.
    """
    cols, probs = list(cols), [float(p) for p in probs]
    t = t.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in cols])
    if exact:
        return _search(t, cols, probs)
    row = t.agg(*[F.percentile_approx(c, probs, SKETCH) for c in cols]).first()
    return {c: row[i] or [None] * len(probs) for i, c in enumerate(cols)}


def values_at(t: DataFrame, ranks: dict[str, list[int]]) -> dict[str, dict[int, float]]:
    """The values at given zero-based ranks of each column, nulls and NaN left out; from one search."""
    t = t.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in ranks])
    return _values(t, list(ranks), [], ranks)[0]


def _search(t: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float | None]]:
    at, size = _values(t, cols, probs, {})
    return {
        c: [interpolate(at[c], p * (size[c] - 1)) if c in size else None for p in probs] for c in cols
    }


def _values(
    t: DataFrame, cols: list[str], probs: list[float], ranks: dict[str, list[int]]
) -> tuple[dict[str, dict[int, float]], dict[str, int]]:
    """Values by rank, and rows of each column that has some: the ranks that are given, or else those that ``probs`` need."""
    size: dict[str, int] = {}
    at: dict[str, dict[int, float]] = {c: {} for c in cols}
    search: dict[str, list[Bracket]] = {c: [] for c in cols if not ranks or ranks[c]}
    while search:
        narrower, left = {}, {}
        for c, cells in _wanted_cells(t, search, probs, ranks).items():
            for r in cells:
                size.setdefault(c, r["total"])
                if r["lo"] == r["hi"]:
                    at[c] |= dict.fromkeys(r["ranks"], r["lo"])
                else:
                    narrower.setdefault(c, []).append((r["lo"], r["hi"]))
                    left.setdefault(c, []).extend(r["ranks"])
        search, ranks = {c: _disjoint(b) for c, b in narrower.items()}, left
    return at, size


def interpolate(at: dict[int, float], pos: float) -> float:
    lo, hi = at[floor(pos)], at[ceil(pos)]
    return lo + (hi - lo) * (pos - floor(pos))


def quantiles_by(t: DataFrame, col: str, by: str, probs: Sequence[float]) -> DataFrame:
    """``by`` + quantiles: an array with the quantiles of ``col`` in every group, nulls of ``by`` a group.

    Groups without a value are left out. The brackets of the search are a table per group that is joined to
    the rows, so there may be any number of groups.
    """
    probs = [float(p) for p in probs]
    rows = t.select(F.col(by).alias("g"), nan_to_null(F.col(col).cast("double")).alias("v")).where("v is not null")
    kind = t.select(by).schema[0].dataType.simpleString()
    found = t.sparkSession.createDataFrame([], f"g {kind}, total long, k long, value double")
    celled, keys, ranks = rows.withColumn("cell", _log_cell(F.col("v"))), ["g"], _ranks(probs, F.col("total"))
    while True:
        counts = celled.groupBy(*keys, "cell").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        hits = settle(_pick(counts, keys, ranks), "quantile-cells")
        done = hits.where("lo = hi").select("g", "total", F.explode("ranks").alias("k"), F.col("lo").alias("value"))
        found = found.union(done)
        open_ = hits.where("lo < hi")
        if open_.isEmpty():
            break
        left = open_.groupBy("g").agg(
            F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("brackets"), F.flatten(F.collect_list("ranks")).alias("todo")
        )
        left = settle(left.withColumnRenamed("g", "_g"), "quantile-brackets")
        # Between two brackets is one cell; a bracket is split into CELLS.
        below = F.filter("brackets", lambda x: x["lo"] <= F.col("v"))
        last = F.get(below, F.size(below) - 1)
        share = (F.col("v") - last["lo"]) / (last["hi"] - last["lo"])
        inside = F.least(F.floor(share * (CELLS - 1)).cast("int"), F.lit(CELLS - 1))
        cell = F.size(below) * (CELLS + 1) + F.when(F.col("v") <= last["hi"], inside - CELLS).otherwise(0)
        celled = rows.join(left, F.col("g").eqNullSafe(F.col("_g"))).select("g", "todo", "v", cell.alias("cell"))
        keys, ranks = ["g", "todo"], F.col("todo")
    of = found.groupBy("g").agg(F.first("total").alias("total"), F.map_from_entries(F.collect_list(F.struct("k", "value"))).alias("at"))

    def at(p: float, f: Callable[[Column], Column]) -> Column:
        return F.element_at("at", f(F.lit(p) * (F.col("total") - 1)).cast("long"))

    def one(p: float) -> Column:
        place = F.lit(p) * (F.col("total") - 1)
        return at(p, F.floor) + (at(p, F.ceil) - at(p, F.floor)) * (place - F.floor(place))

    return of.select(F.col("g").alias(by), F.array(*[one(p) for p in probs]).alias("quantiles"))


def quantiles(
    t: DataFrame, cols: Sequence[str], probs: Sequence[float], exact: bool = True
) -> DataFrame:
    """(column, prob, value) as a table."""
    found = fit_quantiles(t, cols, probs, exact)
    rows = [(c, float(p), v) for c, vs in found.items() for p, v in zip(probs, vs)]
    return t.sparkSession.createDataFrame(rows, "column string, prob double, value double")
