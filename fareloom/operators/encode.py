"""Fitted encoders.

``fit_*`` learns from a training table and returns a small fitted value: plain numbers per
column, or a written lookup table for keys of unknown number. ``apply_*`` is a projection
(or one left join) that works on any table with the same columns, streams included.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.functions.exprs import clip
from fareloom.operators.profile import n_rows
from fareloom.operators.quantiles import fit_modes, fit_quantiles, melt
from fareloom.session import settle

#: Most categories of a column whose indicators are named on the driver; ``fit_category_table`` has no limit.
MAX_CATEGORIES = 10_000
#: Parts in which the categories of one column are numbered.
SLOT_BUCKETS = 256


# -- frequency of a key ---------------------------------------------------------------


def fit_frequencies(train: DataFrame, cols: Sequence[str]) -> dict[str, DataFrame]:
    """(key, freq) per column, with the missing key counted like any other."""
    return {
        c: settle(train.groupBy(F.col(c).alias(f"_key_{c}")).agg(n_rows().alias(f"{c}_freq")), f"freq-{c}")
        for c in cols
    }


def apply_frequencies(t: DataFrame, fitted: dict[str, DataFrame], unseen: int | None = 0) -> DataFrame:
    """Add ``{c}_freq``; keys absent from the fit get ``unseen``."""
    for c, table in fitted.items():
        key, freq = f"_key_{c}", f"{c}_freq"
        t = t.join(table, F.col(c).eqNullSafe(F.col(key)), "left").drop(key)
        if unseen is not None:
            t = t.withColumn(freq, F.coalesce(F.col(freq), F.lit(unseen).cast("bigint")))
    return t


def freq_encode(t: DataFrame, cols: Sequence[str] = ("PULocationID", "DOLocationID")) -> DataFrame:
    """Frequency within the table itself; a missing key stays missing."""
    out = apply_frequencies(t, fit_frequencies(t, cols), unseen=None)
    return out.withColumns({f"{c}_freq": F.when(F.col(c).isNotNull(), F.col(f"{c}_freq")) for c in cols})


# -- fill and scale -------------------------------------------------------------------


@dataclass(frozen=True)
class Standard:
    """Median fill, then mean 0 and population deviation 1."""

    median: dict[str, float]
    mean: dict[str, float]
    sd: dict[str, float]

    def expr(self, c: str) -> Column:
        x = F.coalesce(F.col(c).cast("double"), F.lit(self.median[c]))
        return (x - F.lit(self.mean[c])) / F.lit(self.sd[c] or 1.0)


def _moments(t: DataFrame, cols: Sequence[str]) -> dict[str, tuple]:
    """Rows, present values, mean and population deviation of each column, from one scan."""
    rows = (
        melt(t, cols)
        .groupBy("column")
        .agg(n_rows(), F.count("value"), F.avg("value"), F.stddev_pop("value"))
        .collect()
    )
    return {r[0]: tuple(r)[1:] for r in rows}


def fit_standard(train: DataFrame, cols: Sequence[str], exact: bool = True) -> Standard:
    """One scan when nothing is missing; columns with gaps are filled and measured again."""
    found = _moments(train, cols)
    gaps = [c for c, (rows, present, *_) in found.items() if present < rows]
    median = dict.fromkeys(cols, 0.0)
    if gaps:
        medians = fit_quantiles(train, gaps, (0.5,), exact)
        median.update({c: medians[c][0] or 0.0 for c in gaps})
        filled = [F.coalesce(F.col(c).cast("double"), F.lit(median[c])).alias(c) for c in gaps]
        found.update(_moments(train.select(*filled), gaps))
    return Standard(
        median,
        {c: found[c][2] or 0.0 if c in found else 0.0 for c in cols},
        {c: found[c][3] or 0.0 if c in found else 0.0 for c in cols},
    )


def apply_standard(t: DataFrame, fitted: Standard) -> DataFrame:
    return t.withColumns({c: fitted.expr(c) for c in fitted.mean})


def fit_robust(train: DataFrame, cols: Sequence[str], exact: bool = True) -> dict[str, list[float]]:
    return fit_quantiles(train, cols, (0.25, 0.5, 0.75), exact)


def apply_robust(t: DataFrame, fitted: dict[str, list[float]]) -> DataFrame:
    """Centre on the median and divide by the interquartile range (by 1 where that is 0)."""
    out = {}
    for c, (q1, q2, q3) in fitted.items():
        if q2 is None:
            out[c] = F.lit(None).cast("double")
        else:
            out[c] = (F.col(c) - F.lit(q2)) / F.lit((q3 - q1) or 1.0)
    return t.withColumns(out)


def fit_caps(
    train: DataFrame, cols: Sequence[str], lower: float = 0.01, upper: float = 0.99, exact: bool = True
) -> dict[str, list[float]]:
    return fit_quantiles(train, cols, (lower, upper), exact)


def apply_caps(t: DataFrame, fitted: dict[str, list[float]]) -> DataFrame:
    """Limit each column to its fitted percentiles; missing stays missing."""
    return t.withColumns({c: clip(F.col(c).cast("double"), lo, hi) for c, (lo, hi) in fitted.items() if lo is not None})


@dataclass(frozen=True)
class Gaps:
    """Fill values for missing cells."""

    median: dict[str, float]
    text: dict[str, str] = field(default_factory=dict)


def fit_gaps(
    train: DataFrame, numeric: Sequence[str], text: Sequence[str] = (), word: str = "MISSING", exact: bool = True
) -> Gaps:
    found = fit_quantiles(train, numeric, (0.5,), exact) if numeric else {}
    return Gaps({c: q[0] or 0.0 for c, q in found.items()}, dict.fromkeys(text, word))


def apply_gaps(t: DataFrame, fitted: Gaps, indicator: bool = True) -> DataFrame:
    """Median for missing numbers, with a ``_is_missing`` flag; a word for missing text."""
    out: dict[str, Column] = {}
    for c, m in fitted.median.items():
        if indicator:
            out[f"{c}_is_missing"] = F.col(c).isNull().cast("int")
        out[c] = F.coalesce(F.col(c).cast("double"), F.lit(m))
    for c, word in fitted.text.items():
        out[c] = F.coalesce(F.col(c).cast("string"), F.lit(word))
    return t.withColumns(out)


def mode_fill(t: DataFrame, cols: Sequence[str] = ("passenger_count",), default: float = 1.0) -> DataFrame:
    """Most frequent value, the smallest on a tie, for missing numbers."""
    found = fit_modes(t, cols, kind="double")
    return t.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(default if m is None else m).cast(t.schema[c].dataType))
            for c, m in found.items()
        }
    )


# -- one-hot --------------------------------------------------------------------------


@dataclass(frozen=True)
class Categories:
    """Fill value and sorted category list of each column."""

    fill: dict[str, str]
    known: dict[str, list[str]]

    def expr(self, c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(self.fill[c]))


def fit_categories(
    train: DataFrame, cols: Sequence[str], fill: str | None = None, max_categories: int = MAX_CATEGORIES
) -> Categories:
    """Learn the categories of each column.

    Missing values become ``fill``, or the most frequent value when it is None. A column
    with more than ``max_categories`` values is refused rather than cut short:
    such keys have ``fit_category_table``, or are encoded by frequency.
    """
    counts = settle(melt(train, cols, kind="string").groupBy("column", "value").agg(n_rows().alias("n")), "category-counts")
    for r in counts.groupBy("column").agg(F.count("value").alias("n")).collect():
        if r["n"] > max_categories:
            raise ValueError(f"{r['column']} has {r['n']} categories, more than {max_categories}")
    rows = counts.collect()
    known: dict[str, list[str]] = {}
    fills: dict[str, str] = {}
    for c in cols:
        mine = {r["value"]: r["n"] for r in rows if r["column"] == c and r["value"] is not None}
        gap = any(r["column"] == c and r["value"] is None for r in rows)
        fills[c] = fill if fill is not None else min(mine, key=lambda v: (-mine[v], v), default="")
        known[c] = sorted(set(mine) | ({fills[c]} if gap else set()))
    return Categories(fills, known)


def fit_category_table(train: DataFrame, cols: Sequence[str], fill: str | None = None) -> DataFrame:
    """(column, category, slot, fill) for columns with any number of categories, as a stored table.

    Missing values become ``fill``, or the most frequent value, on a tie the first by name, when it is None. Slots
    number a column's categories from 0, in the order of a hash bucket and then of the category: numbers within a
    bucket and counts of the buckets before it, so no column meets in one task.
    """
    counts = settle(melt(train, cols, kind="string").groupBy("column", "value").agg(n_rows().alias("n")), "category-counts")
    present = counts.where("value is not null")
    if fill is None:
        top = present.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("fill"))
    else:
        top = counts.select("column", F.lit(fill).alias("fill")).distinct()
    gaps = counts.where("value is null").join(top, "column").select("column", F.col("fill").alias("category"))
    found = present.select("column", F.col("value").alias("category")).union(gaps).distinct()
    found = found.withColumn("bucket", F.pmod(F.xxhash64("category"), F.lit(SLOT_BUCKETS)))
    inside = F.row_number().over(Window.partitionBy("column", "bucket").orderBy("category")) - 1
    sizes = found.groupBy("column", "bucket").agg(n_rows().alias("n"))
    upto = Window.partitionBy("column").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("column", "bucket", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    slots = found.withColumn("inside", inside).join(before, ["column", "bucket"])
    numbered = slots.select("column", "category", (F.col("before") + F.col("inside")).cast("long").alias("slot"))
    return settle(numbered.join(top, "column", "left"), "category-table")


def onehot_rows(t: DataFrame, table: DataFrame, cols: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """``ids`` + (column, category, slot, value = 1), one row per set indicator; an unseen category sets none.

    The category table is joined, not held on the driver; its size decides how. Columns of up to ``MAX_CATEGORIES``
    categories, each of which may hold a good part of the rows, are joined to a table of their own: it is small, so
    that no task has to sort all rows of one category.
    """
    known = table.groupBy("column").agg(F.first("fill").alias("fill"), n_rows().alias("n")).collect()  # one per column
    fills, few = {r["column"]: r["fill"] for r in known}, {r["column"] for r in known if r["n"] <= MAX_CATEGORIES}
    out = None
    for part in ([c for c in cols if c in few], [c for c in cols if c not in few]):
        if not part:
            continue
        held = table.drop("fill").where(F.col("column").isin(part))
        held = settle(held, "few-categories") if part[0] in few else held
        cells = [F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit(fills.get(c))).alias("category")) for c in part]
        rows = t.select(*ids, F.inline(F.array(*cells))).join(held, ["column", "category"]).select(*ids, "column", "category", "slot", F.lit(1).alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


def onehot_vectors(t: DataFrame, table: DataFrame, cols: Sequence[str], ids: Sequence[str], output: str = "features") -> DataFrame:
    """``ids`` + a sparse vector as (size, indices, values), the columns' slots one after the other in the order of ``cols``."""
    widths = {r["column"]: r["n"] for r in table.groupBy("column").agg(n_rows().alias("n")).collect()}
    begin, total = {}, 0
    for c in cols:
        begin[c], total = total, total + widths.get(c, 0)
    shift = F.create_map(*[F.lit(x) for c in cols for x in (c, begin[c])])[F.col("column")]
    rows = onehot_rows(t, table, cols, ids).select(*ids, (F.col("slot") + shift).alias("at"))
    held = F.array_sort(F.collect_list("at"))
    return rows.groupBy(*ids).agg(F.struct(F.lit(total).alias("size"), held.alias("indices"), F.transform(held, lambda _: F.lit(1.0)).alias("values")).alias(output))


def onehot_long(
    t: DataFrame, fitted: Categories, ids: Sequence[str], drop_first: bool = False
) -> DataFrame:
    """``ids`` + (column, category, value = 1), one row per set indicator; unseen sets none."""
    cells = []
    for c, known in fitted.known.items():
        kept = known[1:] if drop_first else known
        x = fitted.expr(c)
        cells.append(F.struct(F.lit(c).alias("column"), F.when(x.isin(kept), x).alias("category")))
    return (
        t.select(*ids, F.inline(F.array(*cells)))
        .where(F.col("category").isNotNull())
        .withColumn("value", F.lit(1))
    )


def onehot_wide(t: DataFrame, fitted: Categories, drop_first: bool = False) -> DataFrame:
    """One 0/1 column ``{c}={category}`` per category."""
    out = {}
    for c, known in fitted.known.items():
        for k in known[1:] if drop_first else known:
            out[f"{c}={k}"] = (fitted.expr(c) == F.lit(k)).cast("int")
    return t.withColumns(out)

