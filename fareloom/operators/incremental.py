"""Reports that grow with appended periods.

Each period leaves one small row per column: counts and moments, and two mergeable sketches, of quantiles (KLL) and of
distinct values (HLL). A report over any set of periods merges their rows, so a new period costs one scan of that
period alone. Counts, sums, smallest and largest values are exact; quantiles and distinct counts are approximate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.functions.exprs import ratio

#: Size of the quantile sketch (rank error of about 0.7 %), and logarithm of the buckets of the distinct sketch (about 0.8 %).
KLL_K, HLL_LOG = 400, 14


def _distinct_key(c: str, kind: str) -> Column:
    """Text that tells values apart; zero and minus zero are one, NaN is missing."""
    x = F.col(c)
    return F.when(~F.isnan(x), x + 0.0).cast("string") if kind in ("double", "float") else x.cast("string")


def period_states(t: DataFrame, period: Column, cols: Sequence[str], distinct: Sequence[str] = ()) -> DataFrame:
    """(period, column, n, mean, m2, low, high, quantiles, values) from one scan; ``m2`` sums squared distances from the mean.

    ``cols`` are numbers. Further columns of any type are only counted, with their distinct values.
    """
    kinds = {f.name: f.dataType.simpleString() for f in t.schema.fields}
    aggs, rows = [], []
    for i, c in enumerate(dict.fromkeys([*cols, *distinct])):
        x = F.col(c).cast("double") if c in cols else F.lit(None).cast("double")
        x = F.when(~F.isnan(x), x)
        seen = _distinct_key(c, kinds[c])
        aggs += [F.count(seen).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), (F.var_pop(x) * F.count(x)).alias(f"m2{i}")]
        aggs += [F.min(x).alias(f"low{i}"), F.max(x).alias(f"high{i}"), F.kll_sketch_agg_double(x, KLL_K).alias(f"q{i}"), F.hll_sketch_agg(seen, HLL_LOG).alias(f"d{i}")]
        names = {"n": "n", "mean": "mean", "m2": "m2", "low": "low", "high": "high", "q": "quantiles", "d": "values"}
        rows.append(F.struct(F.lit(c).alias("column"), *[F.col(f"{a}{i}").alias(b) for a, b in names.items()]))
    return t.groupBy(period.alias("period")).agg(*aggs).select("period", F.inline(F.array(*rows)))


def merged(states: DataFrame, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column, count, mean, std, min, max, p.., distinct) over all periods of ``states``."""
    by = Window.partitionBy("column")
    total = F.sum("n").over(by)
    mean = ratio(F.sum(F.col("n") * F.col("mean")).over(by), F.sum(F.when(F.col("mean").isNotNull(), F.col("n"))).over(by))
    spread = F.col("m2") + F.col("n") * (F.col("mean") - F.col("all")) * (F.col("mean") - F.col("all"))
    placed = states.withColumn("all", mean).withColumn("total", total).withColumn("spread", spread)
    found = placed.groupBy("column").agg(
        F.max("total").alias("count"),
        F.max("all").alias("mean"),
        F.sqrt(ratio(F.sum("spread"), F.max("total") - 1)).alias("std"),
        F.min("low").alias("min"),
        F.max("high").alias("max"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_sketch_estimate(F.hll_union_agg("values")).alias("distinct"),
    )
    some = F.kll_sketch_get_n_double("quantiles") > 0
    at = [F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(r))).alias(f"p{round(100 * r)}") for r in ranks]
    return found.select("column", "count", "mean", "std", "min", "max", *at, "distinct")


def rank_of(states: DataFrame, column: str, value: float) -> DataFrame:
    """(rank): the approximate share of a column's values up to ``value``."""
    whole = states.where(F.col("column") == column).agg(F.kll_merge_agg_double("quantiles").alias("q"))
    return whole.select(F.kll_sketch_get_rank_double("q", F.lit(float(value))).alias("rank"))
