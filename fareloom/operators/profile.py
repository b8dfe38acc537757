"""Profiling reports.

A report is one aggregation over all its columns, whatever their number, so it scans the
table once; medians and quartiles come from ``quantiles`` and enter as plain numbers.
Only already aggregated rows are ever sorted or compared with a total.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom import schema as S
from fareloom.functions.exprs import any_null, minutes_between, percent, ratio
from fareloom.functions.features import DURATION, speed_mph
from fareloom.operators.quantiles import (
    fit_quantiles,
    quantiles_by,
    modes,
    value_counts,
)

#: Rows at which ``near_constant`` looks first.
FEW_ROWS = 1000


def n_rows() -> Column:
    return F.count(F.lit(1))


def number(x: float | None) -> Column:
    return F.lit(x).cast("double")


def per_column(
    t: DataFrame, cols: Iterable[str], stats: Callable[[str], dict[str, Column]], name: str = "column"
) -> DataFrame:
    """One row per column out of a single aggregation of the whole table."""
    cols = list(cols)
    rows = [
        F.struct(F.lit(c).alias(name), *[e.alias(n) for n, e in stats(c).items()]).alias(f"_{i}")
        for i, c in enumerate(cols)
    ]
    return t.agg(*rows).select(F.inline(F.array(*[f"_{i}" for i in range(len(cols))])))


def with_pct(counts: DataFrame, n: str = "n", name: str = "pct") -> DataFrame:
    """Share of the total of already aggregated counts, from a scalar subquery (no window)."""
    return counts.withColumn(name, percent(F.col(n), counts.agg(F.sum(n)).scalar()))


# -- whole-table summaries ------------------------------------------------------------


def describe_numeric(t: DataFrame, cols: Sequence[str] = tuple(S.KEY_NUMERIC), exact: bool = True) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of each column."""
    q = fit_quantiles(t, cols, (0.25, 0.5, 0.75), exact)
    return per_column(
        t,
        cols,
        lambda c: {
            "count": F.count(c),
            "mean": F.avg(c),
            "std": F.stddev_samp(c),
            "min": F.min(c).cast("double"),
            "p25": number(q[c][0]),
            "p50": number(q[c][1]),
            "p75": number(q[c][2]),
            "max": F.max(c).cast("double"),
        },
    )


def describe_categorical(
    t: DataFrame, cols: Sequence[str] = ("store_and_fwd_flag", "VendorID", "payment_type", "RatecodeID")
) -> DataFrame:
    """Present values, distinct values, the most frequent one and how often it occurs."""
    counts = value_counts(t, cols, kind="string")
    return modes(counts).select(
        "column",
        F.col("present").alias("count"),
        F.col("distinct").alias("unique"),
        F.col("mode").alias("top"),
        F.col("mode_count").alias("freq"),
    )


def shape_stats(t: DataFrame, cols: Sequence[str] = tuple(S.KEY_NUMERIC), exact: bool = True) -> DataFrame:
    """Median, mode, bias-corrected skewness and excess kurtosis of each column."""
    q = fit_quantiles(t, cols, (0.5,), exact)
    whole = {f.name for f in t.schema.fields if isinstance(f.dataType, T.IntegralType)}
    top = {}
    # Integers are counted as integers, since above 2^53 several of them are one double.
    for kind, part in (("double", [c for c in cols if c not in whole]), ("decimal(20,0)", [c for c in cols if c in whole])):
        if part:
            top |= {r["column"]: r["mode"] for r in modes(value_counts(t, part, kind=kind)).collect()}

    def stats(c: str) -> dict[str, Column]:
        n = F.count(c).cast("double")
        # A constant column has no shape; Spark's own moments would divide by zero there.
        spread = F.min(c) < F.max(c)
        skew = F.when(spread, F.skewness(c)) * F.sqrt(n * (n - 1))
        kurt = (F.when(spread, F.kurtosis(c)) * (n + 1) + 6) * (n - 1)
        return {
            "median": number(q[c][0]),
            "mode": number(None if (m := top.get(c)) is None else float(m)),
            "skewness": ratio(skew, n - 2),
            "kurtosis": ratio(kurt, (n - 2) * (n - 3)),
        }

    return per_column(t, cols, stats)


def iqr_outliers(
    t: DataFrame, cols: Sequence[str] = tuple(S.OUTLIER_COLUMNS), k: float = 1.5, exact: bool = True
) -> DataFrame:
    """Fences at ``k`` interquartile ranges and what lies beyond them."""
    q = fit_quantiles(t, cols, (0.25, 0.75), exact)

    def stats(c: str) -> dict[str, Column]:
        q1, q3 = q[c]
        lo, hi = (None, None) if q1 is None else (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
        beyond = F.when((F.col(c) < number(lo)) | (F.col(c) > number(hi)), F.col(c))
        return {
            "lower_bound": number(lo),
            "upper_bound": number(hi),
            "outliers": F.count(beyond),
            "outlier_pct": percent(F.count(beyond), n_rows()),
            "min_outlier": F.min(beyond),
            "max_outlier": F.max(beyond),
        }

    return per_column(t, cols, stats)


def value_dist(
    t: DataFrame,
    cols: Sequence[str] = ("VendorID", "payment_type", "RatecodeID", "store_and_fwd_flag"),
) -> DataFrame:
    """Count of each present value and its share of all rows, missing ones included."""
    rows = t.agg(n_rows().alias("n")).scalar()
    return value_counts(t, cols, kind="string").withColumn("pct", percent(F.col("n"), rows))


def group_means(t: DataFrame, by: Column, cols: Sequence[str] = tuple(S.COMPARED_COLUMNS), name: str = "grp") -> DataFrame:
    return t.groupBy(by.alias(name)).agg(*[F.avg(c).alias(f"mean_{c}") for c in cols])


def group_dist(
    t: DataFrame, by: Column, col: str, values: Sequence, name: str = "grp"
) -> DataFrame:
    """Per cent of each listed value within each group, zero where absent, the rest in ``other``.

    The value list is given, so no extra job looks for it; the counts are conditional
    sums of one pass.
    """
    listed = [F.count_if(F.col(col) == v) for v in values]
    present = F.count(col)
    rest = present - sum(listed[1:], listed[0])
    return t.groupBy(by.alias(name)).agg(
        *[F.coalesce(percent(n, present), F.lit(0.0)).alias(f"pct_{v}") for n, v in zip(listed, values)],
        F.coalesce(percent(rest, present), F.lit(0.0)).alias("pct_other"),
    )


def target_dist(t: DataFrame, target: str = S.TARGET, exact: bool = True) -> DataFrame:
    """Size, spread and sign of the target, missing values left out."""
    y = F.col(target)
    n = F.count(target)
    (median,) = fit_quantiles(t, [target], (0.5,), exact)[target]
    return t.agg(
        n.alias("n"),
        F.min(target).alias("min"),
        F.max(target).alias("max"),
        F.avg(target).alias("mean"),
        number(median).alias("median"),
        F.stddev_samp(target).alias("std"),
        F.count_if(y < 0).alias("negative"),
        percent(F.count_if(y < 0), n).alias("negative_pct"),
        F.count_if(y < -1).alias("below_minus_one"),
        F.count_if((y >= -1) & (y < 0)).alias("minus_one_to_zero"),
        F.count_if(y == 0).alias("zero"),
        F.count_if(y > 0).alias("positive"),
    )


def input_stats(
    t: DataFrame, cols: Sequence[str] = ("trip_distance", "fare_amount", "passenger_count")
) -> DataFrame:
    """Row count and the range and mean of the main inputs of a batch."""
    return per_column(
        t, cols, lambda c: {"rows": n_rows(), "min": F.min(c), "max": F.max(c), "mean": F.avg(c)}
    )


def prediction_stats(t: DataFrame, prediction: str = S.PREDICTED, exact: bool = True) -> DataFrame:
    """Mean, population deviation, range, median and number of predictions."""
    (median,) = fit_quantiles(t, [prediction], (0.5,), exact)[prediction]
    return t.agg(
        F.avg(prediction).alias("prediction_mean"),
        F.stddev_pop(prediction).alias("prediction_std"),
        F.min(prediction).alias("prediction_min"),
        F.max(prediction).alias("prediction_max"),
        number(median).alias("prediction_median"),
        F.count(prediction).alias("n_predictions"),
    )


# -- time -----------------------------------------------------------------------------


def date_range(t: DataFrame, pickup: str = S.PICKUP, dropoff: str = S.DROPOFF) -> DataFrame:
    return t.agg(
        F.min(pickup).alias("first_pickup"),
        F.max(pickup).alias("last_pickup"),
        F.min(dropoff).alias("first_dropoff"),
        F.max(dropoff).alias("last_dropoff"),
    )


def duration_stats(t: DataFrame, short: float = 1.0, long: float = 120.0, exact: bool = True) -> DataFrame:
    t = t.select(minutes_between(S.PICKUP, S.DROPOFF).alias(DURATION))
    (median,) = fit_quantiles(t, [DURATION], (0.5,), exact)[DURATION]
    d = F.col(DURATION)
    return t.agg(
        F.avg(d).alias("mean"),
        number(median).alias("median"),
        F.min(d).alias("min"),
        F.max(d).alias("max"),
        F.stddev_samp(d).alias("std"),
        F.count_if(d < short).alias("very_short"),
        percent(F.count_if(d < short), n_rows()).alias("very_short_pct"),
        F.count_if(d > long).alias("very_long"),
        percent(F.count_if(d > long), n_rows()).alias("very_long_pct"),
    )


def hourly_dist(t: DataFrame, ts: str = S.PICKUP) -> DataFrame:
    return t.groupBy(F.hour(ts).alias("pickup_hour")).agg(n_rows().alias("trips"))


def peak_hours(t: DataFrame, ts: str = S.PICKUP) -> DataFrame:
    """Busiest and quietest hour; the earlier one wins a tie."""
    return _extremes(hourly_dist(t, ts), "pickup_hour", "trips", "peak_hour", "lowest_hour")


def _extremes(counts: DataFrame, key: str, n: str, most: str, least: str) -> DataFrame:
    high = F.max(F.struct(F.col(n).alias("n"), (-F.col(key)).alias("k")))
    low = F.min(F.struct(F.col(n).alias("n"), F.col(key).alias("k")))
    return counts.agg(high.alias("h"), low.alias("l")).select(
        (-F.col("h.k")).alias(most),
        F.col("h.n").alias(f"{most}_trips"),
        F.col("l.k").alias(least),
        F.col("l.n").alias(f"{least}_trips"),
    )


def day_name(weekday: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in S.DAY_NAMES]), weekday + 1)


def dow_dist(t: DataFrame, ts: str = S.PICKUP) -> DataFrame:
    counts = t.groupBy(F.weekday(ts).alias("pickup_dayofweek")).agg(n_rows().alias("trips"))
    return with_pct(counts, "trips").withColumn("day", day_name(F.col("pickup_dayofweek")))


def daily_dist(t: DataFrame, ts: str = S.PICKUP) -> DataFrame:
    """Trips per day of the month: smallest, largest and mean count, busiest and quietest day."""
    counts = t.groupBy(F.dayofmonth(ts).alias("pickup_day")).agg(n_rows().alias("trips"))
    high = F.max(F.struct(F.col("trips").alias("n"), (-F.col("pickup_day")).alias("k")))
    low = F.min(F.struct(F.col("trips").alias("n"), F.col("pickup_day").alias("k")))
    return counts.agg(
        n_rows().alias("days"), F.avg("trips").alias("mean_trips"), high.alias("h"), low.alias("l")
    ).select(
        "days",
        "mean_trips",
        (-F.col("h.k")).alias("busiest_day"),
        F.col("h.n").alias("most_trips"),
        F.col("l.k").alias("quietest_day"),
        F.col("l.n").alias("least_trips"),
    )


def hourly_means(t: DataFrame, ts: str = S.PICKUP) -> DataFrame:
    """Mean distance, fare, total and duration by pickup hour."""
    t = t.withColumn(DURATION, minutes_between(S.PICKUP, S.DROPOFF))
    return t.groupBy(F.hour(ts).alias("pickup_hour")).agg(
        *[F.avg(c).alias(f"mean_{c}") for c in S.COMPARED_COLUMNS]
    )


# -- places ---------------------------------------------------------------------------


def location_report(t: DataFrame, pickup: str = "PULocationID", dropoff: str = "DOLocationID") -> DataFrame:
    """Distinct zones, id range and trips that end where they began."""
    same = F.count_if(F.col(pickup) == F.col(dropoff))
    return t.agg(
        n_rows().alias("trips"),
        F.count_distinct(pickup).alias("pickup_zones"),
        F.min(pickup).alias("pickup_min"),
        F.max(pickup).alias("pickup_max"),
        F.count_distinct(dropoff).alias("dropoff_zones"),
        F.min(dropoff).alias("dropoff_min"),
        F.max(dropoff).alias("dropoff_max"),
        same.alias("same_zone"),
        percent(same, n_rows()).alias("same_zone_pct"),
    )


def top_locations(t: DataFrame, col: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent zones and their share of all trips; lower id first on a tie."""
    counts = t.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("zone")).agg(n_rows().alias("trips"))
    rows = t.agg(n_rows()).scalar()
    return (
        counts.orderBy(F.desc("trips"), "zone")
        .limit(n)
        .select(F.lit(col).alias("column"), "zone", "trips", percent(F.col("trips"), rows).alias("pct"))
    )


# -- money ----------------------------------------------------------------------------


def money_stats(t: DataFrame, cols: Sequence[str] = ("fare_amount", "total_amount"), exact: bool = True) -> DataFrame:
    q = fit_quantiles(t, cols, (0.5,), exact)
    return per_column(
        t,
        cols,
        lambda c: {
            "mean": F.avg(c),
            "median": number(q[c][0]),
            "min": F.min(c),
            "max": F.max(c),
            "std": F.stddev_samp(c),
        },
    )


def tip_report(t: DataFrame, exact: bool = True) -> DataFrame:
    """How many trips tip or pay tolls, how much, and the tip as per cent of the fare."""
    tip, tolls = F.col("tip_amount"), F.col("tolls_amount")
    t = t.select(
        tip,
        tolls,
        F.when(tip > 0, tip).alias("given"),
        (ratio("tip_amount", "fare_amount") * 100).alias("share"),
    )
    q = fit_quantiles(t, ("given", "share"), (0.5,), exact)
    return t.agg(
        F.count_if(tip == 0).alias("no_tip"),
        percent(F.count_if(tip == 0), n_rows()).alias("no_tip_pct"),
        F.count("given").alias("with_tip"),
        percent(F.count("given"), n_rows()).alias("with_tip_pct"),
        F.avg("given").alias("mean_tip"),
        number(q["given"][0]).alias("median_tip"),
        F.avg("share").alias("mean_tip_percentage"),
        number(q["share"][0]).alias("median_tip_percentage"),
        F.count_if(tolls > 0).alias("with_tolls"),
        percent(F.count_if(tolls > 0), n_rows()).alias("with_tolls_pct"),
        F.avg(F.when(tolls > 0, tolls)).alias("mean_toll"),
    )


def tip_by_payment(t: DataFrame, by: str = "payment_type", col: str = "tip_amount", exact: bool = True) -> DataFrame:
    """Mean, median and count of the tip for each payment code; ``exact=False`` takes the median from a sketch."""
    mean, count = F.avg(col).alias("mean"), F.count(col).alias("count")
    if not exact:
        return t.groupBy(by).agg(mean, F.percentile_approx(col, 0.5).cast("double").alias("median"), count)
    plain = t.groupBy(by).agg(mean, count)
    median = quantiles_by(t, col, by, (0.5,)).select(F.col(by).alias("_by"), F.get("quantiles", F.lit(0)).alias("median"))
    return plain.join(median, F.col(by).eqNullSafe(F.col("_by")), "left").select(by, "mean", "median", "count")


def speed_report(t: DataFrame, slow: float = 30.0, fast: float = 80.0, exact: bool = True) -> DataFrame:
    """Speed and revenue per mile where defined, and what stays under two speed limits."""
    t = t.select(
        speed_mph(minutes=minutes_between(S.PICKUP, S.DROPOFF)).alias("speed"),
        ratio("total_amount", "trip_distance").alias("revenue"),
    )
    q = fit_quantiles(t, ("speed", "revenue"), (0.5,), exact)
    v = F.col("speed")
    return t.agg(
        F.avg(v).alias("mean_speed"),
        number(q["speed"][0]).alias("median_speed"),
        F.max(v).alias("max_speed"),
        F.count_if(v <= slow).alias("slow_trips"),
        F.avg(F.when(v <= slow, v)).alias("slow_mean"),
        F.count_if(v <= fast).alias("plausible_trips"),
        F.avg(F.when(v <= fast, v)).alias("plausible_mean"),
        F.avg("revenue").alias("mean_revenue_per_mile"),
        number(q["revenue"][0]).alias("median_revenue_per_mile"),
    )


def trip_summary(t: DataFrame) -> DataFrame:
    return t.agg(
        n_rows().alias("trips"),
        F.sum("total_amount").alias("revenue"),
        F.avg("trip_distance").alias("mean_distance"),
        F.avg(minutes_between(S.PICKUP, S.DROPOFF)).alias("mean_duration"),
        F.avg("fare_amount").alias("mean_fare"),
        F.avg("total_amount").alias("mean_total"),
    )


# -- features -------------------------------------------------------------------------


def feature_profile(t: DataFrame, groups: dict[str, list[str]] | None = None) -> DataFrame:
    """Missing share and distinct values of every feature, by feature group."""
    groups = groups or S.FEATURE_GROUPS
    have = set(t.columns)
    group_of = {c: g for g, cols in groups.items() for c in cols if c in have}
    cols = list(group_of)
    missing = per_column(
        t,
        cols,
        lambda c: {
            "missing": F.count_if(F.col(c).isNull()),
            "missing_pct": percent(F.count_if(F.col(c).isNull()), n_rows()),
        },
    )
    distinct = distinct_counts(t, cols)
    name = F.lit(None).cast("string")
    for g in groups:
        name = F.when(F.col("column").isin([c for c in cols if group_of[c] == g]), g).otherwise(name)
    return missing.join(distinct, "column", "left").select(
        name.alias("feature_group"),
        F.col("column").alias("feature"),
        "missing",
        "missing_pct",
        F.coalesce("distinct", F.lit(0)).alias("distinct"),
    )


def distinct_counts(t: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, distinct): exact count of present values, numbers compared as numbers.

    Integers are compared as integers, since above 2^53 several of them are one double.
    """
    text = {f.name for f in t.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))}
    whole = {f.name for f in t.schema.fields if isinstance(f.dataType, T.IntegralType)}
    out = None
    for kind, part in (
        ("double", [c for c in cols if c not in text | whole]),
        ("decimal(20,0)", [c for c in cols if c in whole]),
        ("string", [c for c in cols if c in text]),
    ):
        if part:
            found = value_counts(t, part, kind=kind).groupBy("column").agg(n_rows().alias("distinct"))
            out = found if out is None else out.unionByName(found)
    return out


def feature_variance(t: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Population variance and coefficient of variation, missing counted as zero, lowest first.

    The raw variance is ranked: after standardising, every column would score one.
    """
    filled = t.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    return per_column(
        filled,
        cols,
        lambda c: {
            "variance": F.var_pop(c),
            "variation": ratio(F.stddev_pop(c), F.abs(F.avg(c))),
        },
        name="feature",
    ).orderBy("variance", "feature")


def near_constant(t: DataFrame, cols: Sequence[str], top_share: float = 0.99) -> DataFrame:
    """Features with at most one value, or with two of which one holds over ``top_share``.

    Two values are all there is exactly when every present row equals the minimum or the
    maximum, so plain aggregates answer this and no value list is built. A column of which a few rows
    already show three values is none of them, and is not aggregated.
    """
    plain = [c for c in cols if isinstance(t.schema[c].dataType, (T.NumericType, T.StringType, T.BooleanType))]
    few = t.select(*plain).limit(FEW_ROWS).collect() if plain else []
    seen = {c: {"NaN" if r[c] != r[c] else r[c] for r in few} - {None} for c in plain}
    cols = [c for c in cols if len(seen.get(c, ())) < 3]
    if not cols:
        return t.sparkSession.createDataFrame([], "feature string, distinct int, top_share double")
    ends = t.agg(*[f(F.col(c)).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f in (("lo", F.min), ("hi", F.max))]).first()

    def stats(c: str) -> dict[str, Column]:
        i = list(cols).index(c)
        lo, hi = (F.lit(ends[f"{n}{i}"]).cast(t.schema[c].dataType) for n in ("lo", "hi"))  # in the column's own type
        return {
            "present": F.count(c),
            "at_min": F.count_if(F.col(c) == lo),
            "at_max": F.count_if((F.col(c) == hi) & (lo != hi)),
        }

    top = F.greatest("at_min", "at_max")
    return (
        per_column(t, cols, stats, name="feature")
        .where(F.col("at_min") + F.col("at_max") == F.col("present"))
        .where((F.col("at_max") == 0) | (top > F.col("present") * top_share))
        .select(
            "feature",
            F.when(F.col("present") == 0, 0).when(F.col("at_max") == 0, 1).otherwise(2).alias("distinct"),
            ratio(top, F.col("present")).alias("top_share"),
        )
    )


def missing_cells(t: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Cells in the table, how many are missing, how many are filled."""
    cols = list(cols or t.columns)
    gaps = [F.count_if(F.col(c).isNull()) for c in cols]
    missing = sum(gaps[1:], gaps[0])
    total = n_rows() * len(cols)
    return t.agg(total.alias("total_cells"), missing.alias("missing_cells")).select(
        "total_cells",
        "missing_cells",
        percent(F.col("missing_cells"), F.col("total_cells")).alias("missing_pct"),
        (F.col("total_cells") - F.col("missing_cells")).alias("complete_cells"),
        percent(F.col("total_cells") - F.col("missing_cells"), F.col("total_cells")).alias("complete_pct"),
    )


def has_missing(cols: Sequence[str] = tuple(S.MISSING_TOGETHER)) -> Column:
    return any_null(cols)
