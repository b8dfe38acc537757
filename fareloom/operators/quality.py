"""Missing values, impossible values and refunds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom import schema as S
from fareloom.functions.exprs import all_null, any_null, minutes_between, percent
from fareloom.functions.features import negative_fare_flags, refund_amount, speed_mph
from fareloom.operators.profile import day_name, n_rows, number, per_column, with_pct
from fareloom.operators.quantiles import fit_quantiles

GAPS = tuple(S.MISSING_TOGETHER)


def _both(a: Column, b: Column) -> Column:
    return F.count_if(a & b)


# -- missing values -------------------------------------------------------------------


def missing_profile(
    t: DataFrame, cols: Sequence[str] | None = None, only_gaps: bool = True
) -> DataFrame:
    """Type, present and missing values of each column, most gaps first."""
    types = {f.name: f.dataType.simpleString() for f in t.schema.fields}
    cols = list(cols or t.columns)
    out = per_column(
        t,
        cols,
        lambda c: {
            "present": F.count(c),
            "missing": F.count_if(F.col(c).isNull()),
            "missing_pct": percent(F.count_if(F.col(c).isNull()), n_rows()),
        },
    )
    kind = F.create_map(*[F.lit(x) for c in cols for x in (c, types[c])])
    out = out.select("column", kind[F.col("column")].alias("type"), "present", "missing", "missing_pct")
    if only_gaps:
        out = out.where(F.col("missing") > 0)
    return out.orderBy(F.desc("missing"), "column")


def missing_totals(t: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing cells over all columns and the share of rows with at least one."""
    cols = list(cols or t.columns)
    gaps = [F.count_if(F.col(c).isNull()) for c in cols]
    return t.agg(
        n_rows().alias("rows"),
        sum(gaps[1:], gaps[0]).alias("missing_cells"),
        percent(F.count_if(any_null(cols)), n_rows()).alias("rows_with_gaps_pct"),
    )


def missing_rows(t: DataFrame, cols: Sequence[str] = GAPS) -> DataFrame:
    """Rows with any and with all of the columns missing, and whether these are the same."""
    some, every = F.count_if(any_null(cols)), F.count_if(all_null(cols))
    return t.agg(n_rows().alias("rows"), some.alias("any_missing"), every.alias("all_missing")).select(
        "*",
        (F.col("any_missing") == F.col("all_missing")).alias("systematic"),
        percent(F.col("all_missing"), F.col("any_missing")).alias("all_of_any_pct"),
    )


def missing_overlap(
    t: DataFrame, cols: Sequence[str] = GAPS, code: str = "payment_type", value: int = 0
) -> DataFrame:
    """How far missing rows and rows with one code coincide, with a verdict in words."""
    coded = F.coalesce(F.col(code) == value, F.lit(False))
    counts = t.agg(
        n_rows().alias("rows"), F.count_if(coded).alias("coded"), _both(coded, any_null(cols)).alias("coded_missing")
    )
    share = percent(F.col("coded_missing"), F.col("coded"))
    return counts.select(
        "*",
        percent(F.col("coded"), F.col("rows")).alias("coded_pct"),
        share.alias("coded_missing_pct"),
        F.when(F.col("coded") == F.col("coded_missing"), "all")
        .when(share > 95, "almost all")
        .otherwise("some")
        .alias("overlap"),
    )


def missing_verdict(
    t: DataFrame, cols: Sequence[str] = GAPS, code: str = "payment_type", value: int = 0
) -> DataFrame:
    """Not at random when missing rows are exactly as many as the coded rows, else open."""
    coded = F.coalesce(F.col(code) == value, F.lit(False))
    counts = t.agg(
        n_rows().alias("rows"), F.count_if(any_null(cols)).alias("missing"), F.count_if(coded).alias("coded")
    )
    return counts.select(
        "*",
        percent(F.col("missing"), F.col("rows")).alias("missing_pct"),
        percent(F.col("coded"), F.col("rows")).alias("coded_pct"),
        F.when(F.col("missing") == F.col("coded"), "MNAR").otherwise("undecided").alias("mechanism"),
    )


def missing_by_hour(t: DataFrame, cols: Sequence[str] = GAPS, ts: str = S.PICKUP) -> DataFrame:
    return _missing_by(t, F.hour(ts).alias("pickup_hour"), cols)


def missing_by_dow(t: DataFrame, cols: Sequence[str] = GAPS, ts: str = S.PICKUP) -> DataFrame:
    by_day = _missing_by(t, F.weekday(ts).alias("pickup_dayofweek"), cols)
    return by_day.withColumn("day", day_name(F.col("pickup_dayofweek")))


def _missing_by(t: DataFrame, by: Column, cols: Sequence[str]) -> DataFrame:
    gaps = F.count_if(any_null(cols))
    return t.groupBy(by).agg(
        gaps.alias("missing_count"),
        n_rows().alias("total_count"),
        F.round(percent(gaps, n_rows()), 2).alias("pct_missing"),
    )


def crosstab_margins(t: DataFrame, a: Column, b: Column, names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Counts of every pair of values with ``All`` margins, and the per cent within the row.

    ``all_<name>`` tells a margin from a value that is called ``All``; a missing value stays missing. The row total
    is the margin cell itself, so a share never counts the margin twice.
    """
    left, right = names
    keyed = t.select(a.cast("string").alias(left), b.cast("string").alias(right))
    marks = [(F.grouping(c) == 1).alias(f"all_{c}") for c in names]
    counts = keyed.cube(left, right).agg(n_rows().alias("n"), *marks)
    named = [F.when(F.col(f"all_{c}"), "All").otherwise(F.col(c)).alias(c) for c in names]
    total = F.max(F.when(F.col(f"all_{right}"), F.col("n"))).over(Window.partitionBy(left, f"all_{left}"))
    cells = counts.select(*named, "n", *[f"all_{c}" for c in names])
    return cells.withColumn("row_pct", percent(F.col("n"), total))


# -- impossible values ----------------------------------------------------------------


def negative_counts(t: DataFrame, cols: Sequence[str] = tuple(S.NON_NEGATIVE), only_found: bool = True) -> DataFrame:
    out = per_column(
        t,
        cols,
        lambda c: {
            "negative": F.count_if(F.col(c) < 0),
            "negative_pct": percent(F.count_if(F.col(c) < 0), n_rows()),
        },
    )
    return out.where(F.col("negative") > 0) if only_found else out


def _checks(t: DataFrame, checks: dict[str, Column], name: str) -> DataFrame:
    """One row per named condition with the number and share of rows that meet it."""
    counted = t.agg(
        n_rows().alias("rows"), *[F.count_if(cond).alias(f"_{i}") for i, cond in enumerate(checks.values())]
    )
    rows = [
        F.struct(
            F.lit(label).alias(name),
            F.col(f"_{i}").alias("trips"),
            percent(F.col(f"_{i}"), F.col("rows")).alias("pct"),
        )
        for i, label in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def anomaly_counts(t: DataFrame) -> DataFrame:
    return _checks(
        t,
        {
            "zero_distance": F.col("trip_distance") == 0,
            "zero_passengers": F.col("passenger_count") == 0,
            "dropoff_before_pickup": F.col(S.DROPOFF) < F.col(S.PICKUP),
        },
        "anomaly",
    )


def quality_issues(t: DataFrame, long_minutes: float = 300, top_speed: float = 80) -> DataFrame:
    """Only the issues that occur."""
    minutes = minutes_between(S.PICKUP, S.DROPOFF)
    found = _checks(
        t,
        {
            "distance_not_positive": F.col("trip_distance") <= 0,
            "negative_fare": F.col("fare_amount") < 0,
            "negative_duration": minutes < 0,
            "very_long_trip": minutes > long_minutes,
            "unrealistic_speed": speed_mph(minutes=minutes) > top_speed,
        },
        "issue",
    )
    return found.where(F.col("trips") > 0)


def target_filter(t: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Rows with a non-negative target; a missing target, NaN included, is dropped as well."""
    return t.where(_usable_target(target))


def _usable_target(target: str) -> Column:
    return (F.col(target) >= 0) & ~F.isnan(F.col(target).cast("double"))


def target_filter_report(t: DataFrame, target: str = S.TARGET) -> DataFrame:
    kept = F.count_if(_usable_target(target))
    return t.agg(
        n_rows().alias("rows"),
        kept.alias("kept"),
        (n_rows() - kept).alias("dropped"),
        percent(n_rows() - kept, n_rows()).alias("dropped_pct"),
    )


# -- refunds --------------------------------------------------------------------------


def negative_fares(t: DataFrame, fare: str = "fare_amount") -> DataFrame:
    return t.where(F.col(fare) < 0)


def neg_fare_profile(t: DataFrame, exact: bool = True) -> DataFrame:
    """What trips with a negative fare look like, as (section, item, n, pct, amount).

    Payment codes, zero distances, negative totals, other negative charges, and the size of
    the fares: ``largest`` is the most negative one.
    """
    sub = negative_fares(t)
    (median,) = fit_quantiles(sub, ["fare_amount"], (0.5,), exact)["fare_amount"]
    facts = {
        ("zero_distance", "trip_distance"): F.col("trip_distance") == 0,
        ("negative_total", "total_amount"): F.col("total_amount") < 0,
        **{("negative_charge", c): F.col(c) < 0 for c in S.OTHER_CHARGES},
    }
    one = sub.agg(
        n_rows().alias("rows"),
        F.avg("fare_amount").alias("mean"),
        F.min("fare_amount").alias("largest"),
        F.max("fare_amount").alias("smallest"),
        *[F.count_if(cond).alias(f"_{i}") for i, cond in enumerate(facts.values())],
    )

    def line(section: str, item: str, n: Column, pct: Column, amount: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"),
            F.lit(item).alias("item"),
            n.cast("bigint").alias("n"),
            pct.cast("double").alias("pct"),
            amount.cast("double").alias("amount"),
        )

    none = F.lit(None)
    rows = [
        line(s, i, F.col(f"_{k}"), percent(F.col(f"_{k}"), F.col("rows")), none)
        for k, (s, i) in enumerate(facts)
    ]
    rows += [
        line("magnitude", "mean", none, none, F.col("mean")),
        line("magnitude", "median", none, none, number(median)),
        line("magnitude", "largest", none, none, F.col("largest")),
        line("magnitude", "smallest", none, none, F.col("smallest")),
    ]
    lines = one.select(F.inline(F.array(*rows)))
    lines = lines.where((F.col("section") != "negative_charge") | (F.col("n") > 0))
    by_payment = with_pct(
        sub.groupBy(F.col("payment_type").cast("string").alias("item")).agg(n_rows().alias("n"))
    ).select(F.lit("payment_type").alias("section"), "item", "n", "pct", none.cast("double").alias("amount"))
    return by_payment.unionByName(lines)


FLAG_LABELS = [
    "has_negative_fare",
    "is_cancelled_ride",
    "is_full_refund",
    "is_partial_adjustment",
    "is_large_refund",
    "is_small_adjustment",
    "is_voided_trip",
    "has_multiple_negative_charges",
]


def neg_flag_summary(t: DataFrame) -> DataFrame:
    """How many trips carry each refund flag."""
    flagged = negative_fare_flags(t)
    return _checks(flagged, {"all_trips": F.lit(True), **{c: F.col(c) == 1 for c in FLAG_LABELS}}, "flag")


def neg_category_breakdown(t: DataFrame) -> DataFrame:
    """Categories within the negative fares."""
    sub = negative_fare_flags(negative_fares(t))
    return with_pct(sub.groupBy("negative_fare_category").agg(n_rows().alias("n")))


def refund_stats(t: DataFrame, exact: bool = True) -> DataFrame:
    """Size of the refunds, over trips that have one."""
    sub = negative_fares(t).select(refund_amount().alias("refund"))
    (median,) = fit_quantiles(sub, ["refund"], (0.5,), exact)["refund"]
    return sub.agg(
        n_rows().alias("refunds"),
        F.avg("refund").alias("mean"),
        number(median).alias("median"),
        F.min("refund").alias("min"),
        F.max("refund").alias("max"),
        F.sum("refund").alias("total"),
    )

