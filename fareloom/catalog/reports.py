"""Queries: scans, profiling, quality and statistics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fareloom import schema as S
from fareloom.catalog.registry import query, rounded
from fareloom.functions import features as X
from fareloom.operators import incremental as G
from fareloom.operators import profile as P
from fareloom.operators import quality as Q
from fareloom.operators import sampling as R
from fareloom.operators import stats as A
from fareloom.operators.encode import freq_encode, mode_fill
from fareloom.session import scratch_path, settle, split_methods
from fareloom.sources import requests as J
from fareloom.sources import trips as IO
from fareloom.sources.tables import trips

TRIP_COLUMNS = S.TRIP_SCHEMA.fieldNames()


def gaps():
    return P.has_missing()


def with_duration(spark, d):
    return X.with_duration(trips(spark, d))


_analysis = {}


def analysis_table(spark, d):
    """Every analysis column, frequencies and the filled passenger count included.

    The feature columns are written once per application and folder: the reports over them pass
    over the table more than once and should not join and derive it again each time.
    """
    at = (spark.sparkContext.applicationId, d)
    if at not in _analysis:
        t = X.features_analysis(mode_fill(trips(spark, d)))
        used = dict.fromkeys([*S.ANALYSIS_COLUMNS, *(c for cols in S.FEATURE_GROUPS.values() for c in cols if c in t.columns)])
        with split_methods(spark):
            _analysis[at] = settle(freq_encode(t).select(*used), "analysis")
    return _analysis[at]


# -- sources --------------------------------------------------------------------------


@query("scan_trips")
def scan_trips(spark, d):
    path = scratch_path(spark, "trips")
    IO.write_trips(trips(spark, d), path)
    return IO.read_trips(spark, path)


@query("scan_trips_where")
def scan_trips_where(spark, d):
    """A scan whose filter reaches the Parquet reader."""
    path = scratch_path(spark, "trips")
    IO.write_trips(trips(spark, d), path)
    return IO.read_trips(spark, path, where="trip_distance > 0")


@query("scan_csv")
def scan_csv(spark, d):
    path = scratch_path(spark, "trips") + ".csv"
    iso = {c: F.replace(J.time_text(c), F.lit(" "), F.lit("T")) for c in (S.PICKUP, S.DROPOFF)}
    t = trips(spark, d).drop("trip_id").withColumns(iso)
    IO.write_csv(t.select(*sorted(t.columns, reverse=True)), path)  # found by name, whatever their order
    t = IO.read_trips(spark, path)
    return rounded(
        t.groupBy("VendorID", "payment_type", "store_and_fwd_flag").agg(
            P.n_rows().alias("trips"),
            F.min(S.PICKUP).alias("first_pickup"),
            F.max(S.DROPOFF).alias("last_dropoff"),
            F.count("passenger_count").alias("with_passengers"),
            F.sum("total_amount").alias("revenue"),
        )
    )


@query("coerce_ts")
def coerce_ts(spark, d):
    text = trips(spark, d).select(
        "trip_id",
        J.time_text(S.PICKUP).alias(S.PICKUP),
        F.when(F.col("payment_type") == 0, "not a time")
        .otherwise(J.time_text(S.DROPOFF))
        .alias(S.DROPOFF),
    )
    return IO.to_ts(text)


@query("sample_n")
def sample_n(spark, d):
    return R.sample_n(trips(spark, d).select("trip_id", "fare_amount"), 2500, "trip_id", seed=42)


@query("shuffle_order")
def shuffle_order(spark, d):
    return R.row_positions(trips(spark, d).select("trip_id"), "trip_id", seed=47)


@query("narrow_types")
def narrow_types(spark, d):
    t = trips(spark, d).select("trip_id", S.PICKUP, "payment_type")
    wide = t.withColumns(
        {
            "minute_of_month": (F.dayofmonth(S.PICKUP) * 1440 + F.hour(S.PICKUP) * 60 + F.minute(S.PICKUP)).cast("bigint"),
            "big_key": F.split("trip_id", "-")[0].cast("bigint") * 10**9,
            "order_part": F.split("trip_id", "-")[0].cast("bigint") + 40000,
        }
    ).drop(S.PICKUP, "trip_id")
    narrow = IO.narrow_types(wide)
    kinds = [F.lit(f.dataType.simpleString()).alias(f"{f.name}_type") for f in narrow.schema.fields]
    found = settle(narrow.agg(*[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in narrow.columns]), "sums")
    sums = found.first()  # one row; a sum that has outgrown 64 bits stays a decimal
    small = {c: F.col(c).cast("bigint") for c in narrow.columns if sums[c] is None or abs(sums[c]) < 1 << 63}
    return found.withColumns(small).select("*", *kinds)


@query("shuffled_rows")
def shuffled_rows(spark, d):
    """Where each row lies when the table is read in its shuffled order: rows of earlier partitions, then places in its own."""
    placed = R.shuffle_order(trips(spark, d).select("trip_id"), "trip_id", seed=47).withColumn("id", F.monotonically_increasing_id())
    placed = settle(placed.select("trip_id", F.shiftright("id", 33).alias("part"), F.col("id").bitwiseAND((1 << 33) - 1).alias("place")), "shuffled")
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    before = placed.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("before"))
    return placed.join(before, "part").select("trip_id", (F.col("before") + F.col("place") + 1).alias("position"))


@query("read_two_periods")
def read_two_periods(spark, d):
    """Two periods in folders of their own, the later one without a column, read as one table."""
    t, early = trips(spark, d), F.year(S.PICKUP) < 1998
    paths = {name: scratch_path(spark, f"period-{name}") for name in ("early", "late")}
    IO.write_trips(t.where(early), paths["early"])
    IO.write_trips(t.where(~early).drop("Airport_fee"), paths["late"])
    both = IO.read_periods(spark, paths)
    return rounded(
        both.groupBy("period").agg(
            P.n_rows().alias("trips"),
            F.min(S.PICKUP).alias("first_pickup"),
            F.max(S.PICKUP).alias("last_pickup"),
            F.avg("total_amount").alias("mean_total"),
            F.count("Airport_fee").alias("fees"),
        )
    )


@query("two_period_union")
def two_period_union(spark, d):
    t = trips(spark, d)
    early = F.year(S.PICKUP) < 1998
    both = IO.union_periods({"early": t.where(early), "late": t.where(~early)})
    return rounded(
        both.groupBy("period").agg(
            P.n_rows().alias("trips"),
            F.min(S.PICKUP).alias("first_pickup"),
            F.max(S.PICKUP).alias("last_pickup"),
            F.avg("total_amount").alias("mean_total"),
        )
    )


@query("request_parse")
def request_parse(spark, d):
    path = scratch_path(spark, "requests")
    sent = J.requests_from_trips(trips(spark, d), ids=())
    # A client may leave fields out: absent ones take their defaults.
    sparse = sent.withColumns(
        {
            "passenger_count": F.when(F.col("payment_type") != 0, F.col("passenger_count")),
            "store_and_fwd_flag": F.when(F.col("payment_type") != 0, F.col("store_and_fwd_flag")),
        }
    )
    J.write_requests(sparse, path)
    got = J.read_requests(spark, path)
    return rounded(
        got.groupBy("passenger_count", "store_and_fwd_flag", "VendorID", "RatecodeID").agg(
            P.n_rows().alias("requests"),
            F.min("pickup_datetime").alias("first_pickup"),
            F.sum("trip_distance").alias("miles"),
            F.sum("fare_amount").alias("fares"),
            F.count(J.CORRUPT).alias("corrupt"),
        )
    )


@query("literal_rows")
def literal_rows(spark, d):
    """Payment labels given in code, joined to the trips they describe."""
    labels = J.rows_from_literals(spark, list(S.PAYMENT_LABELS.items()), "payment_type bigint, label string")
    counted = trips(spark, d).groupBy("payment_type").agg(P.n_rows().alias("trips"), F.sum("total_amount").alias("revenue"))
    return rounded(
        counted.join(labels, "payment_type", "left").select(
            "payment_type", F.coalesce("label", F.lit("not listed")).alias("label"), "trips", "revenue"
        )
    )


# -- missing values and quality -------------------------------------------------------


@query("missing_profile")
def missing_profile(spark, d):
    return rounded(Q.missing_profile(trips(spark, d).select(*TRIP_COLUMNS)))


@query("missing_totals")
def missing_totals(spark, d):
    return rounded(Q.missing_totals(trips(spark, d).select(*TRIP_COLUMNS)))


@query("missing_rows")
def missing_rows(spark, d):
    return rounded(Q.missing_rows(trips(spark, d)))


@query("missing_overlap")
def missing_overlap(spark, d):
    return rounded(Q.missing_overlap(trips(spark, d)))


@query("missing_verdict")
def missing_verdict(spark, d):
    return rounded(Q.missing_verdict(trips(spark, d)))


@query("missing_by_hour")
def missing_by_hour(spark, d):
    return Q.missing_by_hour(trips(spark, d))


@query("missing_by_dow")
def missing_by_dow(spark, d):
    return Q.missing_by_dow(trips(spark, d))


@query("crosstab_margins")
def crosstab_margins(spark, d):
    t = trips(spark, d)
    return rounded(Q.crosstab_margins(t, F.col("payment_type"), gaps(), ("payment_type", "has_missing")))


@query("negative_counts")
def negative_counts(spark, d):
    return rounded(Q.negative_counts(trips(spark, d)))


@query("anomaly_counts")
def anomaly_counts(spark, d):
    return rounded(Q.anomaly_counts(trips(spark, d)))


@query("quality_issues")
def quality_issues(spark, d):
    return rounded(Q.quality_issues(trips(spark, d)))


@query("completeness")
def completeness(spark, d):
    return rounded(P.missing_cells(trips(spark, d).select(*TRIP_COLUMNS)))


@query("target_filter")
def target_filter(spark, d):
    return rounded(Q.target_filter_report(trips(spark, d)))


@query("neg_fare_profile")
def neg_fare_profile(spark, d):
    return rounded(Q.neg_fare_profile(trips(spark, d)))


@query("neg_flag_summary")
def neg_flag_summary(spark, d):
    return rounded(Q.neg_flag_summary(trips(spark, d)))


@query("neg_category_breakdown")
def neg_category_breakdown(spark, d):
    return rounded(Q.neg_category_breakdown(trips(spark, d)))


@query("refund_stats")
def refund_stats(spark, d):
    return rounded(Q.refund_stats(trips(spark, d)))


# -- profiling ------------------------------------------------------------------------


@query("describe_numeric")
def describe_numeric(spark, d):
    return rounded(P.describe_numeric(trips(spark, d)))


@query("describe_categorical")
def describe_categorical(spark, d):
    return P.describe_categorical(trips(spark, d))


@query("shape_stats")
def shape_stats(spark, d):
    return rounded(P.shape_stats(trips(spark, d)), 5)


@query("iqr_outliers")
def iqr_outliers(spark, d):
    return rounded(P.iqr_outliers(trips(spark, d)))


@query("value_dist")
def value_dist(spark, d):
    return rounded(P.value_dist(trips(spark, d)))


@query("group_dist")
def group_dist(spark, d):
    t = trips(spark, d)
    return rounded(P.group_dist(t, gaps(), "payment_type", range(5), "has_missing"))


@query("group_means")
def group_means(spark, d):
    return rounded(P.group_means(with_duration(spark, d), gaps(), name="has_missing"))


@query("target_dist")
def target_dist(spark, d):
    return rounded(P.target_dist(trips(spark, d)))


@query("input_stats")
def input_stats(spark, d):
    return rounded(P.input_stats(trips(spark, d)))


@query("date_range")
def date_range(spark, d):
    return P.date_range(trips(spark, d))


@query("duration_stats")
def duration_stats(spark, d):
    return rounded(P.duration_stats(trips(spark, d)))


@query("hourly_dist")
def hourly_dist(spark, d):
    return P.hourly_dist(trips(spark, d))


@query("peak_hours")
def peak_hours(spark, d):
    return P.peak_hours(trips(spark, d))


@query("dow_dist")
def dow_dist(spark, d):
    return rounded(P.dow_dist(trips(spark, d)))


@query("daily_dist")
def daily_dist(spark, d):
    return rounded(P.daily_dist(trips(spark, d)))


@query("hourly_means")
def hourly_means(spark, d):
    return rounded(P.hourly_means(trips(spark, d)))


@query("location_report")
def location_report(spark, d):
    return rounded(P.location_report(trips(spark, d)))


@query("top_locations")
def top_locations(spark, d):
    t = trips(spark, d)
    return rounded(P.top_locations(t, "PULocationID").unionByName(P.top_locations(t, "DOLocationID")))


@query("money_stats")
def money_stats(spark, d):
    return rounded(P.money_stats(trips(spark, d)))


@query("tip_report")
def tip_report(spark, d):
    return rounded(P.tip_report(trips(spark, d)))


@query("tip_by_payment")
def tip_by_payment(spark, d):
    return rounded(P.tip_by_payment(trips(spark, d)))


@query("speed_report")
def speed_report(spark, d):
    return rounded(P.speed_report(trips(spark, d)))


@query("trip_summary")
def trip_summary(spark, d):
    return rounded(P.trip_summary(trips(spark, d)), 4)


@query("feature_profile")
def feature_profile(spark, d):
    return rounded(P.feature_profile(analysis_table(spark, d)))


@query("feature_variance")
def feature_variance(spark, d):
    return rounded(P.feature_variance(analysis_table(spark, d), S.ANALYSIS_COLUMNS))


@query("near_constant")
def near_constant(spark, d):
    return rounded(P.near_constant(analysis_table(spark, d), S.ANALYSIS_COLUMNS))


# -- statistics -----------------------------------------------------------------------


@query("corr_matrix")
def corr_matrix(spark, d):
    return rounded(A.corr_matrix(with_duration(spark, d)))


@query("target_correlations")
def target_correlations(spark, d):
    return rounded(
        A.target_correlations(analysis_table(spark, d), S.ANALYSIS_COLUMNS, top=15, bottom=10)
    )


@query("chi2_hour_missing")
def chi2_hour_missing(spark, d):
    return rounded(A.chi2(trips(spark, d), F.hour(S.PICKUP), gaps()), 4)


@query("chi2_test")
def chi2_test(spark, d):
    return rounded(A.chi2_test(trips(spark, d), F.hour(S.PICKUP), gaps().cast("int")), 4)


@query("welch_t")
def welch_t(spark, d):
    return rounded(A.welch_t(with_duration(spark, d), gaps()), 5)


@query("welch_test")
def welch_test(spark, d):
    return rounded(A.welch_test(with_duration(spark, d), gaps()), 5)


# -- reports that grow -----------------------------------------------------------------


def monthly_states(spark, d):
    """What each pickup month leaves behind, appended month by month to a stored table."""
    t = with_duration(spark, d)
    month = F.date_format(S.PICKUP, "yyyy-MM")
    return settle(G.period_states(t, month, S.KEY_NUMERIC, ["trip_id", "payment_type"]), "month-states")


@query("incremental_summary")
def incremental_summary(spark, d):
    """Counts and moments of all trips from the rows that the months left, without another scan."""
    found = G.merged(monthly_states(spark, d)).where(F.col("column").isin(*S.KEY_NUMERIC))
    return rounded(found.select("column", "count", "mean", "std", "min", "max"), 4)


@query("approx_distinct")
def approx_distinct(spark, d):
    """Whether merged sketches come within 3 % of the exact distinct counts."""
    cols = [*S.KEY_NUMERIC, "trip_id", "payment_type"]
    exact = P.distinct_counts(with_duration(spark, d), cols).withColumnRenamed("distinct", "exact")
    near = G.merged(monthly_states(spark, d)).select("column", "distinct")
    within = F.abs(F.col("distinct") - F.col("exact")) <= 0.03 * F.col("exact")
    return exact.join(near, "column").select("column", "exact", within.alias("within"))
