"""Queries: features, fitted encoders, splits, baseline model, requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareloom import schema as S
from fareloom.catalog.registry import query, rounded
from fareloom.catalog.reports import with_duration
from fareloom.functions import features as X
from fareloom.functions.rules import accepted, rejected, validate_requests
from fareloom.operators import encode as E
from fareloom.operators import profile as P
from fareloom.operators import quality as Q
from fareloom.operators import sampling as R
from fareloom.operators import stats as A
from fareloom.plans import models as M
from fareloom.plans import scoring as C
from fareloom.plans.encoder import TripEncoder, slot_table
from fareloom.session import settle, split_methods
from fareloom.sources import requests as J
from fareloom.sources.tables import trips

KEY = "trip_id"
SCALED = ["trip_distance", "fare_amount", "passenger_count", "trip_duration_minutes"]


def new_columns(before, after):
    old = set(before.columns)
    return after.select(KEY, *[c for c in after.columns if c not in old])


_rows = {}


def model_rows(spark, d):
    """The feature set of the model with a test mark, written once per application and folder."""
    at = (spark.sparkContext.applicationId, d)
    if at not in _rows:
        t = X.features_v1(trips(spark, d))
        used = [KEY, S.TARGET, *S.MODEL_NUMERIC, *S.MODEL_CATEGORICAL]
        _rows[at] = settle(R.train_test_split(t.select(*used), KEY), "model-rows")
    return _rows[at]


# -- features -------------------------------------------------------------------------


def feature_query(name, build):
    @query(name)
    def run(spark, d):
        t = trips(spark, d)
        return new_columns(t, build(t))

    return run


feature_query("features_temporal", X.features_temporal)
feature_query("features_cyclic", X.features_cyclic)
feature_query("features_financial", X.features_financial)
feature_query("features_location", X.features_location)
feature_query("features_interaction", X.features_interaction)
feature_query("neg_fare_flags", X.negative_fare_flags)


@query("features_efficiency")
def features_efficiency(spark, d):
    t = with_duration(spark, d)
    return new_columns(t, X.features_efficiency(t))


@query("neg_fare_category")
def neg_fare_category(spark, d):
    t = trips(spark, d).select(X.negative_fare_category().alias("category"), "fare_amount")
    return rounded(t.groupBy("category").agg(P.n_rows().alias("trips"), F.avg("fare_amount").alias("mean_fare")))


@query("features_v1")
def features_v1(spark, d):
    out = X.features_v1(trips(spark, d))
    return out.select(KEY, *dict.fromkeys([*S.MODEL_NUMERIC, "revenue_per_mile", *S.MODEL_CATEGORICAL]))


@query("features_v1_total_basis")
def features_v1_total_basis(spark, d):
    out = X.features_v1(trips(spark, d), basis="total")
    return out.select(KEY, "tip_percentage", "revenue_per_mile", "has_negative_fare")


@query("zero_flags")
def zero_flags(spark, d):
    t = with_duration(spark, d)
    return new_columns(t, X.zero_flags(t))


@query("log_target")
def log_target(spark, d):
    t = trips(spark, d)
    return rounded(new_columns(t, X.log_target(t)))


@query("tip_suggestions")
def tip_suggestions(spark, d):
    return rounded(X.tip_suggestions(trips(spark, d), "total_amount", ids=(KEY,)))


# -- fitted encoders ------------------------------------------------------------------


@query("freq_encode")
def freq_encode(spark, d):
    t = trips(spark, d).select(KEY, "PULocationID", "DOLocationID")
    return E.freq_encode(t)


@query("freq_encode_fitted")
def freq_encode_fitted(spark, d):
    t = R.train_test_split(trips(spark, d).select(KEY, "PULocationID", "RatecodeID"), KEY)
    fitted = E.fit_frequencies(t.where("not is_test"), ("PULocationID", "RatecodeID"))
    return E.apply_frequencies(t, fitted)


@query("mode_fill")
def mode_fill(spark, d):
    return E.mode_fill(trips(spark, d).select(KEY, "passenger_count"))


@query("standardize")
def standardize(spark, d):
    t = with_duration(spark, d).select(KEY, *SCALED)
    return rounded(E.apply_standard(t, E.fit_standard(t, SCALED)))


@query("robust_scale")
def robust_scale(spark, d):
    t = with_duration(spark, d).select(KEY, *SCALED)
    return rounded(E.apply_robust(t, E.fit_robust(t, SCALED)))


@query("cap_outliers")
def cap_outliers(spark, d):
    t = with_duration(spark, d).select(KEY, *SCALED)
    return rounded(E.apply_caps(t, E.fit_caps(t, SCALED)))


@query("mnar_handle")
def mnar_handle(spark, d):
    t = trips(spark, d).select(KEY, "passenger_count", "congestion_surcharge", "store_and_fwd_flag")
    fitted = E.fit_gaps(t, ("passenger_count", "congestion_surcharge"), ("store_and_fwd_flag",))
    return rounded(E.apply_gaps(t, fitted))


def coded(spark, d):
    t = trips(spark, d)
    t = X.features_interaction(t.withColumns({
        "time_of_day": X.time_of_day(F.hour(S.PICKUP)),
        "negative_fare_category": X.negative_fare_category(),
    }))
    return t.select(KEY, *S.MODEL_CATEGORICAL)


@query("onehot_long")
def onehot_long(spark, d):
    t = coded(spark, d)
    return E.onehot_long(t, E.fit_categories(t, S.MODEL_CATEGORICAL), (KEY,))


@query("onehot_table")
def onehot_table(spark, d):
    """Indicators of columns with any number of values: per column its categories, its cells, and whether slots are 0 to n - 1."""
    t, cols = trips(spark, d).select(KEY, "payment_type", "passenger_count"), [KEY, "payment_type", "passenger_count"]
    table = E.fit_category_table(t, cols)
    cells = E.onehot_rows(t.withColumn("row", F.col(KEY)), table, cols, ("row",))
    found = cells.groupBy("column").agg(
        F.count_distinct("category").alias("categories"), P.n_rows().alias("cells"), F.min("slot").alias("low"), F.max("slot").alias("high"), F.count_distinct("slot").alias("slots")
    )
    dense = (F.col("low") == 0) & (F.col("high") == F.col("categories") - 1) & (F.col("slots") == F.col("categories"))
    return found.select("column", "categories", "cells", dense.alias("dense"))


@query("onehot_drop_first")
def onehot_drop_first(spark, d):
    t = coded(spark, d)
    return E.onehot_long(t, E.fit_categories(t, S.MODEL_CATEGORICAL, "MISSING"), (KEY,), drop_first=True)


@query("assemble_features")
def assemble_features(spark, d):
    """Rows and total of every slot of the assembled vector, encoder fitted on the training rows."""
    t = model_rows(spark, d)
    encoding = TripEncoder().fit(t.where("not is_test"))
    return rounded(slot_table(encoding.transform(t)).drop("slot"), 4)


@query("prepare_training")
def prepare_training(spark, d):
    """Rows and total of every slot of the prepared training and test vectors."""
    used = [KEY, S.TARGET, *S.ANALYSIS_MODEL_NUMERIC, *S.MODEL_CATEGORICAL]
    with split_methods(spark):
        rows = settle(X.features_analysis(trips(spark, d)).select(*used), "analysis-rows")
    ready = M.prepare_training(rows, KEY)
    parts = [
        slot_table(part).drop("slot").withColumn("part", F.lit(name))
        for name, part in (("train", ready.train), ("test", ready.test))
    ]
    return rounded(parts[0].unionByName(parts[1]), 4)


# -- splits ---------------------------------------------------------------------------


@query("train_test_split")
def train_test_split(spark, d):
    return R.train_test_split(trips(spark, d).select(KEY), KEY)


@query("three_way_split")
def three_way_split(spark, d):
    return R.three_way_split(trips(spark, d).select(KEY), KEY)


@query("kfold")
def kfold(spark, d):
    return R.kfold(trips(spark, d).select(KEY), KEY)


@query("quantile_bins")
def quantile_bins(spark, d):
    return R.quantile_bins(trips(spark, d).select(KEY, "total_amount"))


@query("stratified_folds")
def stratified_folds(spark, d):
    return R.stratified_folds(trips(spark, d).select(KEY, "total_amount"), KEY)


# -- baseline model -------------------------------------------------------------------


def baseline(spark, d):
    """Trips with the prediction of a line fitted on the training rows."""
    t = R.train_test_split(trips(spark, d), KEY)
    return A.apply_line(t, A.fit_line(t.where("not is_test")))


def fold_metrics(spark, d, k=5):
    t = R.kfold(trips(spark, d).select(KEY, "fare_amount", "total_amount"), KEY, k)
    lines = A.fit_fold_lines(t, "fold", k)
    return A.regression_metrics(A.apply_fold_lines(t, lines, "fold"), by=("fold",))


@query("linear_baseline")
def linear_baseline(spark, d):
    return rounded(baseline(spark, d).select(KEY, "is_test", "total_amount", S.PREDICTED))


@query("regression_metrics")
def regression_metrics(spark, d):
    return rounded(A.regression_metrics(baseline(spark, d), by=("is_test",)))


@query("fold_metrics")
def fold_metrics_query(spark, d):
    return rounded(fold_metrics(spark, d))


@query("cv_summary")
def cv_summary(spark, d):
    return rounded(A.cv_summary(fold_metrics(spark, d)))


@query("residuals")
def residuals(spark, d):
    scored = A.residuals(baseline(spark, d).where("is_test"))
    return rounded(R.sample_n(scored.select(KEY, "total_amount", S.PREDICTED, "residual"), 1000, KEY))


@query("prediction_stats")
def prediction_stats(spark, d):
    return rounded(P.prediction_stats(baseline(spark, d)))


@query("resolve_version")
def resolve_version(spark, d):
    """One model version per pickup year; the latest, production, staging and a given one."""
    t = Q.target_filter(trips(spark, d))
    year = F.year(S.PICKUP)
    slope, r2 = F.regr_slope("total_amount", "fare_amount"), F.regr_r2("total_amount", "fare_amount")
    by_year = t.groupBy(year.alias("year")).agg(slope.alias("slope"), r2.alias("r2"), P.n_rows().alias("trips"))
    number = F.col("year") - by_year.agg(F.min("year")).scalar() + 1
    stage = F.when(number % 3 == 0, "Production").when(number % 3 == 1, "Staging").otherwise("Archived")
    versions = settle(
        by_year.select(
            F.lit("fare_line").alias("model"), number.cast("string").alias("version"), stage.alias("stage"),
            "year", "trips", "slope", "r2",
        ),
        "versions",
    )
    out = None
    for wanted in ("latest", "production", "staging", "2"):
        one = C.resolve_version(versions, wanted).withColumn("wanted", F.lit(wanted))
        out = one if out is None else out.unionByName(one)
    return rounded(out)


# -- requests -------------------------------------------------------------------------


def planted_requests(spark, d):
    """Requests from trips, with broken values planted by zone."""
    r = J.requests_from_trips(trips(spark, d), ids=(KEY, "PULocationID", "DOLocationID"))
    pu, do = F.col("PULocationID"), F.col("DOLocationID")
    dropoff = F.col("dropoff_datetime")
    return r.withColumns(
        {
            "pickup_datetime": F.when(pu % 11 == 0, F.replace("pickup_datetime", F.lit(" "), F.lit("T")))
            .when(pu % 13 == 0, F.replace("pickup_datetime", F.lit("-0"), F.lit("-")))
            .otherwise(F.col("pickup_datetime")),
            "dropoff_datetime": F.when(pu % 17 == 0, F.concat(F.substring(dropoff, 1, 5), F.lit("13-41 00:00:00")))
            .when(pu % 19 == 0, F.lit(None).cast("string"))
            .otherwise(dropoff),
            "passenger_count": F.when(do % 7 == 0, F.col("passenger_count") + 3).otherwise(F.col("passenger_count")),
            "VendorID": F.when(do % 23 == 0, 3).otherwise(F.col("VendorID")),
            "store_and_fwd_flag": F.when(do % 29 == 0, "X").otherwise(F.lower("store_and_fwd_flag")),
        }
    ).drop("PULocationID", "DOLocationID")


@query("validate_requests")
def validate(spark, d):
    checked = validate_requests(planted_requests(spark, d))
    return checked.select(KEY, "store_and_fwd_flag", F.array_join("violations", ",").alias("violations"), "is_valid")


@query("validate_json_requests")
def validate_json_requests(spark, d):
    """Requests as JSON text: a passenger count that is null, one that is left out, a fare that is no number."""
    r = J.requests_from_trips(trips(spark, d), ids=(KEY, "DOLocationID")).withColumn("passenger_count", F.col("passenger_count").cast("int"))
    do = F.col("DOLocationID")
    fields = [c for c in r.columns if c not in (KEY, "DOLocationID")]

    def body(*but, **changed):
        return F.to_json(F.struct(*[changed.get(c, F.col(c)).alias(c) for c in fields if c not in but]), {"ignoreNullFields": "false"})

    text = (
        F.when(do % 5 == 0, body(passenger_count=F.lit(None).cast("int")))
        .when(do % 3 == 0, body("passenger_count", "tolls_amount"))
        .when(do % 13 == 0, body(fare_amount=F.lit("n/a")))
        .when(do % 17 == 0, F.lit("[1, 2]"))
        .otherwise(body())
    )
    checked = validate_requests(J.parse_requests(r.select(KEY, text.alias("body"))))
    return checked.select(KEY, "passenger_count", "tolls_amount", F.array_join("violations", ",").alias("violations"), "is_valid")


@query("validate_requests_strict")
def validate_strict(spark, d):
    checked = validate_requests(planted_requests(spark, d), strict=True)
    return checked.select(KEY, F.array_join("violations", ",").alias("violations"), "is_valid")


@query("rejected_requests")
def rejected_requests(spark, d):
    """Rejections counted by broken rule; a request may break several."""
    bad = rejected(validate_requests(planted_requests(spark, d)))
    return bad.select(F.explode("violations").alias("rule"), KEY).groupBy("rule").agg(
        P.n_rows().alias("requests"), F.min(KEY).alias("first_request")
    )


@query("request_features")
def request_features(spark, d):
    # A client rarely knows the fare: one vendor's requests leave it out.
    sent = planted_requests(spark, d).withColumn(
        "fare_amount", F.when(F.col("VendorID") == 2, 0.0).otherwise(F.col("fare_amount"))
    )
    good = accepted(validate_requests(sent))
    return C.request_features(good).drop("pickup_datetime", "dropoff_datetime")
