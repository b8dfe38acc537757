"""Edge cases of expressions and derived columns on small literal tables."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from fareloom import schema as S
from fareloom.functions import exprs as E
from fareloom.functions import features as X
from fareloom.sources.trips import normalise_missing
from tests.conftest import rows


def at(hour, minute=0, second=0, micro=0):
    return dt.datetime(2024, 3, 10, hour, minute, second, micro)


def test_minutes_keep_fractions_and_sign(spark):
    t = spark.createDataFrame(
        [(at(1), at(1, 0, 1, 500000)), (at(1), at(1)), (at(1), at(0, 59))], "a timestamp_ntz, b timestamp_ntz"
    )
    assert rows(t.select(E.minutes_between("a", "b"))) == [(0.025,), (0.0,), (-1.0,)]


def test_minutes_ignore_a_clock_change(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        t = spark.createDataFrame([(at(1, 30), at(3, 30))], "a timestamp_ntz, b timestamp_ntz")
        assert rows(t.select(E.minutes_between("a", "b"))) == [(120.0,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_ratio_clip_and_flag_treat_zero_and_null(spark):
    t = spark.createDataFrame([(1.0, 0.0), (None, 2.0), (6.0, 2.0), (-6.0, 2.0)], "a double, b double")
    assert rows(t.select(E.ratio("a", "b"))) == [(None,), (None,), (3.0,), (-3.0,)]
    assert rows(t.select(E.clip("a", 0.0, 5.0))) == [(1.0,), (None,), (5.0,), (0.0,)]
    assert rows(t.select(E.flag(F.col("a") < 0))) == [(0,), (0,), (0,), (1,)]


def test_nan_is_missing(spark):
    t = normalise_missing(spark.createDataFrame([(math.nan,), (None,), (0.0,)], "x double"))
    assert rows(t.select("x", (F.col("x") >= 0))) == [(None, None), (None, None), (0.0, True)]


def test_time_of_day_edges(spark):
    t = spark.createDataFrame([(h,) for h in range(24)], "h int")
    got = dict(rows(t.select("h", X.time_of_day(F.col("h")))))
    want = {h: "late_night" for h in (22, 23, 0, 1, 2, 3, 4, 5)}
    want |= {h: "morning" for h in range(6, 12)}
    want |= {h: "afternoon" for h in range(12, 17)}
    want |= {h: "evening" for h in range(17, 22)}
    assert got == want


@pytest.mark.parametrize(
    "hour, rush, night",
    [(5, 0, 1), (6, 0, 0), (7, 1, 0), (9, 1, 0), (10, 0, 0), (16, 0, 0), (17, 1, 0), (19, 1, 0), (20, 0, 0), (22, 0, 1)],
)
def test_rush_and_night(spark, hour, rush, night):
    t = spark.createDataFrame([(at(hour), at(hour))], f"{S.PICKUP} timestamp_ntz, {S.DROPOFF} timestamp_ntz")
    row = X.features_temporal(t).first()
    assert (row["is_rush_hour"], row["is_night"]) == (rush, night)
    assert (row["pickup_dayofweek"], row["is_weekend"]) == (6, 1)  # a Sunday


FARES = "fare_amount double, trip_distance double, total_amount double, payment_type bigint"


def test_negative_fare_categories_first_match_wins(spark):
    t = spark.createDataFrame(
        [
            (0.0, 0.0, 0.0, 0),
            (-5.0, 0.0, -5.0, 0),
            (-5.0, 1.0, -5.0, 0),
            (-50.01, 1.0, 0.0, 0),
            (-9.99, 1.0, 0.0, 0),
            (-10.0, 1.0, 0.0, 0),
            (-50.0, 1.0, 0.0, 1),
            (None, 1.0, 0.0, 1),
        ],
        FARES,
    )
    assert [r[0] for r in rows(t.select(X.negative_fare_category()))] == [
        "normal",
        "cancelled",
        "full_refund",
        "large_refund",
        "small_adjustment",
        "voided",
        "partial_adjustment",
        "partial_adjustment",
    ]


def test_refund_is_never_minus_zero(spark):
    t = spark.createDataFrame([(0.0,), (-3.0,), (4.0,), (None,)], "fare_amount double")
    got = [r[0] for r in rows(t.select(X.refund_amount()))]
    assert got == [0.0, 3.0, 0.0, 0.0]
    assert math.copysign(1, got[0]) == 1


def test_interaction_has_no_decimal_point(spark):
    t = spark.createDataFrame([(1.0, 2.0), (None, 0.0)], "VendorID double, payment_type double")
    got = [r["vendor_payment_interaction"] for r in X.features_interaction(t).collect()]
    assert got == ["1_2", "nan_0"]


def test_fill_missing_by_type(spark):
    t = spark.createDataFrame([(None, None, None, None)], "a double, b int, c string, d timestamp_ntz")
    assert rows(X.fill_missing(t)) == [(0.0, 0, "0", None)]


def test_feature_set_is_the_same_without_the_target(sample):
    with_target = X.features_v1(sample).select("trip_id", *S.MODEL_NUMERIC, *S.MODEL_CATEGORICAL)
    without = X.features_v1(sample.drop(S.TARGET)).select("trip_id", *S.MODEL_NUMERIC, *S.MODEL_CATEGORICAL)
    assert with_target.exceptAll(without).count() == 0


def test_tip_suggestions(spark):
    t = spark.createDataFrame(
        [(20.0, 5.0, at(1), at(1, 30))],
        f"predicted double, trip_distance double, {S.PICKUP} timestamp_ntz, {S.DROPOFF} timestamp_ntz",
    )
    got = [(r["tip_rate"], round(r["tip"], 6), round(r["total_with_tip"], 6)) for r in X.tip_suggestions(t, "predicted").collect()]
    assert got == [(15, 3.0, 23.0), (20, 4.0, 24.0), (25, 5.0, 25.0)]
    first = X.tip_suggestions(t, "predicted").first()
    assert (first["fare_per_mile"], first["average_speed"]) == (4.0, 10.0)


def test_log_target_undoes_itself(spark):
    t = spark.createDataFrame([(0.0,), (9.5,), (-2.0,), (None,)], "total_amount double")
    got = rows(X.log_target(t).select("log_target_back"))
    assert [None if v is None else round(v, 9) for (v,) in got] == [0.0, 9.5, None, None]
