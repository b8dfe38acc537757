"""Request rules, request scoring and run records."""

import pytest
from pyspark.sql import functions as F

from fareloom import schema as S
from fareloom.functions import rules as V
from fareloom.plans import scoring as C
from tests.conftest import rows

GOOD = ("2024-01-15 08:30:00", "2024-01-15 09:15:00", 5.2, 2, 1, 1, "n", 1, 0.0, 0.0, 0.0)
NAMES = S.REQUEST_SCHEMA.fieldNames()


def request(spark, **change):
    values = dict(zip(NAMES, GOOD)) | change
    return spark.createDataFrame([tuple(values[n] for n in NAMES)], S.REQUEST_SCHEMA)


def broken(spark, strict=False, **change):
    return V.validate_requests(request(spark, **change), strict).first()["violations"]


def test_a_good_request(spark):
    row = V.validate_requests(request(spark)).first()
    assert row["is_valid"] and row["violations"] == [] and row["store_and_fwd_flag"] == "N"
    assert broken(spark, strict=True) == []


@pytest.mark.parametrize(
    "field, value",
    [
        ("passenger_count", 5),
        ("passenger_count", -1),
        ("VendorID", 3),
        ("RatecodeID", 7),
        ("payment_type", 0),
        ("tip_amount", -1.0),
        ("tolls_amount", -0.01),
        ("store_and_fwd_flag", "X"),
        ("trip_distance", None),
        ("pickup_datetime", "2024-01-15T08:30:00"),
        ("pickup_datetime", "2024-02-30 08:30:00"),
        ("dropoff_datetime", None),
    ],
)
def test_each_rule(spark, field, value):
    assert broken(spark, **{field: value}) == [field]


def test_one_digit_parts_are_accepted(spark):
    assert broken(spark, pickup_datetime="2024-1-5 8:30:00") == []


@pytest.mark.parametrize("text", ["2024-01-05 08:30", "2024-01-05 08:30:00Z", "24-01-05 08:30:00", "2024-01-05", " "])
def test_other_time_forms_are_rejected(spark, text):
    assert broken(spark, pickup_datetime=text) == ["pickup_datetime"]


def test_request_times_ignore_a_clock_change(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        skipped = request(spark, pickup_datetime="2024-03-10 02:30:00", dropoff_datetime="2024-03-10 03:30:00")
        assert C.request_features(skipped).first()["trip_duration_minutes"] == 60.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_strict_rules(spark):
    assert broken(spark, True, passenger_count=0) == ["passenger_count"]
    assert broken(spark, True, trip_distance=100.5) == ["trip_distance"]
    assert broken(spark, True, dropoff_datetime="2024-01-15 08:30:00") == ["trip_order"]


def test_accepted_and_rejected_are_a_partition(spark):
    both = request(spark).unionByName(request(spark, VendorID=9))
    checked = V.validate_requests(both)
    assert V.accepted(checked).count() == 1 and V.rejected(checked).count() == 1


def test_request_features_estimate_the_fare(spark):
    known = C.request_features(request(spark, fare_amount=14.5, tip_amount=3.0)).first()
    guess = C.request_features(request(spark, tip_amount=3.0)).first()
    none = C.request_features(request(spark)).first()
    assert known["fare_amount"] == 14.5
    assert guess["fare_amount"] == pytest.approx(2.5 * 5.2 * 2.5)
    assert guess["tip_percentage"] == pytest.approx(3.0 / 32.5)
    assert (none["fare_amount"], none["tip_percentage"]) == (0.0, 0.0)
    assert none["trip_duration_minutes"] == 45.0
    assert (none["extra"], none["mta_tax"], none["congestion_surcharge"]) == (0.0, 0.5, 2.5)


def test_fare_to_show(spark):
    t = spark.createDataFrame([(-3.0,), (12.345678,)], "p double")
    assert rows(t.select(C.fare_to_show(F.col("p")))) == [(0.0,), (12.35,)]


VERSIONS = [("m", "1", "Production"), ("m", "2", "Staging"), ("m", "10", "None"), ("m", "9", "Production")]


@pytest.mark.parametrize("wanted, version", [("latest", "10"), ("production", "9"), ("staging", "2"), ("1", "1"), ("77", None)])
def test_version_choice(spark, wanted, version):
    t = spark.createDataFrame(VERSIONS, "model string, version string, stage string")
    got = [r["version"] for r in C.resolve_version(t, wanted).collect()]
    assert got == ([version] if version else [])


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_metrics_are_appended(spark, tmp_path, fmt):
    scored = spark.createDataFrame([(1.0,), (3.0,)], f"{S.PREDICTED} double")
    for run in ("a", "b"):
        C.append_metrics(C.run_metrics(scored, run, "m", "1"), str(tmp_path / "m"), fmt)
    back = C.read_metrics(spark, str(tmp_path / "m"), fmt)
    assert back.count() == 12
    values = dict(rows(back.where("run_id = 'b'").select("metric", "value")))
    assert values["prediction_std"] == 1.0 and values["n_predictions"] == 2.0
