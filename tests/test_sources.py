"""Reading, writing, checking and narrowing trip tables and requests."""

import datetime as dt
import math

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fareloom import schema as S
from fareloom.functions.rules import request_rules, validate_requests, with_violations
from fareloom.sources import requests as J
from fareloom.sources import trips as IO
from tests.conftest import plan, rows


def test_parquet_round_trip_and_pushed_filter(spark, sample, tmp_path):
    path = IO.write_trips(sample, str(tmp_path / "t"))
    back = IO.read_trips(spark, path)
    assert back.exceptAll(sample).count() == 0 and back.count() == sample.count()
    some = IO.read_trips(spark, path, where="fare_amount < 0", columns=["trip_id", "fare_amount"])
    text = plan(some)
    assert "LessThan(fare_amount,0.0)" in text
    assert "ReadSchema: struct<trip_id:string,fare_amount:double>" in text


def test_write_by_date_prunes_partitions(spark, sample, tmp_path):
    path = IO.write_trips(sample.limit(200), str(tmp_path / "t"), by_date=S.PICKUP)
    text = plan(IO.read_trips(spark, path).where(f"{S.PICKUP}_day = date'1996-05-01'"))
    assert "PartitionFilters: [isnotnull" in text


def test_csv_by_suffix(spark, sample, tmp_path):
    some = sample.drop("trip_id").limit(50).cache()
    path = IO.write_csv(some, str(tmp_path / "t.csv"))
    back = IO.read_trips(spark, path)
    assert back.schema == S.TRIP_SCHEMA
    assert rows(back.agg(F.count("*"), F.count("RatecodeID"), F.max(S.PICKUP))) == rows(
        some.agg(F.count("*"), F.count("RatecodeID"), F.max(S.PICKUP))
    )


def test_missing_input_names_the_path(spark):
    with pytest.raises(AnalysisException, match="no/such/folder"):
        IO.read_trips(spark, "/no/such/folder")


def test_required_columns(sample):
    assert S.require_columns(sample) is sample
    with pytest.raises(S.MissingColumns, match="tip_amount"):
        S.require_columns(sample.drop("tip_amount"))
    assert S.missing_columns(sample.drop("VendorID"), ["VendorID", "trip_distance"]) == ["VendorID"]


def test_nan_becomes_null_on_read(spark, tmp_path):
    spark.createDataFrame([(math.nan,), (1.0,)], "trip_distance double").write.parquet(str(tmp_path / "n"))
    assert sorted(rows(IO.read_trips(spark, str(tmp_path / "n"))), key=str) == [(1.0,), (None,)]


def test_timestamps_that_do_not_parse_become_null(spark):
    t = spark.createDataFrame([("2024-01-05 08:30:00", "x")], f"{S.PICKUP} string, {S.DROPOFF} string")
    assert rows(IO.to_ts(t)) == [(dt.datetime(2024, 1, 5, 8, 30), None)]


def test_narrowing_tries_the_smallest_first(spark):
    t = spark.createDataFrame([(1, 40000, 2**40, None, 1.5)], "a bigint, b bigint, c bigint, d bigint, e double")
    assert [f.dataType.simpleString() for f in IO.narrow_types(t).schema.fields] == [
        "smallint",
        "int",
        "bigint",
        "bigint",
        "double",
    ]


def test_two_periods(spark, sample, tmp_path):
    a = IO.write_trips(sample.limit(30), str(tmp_path / "a"))
    b = IO.write_trips(sample.limit(20).drop("tip_amount"), str(tmp_path / "b"))
    both = IO.read_periods(spark, {"august": a, "september": b})
    assert dict(rows(both.groupBy("period").count())) == {"august": 30, "september": 20}


def test_requests_defaults_and_corrupt_lines(spark, tmp_path):
    lines = [
        '{"pickup_datetime": "2024-01-15 08:30:00", "dropoff_datetime": "2024-01-15 09:15:00", "trip_distance": 5.2}',
        "{not json",
    ]
    (tmp_path / "r.json").write_text("\n".join(lines))
    got = J.read_requests(spark, str(tmp_path / "r.json")).cache()
    good = got.where(F.col("trip_distance").isNotNull()).first()
    assert (good["passenger_count"], good["store_and_fwd_flag"], good["fare_amount"]) == (1, "N", 0.0)
    bad = got.where(F.col("trip_distance").isNull()).first()
    assert bad[J.CORRUPT] == "{not json"
    parsed = J.parse_requests(spark.createDataFrame([(line,) for line in lines], "body string"))
    assert parsed.where(F.col(J.CORRUPT).isNotNull()).count() == 1


def test_rows_from_literals(spark):
    t = J.rows_from_literals(spark, [(1, "Standard")], "code int, label string")
    assert rows(t) == [(1, "Standard")]


def test_csv_is_read_by_name_and_bad_cells_are_told(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        "tip_amount,fare_amount,tpep_pickup_datetime,more\n"
        "1.5,20,2024-01-05T08:30:00,x\n"
        ",7.25,2024-01-05 09:00:00,y\n"
    )
    got = IO.read_trips(spark, str(path))
    assert got.schema == S.TRIP_SCHEMA
    times = (dt.datetime(2024, 1, 5, 8, 30), dt.datetime(2024, 1, 5, 9))
    assert rows(got.select("fare_amount", "tip_amount", S.PICKUP)) == [(20.0, 1.5, times[0]), (7.25, None, times[1])]
    path.write_text("fare_amount,tip_amount\nabc,1\n3,\n")
    with pytest.raises(Exception, match="fare_amount"):
        IO.read_trips(spark, str(path)).collect()
    told = IO.read_trips(spark, str(path), bad_cells="bad").select("fare_amount", "tip_amount", "bad")
    assert rows(told) == [(None, 1.0, ["fare_amount"]), (3.0, None, [])]


def test_a_null_field_is_no_field_left_out(spark, tmp_path):
    good = '"pickup_datetime": "2024-01-15 08:30:00", "dropoff_datetime": "2024-01-15 09:15:00", "trip_distance": 5.2'
    lines = {
        "{%s}" % good: [],
        '{%s, "passenger_count": null}' % good: ["passenger_count"],
        '{%s, "passenger_count": "many"}' % good: ["passenger_count"],
        '{%s, "fare_amount": null, "tip_amount": null}' % good: ["fare_amount", "tip_amount"],
        '{%s, "fare_amount": [1]}' % good: ["fare_amount"],
        '{%s, "VendorID": 2, "other": {"a": 1}}' % good: [],
        '{"trip_distance": NaN}': None,
        "[1]": None,
        "null": None,
        "": None,
    }
    (tmp_path / "r.json").write_text("\n".join(lines))
    checked = validate_requests(J.read_requests(spark, str(tmp_path / "r.json"))).collect()
    assert len(checked) == 9  # an empty line is no request
    assert [r.violations for r in checked if r.trip_distance] == [v for v in lines.values() if v is not None]
    assert all("json" in r.violations for r in checked if not r.trip_distance)
    t = spark.createDataFrame([(float("nan"), 1.0), (1.0, float("inf"))], "trip_distance double, fare_amount double")
    rules = {k: v for k, v in request_rules().items() if k in t.columns}
    assert [r.v for r in with_violations(t, rules, "v").collect()] == [["trip_distance"], ["fare_amount"]]


def test_request_fields_of_other_types_and_names(spark):
    bodies = {
        '{"VendorID": 2, "tip_amount": 1.5}': (2, 1.5, None),
        '{"VendorID": 2.7, "tip_amount": "1.5"}': (2, 1.5, None),
        '{"VendorID": "2", "tip_amount": true}': (2, 1.0, None),
        '{"VendorID": 3000000000, "tip_amount": {"VendorID": 2}}': (None, None, None),
        '{"vendorid": 2, "a": {"tip_amount": 3}}': (1, 0.0, None),
        '{"VendorID": 1, "VendorID": 2}': (None, None, '{"VendorID": 1, "VendorID": 2}'),
        "{}": (1, 0.0, None),
        "[{}]": (None, None, "[{}]"),
    }
    parsed = J.parse_requests(spark.createDataFrame([(b,) for b in bodies], "body string"))
    got = {r.body: (r.VendorID, r.tip_amount, r[J.CORRUPT]) for r in parsed.collect()}
    assert got == bodies


def test_violations_are_listed_in_rule_order(spark):
    t = spark.createDataFrame([(None, 1.0), (1.0, None), (-float("inf"), float("nan")), (1.0, -0.0)], "trip_distance double, tip_amount double")
    rules = {k: v for k, v in request_rules().items() if k in t.columns}
    checked = with_violations(t, rules, "v")
    assert [r.v for r in checked.collect()] == [["trip_distance"], ["tip_amount"], ["trip_distance", "tip_amount"], []]
    assert not checked.schema["v"].dataType.containsNull
    assert with_violations(t, {}, "v").first()["v"] == []


def test_sums_over_64_bits_are_whole(spark, tmp_path):
    from fareloom.catalog import QUERIES

    for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
        t = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        t.withColumn(key, F.col(key) + 5 * 10**9).write.parquet(str(tmp_path / f"{name}.parquet"))
    (found,) = QUERIES["narrow_types"](spark, str(tmp_path)).collect()
    keys = spark.read.parquet(str(tmp_path / "lineitem.parquet")).agg(F.sum("l_orderkey"), F.count("l_orderkey")).first()
    assert found["big_key"] == keys[0] * 10**9 > 1 << 63
    assert found["order_part"] == keys[0] + 40000 * keys[1] and found["order_part_type"] == "bigint"
