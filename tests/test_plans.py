"""What the plans must look like for tables that do not fit one machine."""

import os
import re

import pytest
from pyspark.sql import functions as F

from fareloom import schema as S
from fareloom.catalog import QUERIES
from fareloom.functions import features as X
from fareloom.functions.rules import validate_requests
from fareloom.operators import profile as P
from fareloom.operators import quality as Q
from fareloom.operators import sampling as R
from fareloom.operators import stats as A
from fareloom.session import settle
from fareloom.sources import requests as J
from fareloom.sources.trips import write_trips
from tests.conftest import SF, plan


@pytest.fixture(scope="module")
def stored(spark, sample, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "trips")
    write_trips(sample, path)
    return spark.read.parquet(path)


def reports(t):
    return {
        "hourly_means": P.hourly_means(t),
        "money_stats": P.money_stats(t),
        "value_dist": P.value_dist(t),
        "dow_dist": P.dow_dist(t),
        "top_locations": P.top_locations(t, "PULocationID"),
        "missing_profile": Q.missing_profile(t),
        "crosstab": Q.crosstab_margins(t, F.col("payment_type"), P.has_missing()),
        "quality_issues": Q.quality_issues(t),
        "corr_matrix": A.corr_matrix(X.with_duration(t)),
        "chi2": A.chi2(t, F.hour(S.PICKUP), P.has_missing()),
        "features": X.features_analysis(t),
        "features_v1": X.features_v1(t),
        "split": R.train_test_split(t, "trip_id"),
        "folds": R.stratified_folds(t, "trip_id"),
        "positions": R.row_positions(t, "trip_id", 1),
        "requests": validate_requests(J.requests_from_trips(t)),
    }


def test_no_python_and_no_cross_join(stored):
    for name, df in reports(stored).items():
        text = plan(df)
        for bad in ("EvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
            assert bad not in text, f"{name}: {bad}"


def test_features_and_splits_do_not_shuffle(stored):
    found = reports(stored)
    for name in ("features", "features_v1", "split", "requests"):
        assert "Exchange" not in plan(found[name]), name


def test_only_aggregated_rows_meet_in_one_partition(stored):
    for name, df in reports(stored).items():
        lines = plan(df).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                assert "HashAggregate" in lines[i + 1] or "HashAggregate" in lines[i + 2], name


def test_reports_read_only_their_columns(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    text = plan(P.hourly_means(stored))
    wanted = {S.PICKUP, S.DROPOFF, "trip_distance", "fare_amount", "total_amount"}
    read = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in read.split(",")} == wanted


def test_one_scan_per_wide_report(stored):
    for df in (Q.negative_counts(stored), P.missing_cells(stored), Q.neg_flag_summary(stored)):
        assert plan(df).count("FileScan") == 1


def test_intermediate_tables_take_less_room_than_by_default(spark, sample, tmp_path):
    def size(files):
        return sum(os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in files)

    sample.coalesce(1).write.parquet(str(tmp_path / "plain"))
    assert size(settle(sample.coalesce(1), "room").inputFiles()) < 0.9 * size(spark.read.parquet(str(tmp_path / "plain")).inputFiles())


def test_training_rows_are_dealt_evenly_over_the_cores(spark):
    from fareloom.session import dealt

    cores = spark.sparkContext.defaultParallelism
    uneven = spark.range(0, 9000, 1, cores - 1)
    sizes = [r[1] for r in dealt(uneven).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == cores and sum(sizes) == 9000 and max(sizes) - min(sizes) <= 2 * cores
    assert dealt(spark.range(0, 9000, 1, cores + 1)).rdd.getNumPartitions() == 2 * cores


def test_json_requests_are_read_in_two_casts(spark, capsys):
    sent = spark.createDataFrame([("{}",)], "body string")
    text = plan(validate_requests(J.parse_requests(sent)))
    assert "SchemaOfVariant" not in text and "$." not in text
    QUERIES["validate_json_requests"](spark, SF).explain("codegen")
    sizes = re.findall(r"Subtree \d / (\d) \(maxMethodCodeSize:(\d+)", capsys.readouterr().out)
    # One compiled stage, in methods that the JVM compiles too: it leaves those over 8,000 bytes alone.
    assert [n for n, _ in sizes] == ["1"] and int(sizes[0][1]) < 8000
