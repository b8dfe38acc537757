"""Samples, splits and folds are exact, disjoint and repeatable."""

import pytest
from pyspark.sql import functions as F

from fareloom.operators import sampling as R
from tests.conftest import rows


@pytest.fixture(scope="module")
def keyed(spark):
    t = spark.range(3000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 17).cast("double").alias("y"))
    return t.repartition(5).cache()


@pytest.mark.parametrize("n", [0, 1, 10, 700, 2999, 3000, 9999])
def test_sample_is_exact(keyed, n):
    got = {r["k"] for r in R.sample_n(keyed, n, "k", 1).collect()}
    order = [r["k"] for r in keyed.orderBy(F.md5(F.concat(F.lit("1|"), "k"))).collect()]
    assert got == set(order[:n])


def test_sample_narrows_the_prefix_when_groups_are_large(keyed, monkeypatch):
    monkeypatch.setattr(R, "GROUP_ROWS", 1)
    assert R.sample_n(keyed, 123, "k", 1).count() == 123


@pytest.mark.parametrize("group_rows", [10, 200_000])
def test_positions_equal_a_plain_row_number(keyed, monkeypatch, group_rows):
    monkeypatch.setattr(R, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(R, "PREFIX", 1)
    order = [r["k"] for r in keyed.orderBy(F.md5(F.concat(F.lit("5|"), "k"))).collect()]
    got = dict(rows(R.row_positions(keyed, "k", 5).select("k", "position")))
    assert got == {k: i + 1 for i, k in enumerate(order)}


def test_shuffle_is_repeatable_and_whole(keyed):
    a = rows(R.shuffle_order(keyed, "k").select("k"))
    b = rows(R.shuffle_order(keyed.repartition(3), "k").select("k"))
    assert a == b and len(set(a)) == 3000


def test_splits_are_disjoint_and_stable(keyed):
    a = R.train_test_split(keyed, "k")
    share = a.where("is_test").count() / 3000
    assert 0.17 < share < 0.23
    assert rows(a.orderBy("k")) == rows(R.train_test_split(keyed.repartition(2), "k").orderBy("k"))
    three = dict(rows(R.three_way_split(keyed, "k").groupBy("split").count()))
    assert sum(three.values()) == 3000 and set(three) == {"train", "validation", "test"}


def test_rows_without_a_key_are_kept(spark):
    t = spark.createDataFrame([("a",), (None,), (None,)], "k string")
    marked = R.train_test_split(t, "k")
    assert marked.where("is_test").count() + marked.where("not is_test").count() == 3
    assert R.sample_n(t, 3, "k").count() == 3
    assert sorted(r["position"] for r in R.row_positions(t, "k", 1).collect()) == [1, 2, 3]


def test_folds_cover_everything(keyed):
    sizes = dict(rows(R.kfold(keyed, "k").groupBy("fold").count()))
    assert sorted(sizes) == [0, 1, 2, 3, 4] and sum(sizes.values()) == 3000


def test_stratified_folds_differ_by_one_row_at_most(keyed):
    folded = R.stratified_folds(keyed, "k", "y", k=5, bins=4)
    assert folded.count() == 3000
    for r in folded.groupBy("bin").pivot("fold", [0, 1, 2, 3, 4]).count().collect():
        sizes = list(r)[1:]
        assert max(sizes) - min(sizes) <= 1


def test_bins_without_enough_edges_are_one_bin(spark):
    t = spark.createDataFrame([(1.0,)] * 50 + [(2.0,)], "total_amount double")
    assert {r["bin"] for r in R.quantile_bins(t).collect()} == {0}


def test_bins_are_closed_on_the_left(spark):
    t = spark.createDataFrame([(float(i),) for i in range(11)], "total_amount double")
    got = dict(rows(R.quantile_bins(t)))
    assert got == {float(i): min(i, 9) for i in range(11)}


def test_rows_without_a_key_spread_and_missing_groups_stay(spark):
    t = spark.range(1000).select(F.lit(None).cast("string").alias("k"), "id", F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("g"))
    folds = {r["fold"]: r["n"] for r in R.kfold(t, "k").groupBy("fold").agg(F.count("*").alias("n")).collect()}
    assert len(folds) == 5 and max(folds.values()) < 300
    assert 100 < R.train_test_split(t, "k").where("is_test").count() < 300
    placed = R.row_positions(t, "k", 1, by=("g",))
    got = placed.groupBy("g").agg(F.count("*").alias("n"), F.max("position").alias("hi"), F.count_distinct("position").alias("d"))
    assert sorted((r["n"], r["hi"], r["d"]) for r in got.collect()) == [(200, 200, 200)] * 5
    assert R.sample_n(t, 37, "k").count() == 37


def test_positions_carry_the_hash_as_bytes_in_the_order_of_its_digits(spark):
    from fareloom.functions.exprs import hash_key

    t = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    placed = R.row_positions(t, "key", 47)
    assert "unhex(" in placed._jdf.queryExecution().analyzed().toString()
    found = [r["key"] for r in placed.orderBy("position").collect()]
    assert found == [r["key"] for r in t.orderBy(hash_key("key", 47)).collect()]
