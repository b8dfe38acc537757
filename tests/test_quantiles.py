"""The counting search must agree with Spark's own exact percentile."""

import math
import random

import pytest
from pyspark.sql import functions as F

from fareloom.operators import quantiles as Q
from tests.conftest import plan, rows

PROBS = (0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0)


def both(t, cols, probs=PROBS):
    found = Q.fit_quantiles(t, cols, probs)
    want = t.agg(*[F.percentile(c, list(probs)).alias(c) for c in cols]).first()
    for c in cols:
        got = found[c]
        expected = want[c] or [None] * len(probs)
        assert got == pytest.approx(expected, rel=1e-12), c


def test_random_columns(spark):
    rng = random.Random(7)
    data = [
        (
            rng.gauss(0, 1),
            round(rng.uniform(-50, 50), 2),
            math.exp(rng.uniform(-20, 20)) * rng.choice((-1, 1)),
            float(rng.choice((0, 0, 0, 1, 5))),
            None if rng.random() < 0.4 else rng.random(),
            3.25,
        )
        for _ in range(5000)
    ]
    t = spark.createDataFrame(data, "gauss double, cents double, wide double, few double, gaps double, same double")
    both(t, t.columns)


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_tiny_tables(spark, n):
    both(spark.createDataFrame([(float(i * i - 1),) for i in range(n)], "x double"), ["x"])


def test_close_values_need_more_passes(spark):
    data = [(1000.0 + i * 1e-9,) for i in range(3000)] + [(1e12,), (-1e12,)]
    both(spark.createDataFrame(data, "x double"), ["x"])


def test_hot_value_holds_a_third(spark):
    data = [(7.77,)] * 1000 + [(float(i),) for i in range(2000)]
    both(spark.createDataFrame(data, "x double"), ["x"])


def test_trip_columns(sample):
    t = sample.withColumn("per_mile", F.try_divide("fare_amount", "trip_distance"))
    both(t, ["fare_amount", "total_amount", "passenger_count", "per_mile"])


def test_empty_and_all_null(spark):
    empty = spark.createDataFrame([], "x double")
    nulls = spark.createDataFrame([(None,)], "x double")
    for t in (empty, nulls):
        assert Q.fit_quantiles(t, ["x"], (0.5,)) == {"x": [None]}


def test_nan_is_left_out(spark):
    t = spark.createDataFrame([(math.nan,), (1.0,), (3.0,), (None,)], "x double")
    assert Q.fit_quantiles(t, ["x"], (0.5, 1.0)) == {"x": [2.0, 3.0]}


def test_sketch_is_close(sample):
    exact = Q.fit_quantiles(sample, ["fare_amount"], (0.5,))["fare_amount"][0]
    rough = Q.fit_quantiles(sample, ["fare_amount"], (0.5,), exact=False)["fare_amount"][0]
    assert rough == pytest.approx(exact, rel=0.01)


def test_by_group(spark):
    t = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 5.0), (None, 6.0), (3, None)], "k int, x double")
    assert sorted(rows(Q.quantiles_by(t, "x", "k", (0.5,))), key=str) == [(1, [3.0]), (2, [5.0]), (None, [6.0])]
    assert Q.quantiles_by(t.limit(0), "x", "k", (0.5,)).count() == 0


def test_many_groups_and_a_hot_one(spark):
    rng = random.Random(3)
    data = [(i % 1500, rng.gauss(0, 10)) for i in range(6000)] + [(7, math.exp(rng.uniform(-9, 9))) for _ in range(3000)]
    t = spark.createDataFrame(data, "k int, x double")
    got = dict(rows(Q.quantiles_by(t, "x", "k", PROBS)))
    want = dict(rows(t.groupBy("k").agg(F.percentile("x", list(PROBS)))))
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_the_driver_sees_wanted_cells_only(spark):
    t = spark.range(5000).select(F.sin("id").alias("x"), F.exp(F.cos("id")).alias("y"))
    first = Q._wanted_cells(t, {"x": [], "y": []}, (0.1, 0.5), {})
    assert all(1 <= len(cells) <= 4 for cells in first.values())


def test_mode_takes_the_smallest_of_a_tie(spark):
    t = spark.createDataFrame([(3.0,), (3.0,), (1.0,), (1.0,), (2.0,), (None,)], "x double")
    assert Q.fit_modes(t, ["x"], "double") == {"x": 1.0}
    assert rows(Q.modes(Q.value_counts(t, ["x"]))) == [("x", 1.0, 2, 3, 5)]


def test_table_form(spark):
    t = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    assert rows(Q.quantiles(t, ["x"], (0.25, 0.5))) == [("x", 0.25, 1.5), ("x", 0.5, 2.0)]


def test_infinities_end_the_search(spark):
    data = [(float("-inf"),), (float("inf"),)] * 5 + [(x,) for x in (1.7e308, -1.7e308, 1e305, 2.5, -2.5)]
    t = spark.createDataFrame(data, "x double")
    found = Q.values_at(t, {"x": list(range(15))})["x"]
    assert [found[k] for k in range(15)] == sorted(x for (x,) in data)


def test_counting_makes_no_row_per_cell(spark):
    counts = Q._cell_counts(spark.range(9).select(F.col("id").cast("double").alias("x"), F.lit(1.0).alias("y")), {"x": [], "y": [(1.0, 1.0)]})
    assert "Generate" not in plan(counts) and sum(r["n"] for r in counts.collect()) == 18
