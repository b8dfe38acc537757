"""Random forests from histograms."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from fareloom.plans import boosting as B
from fareloom.plans import forest as W
from fareloom.plans import models as M


@pytest.fixture(scope="module")
def given(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((6000, 5)).round(2)
    x[:, 4] = rng.random(6000) < 0.01  # a rare indicator that matters
    y = np.where(x[:, 0] > 0, 3.0, 0.0) + x[:, 1] * np.where(x[:, 2] > 0.5, 2.0, -1.0) + 9 * x[:, 4] + 0.1 * rng.standard_normal(6000)
    t = spark.createDataFrame([(a.tolist(), float(b), i % 4 == 0) for i, (a, b) in enumerate(zip(x, y))], "x array<double>, total_amount double, held boolean")
    from pyspark.ml.functions import array_to_vector

    t = t.select(array_to_vector("x").alias("features"), "total_amount", "held").cache()
    t.count()
    return t


def test_every_split_is_the_best_one_of_the_drawn_rows():
    rng = np.random.default_rng(3)
    cells, y, weight = rng.integers(0, 6, (3, 200)).astype(np.uint8), rng.standard_normal(200), rng.integers(1, 4, 200)
    tree = W.grow(cells, y, weight, 4)

    def sse(at):
        return (weight[at] * (y[at] - np.average(y[at], weights=weight[at])) ** 2).sum() if at.any() else 0.0

    def check(node, at, depth):
        assert tree["value"][node] == pytest.approx(np.average(y[at], weights=weight[at]))
        falls = [sse(at) - sse(at & (cells[c] <= b)) - sse(at & (cells[c] > b)) for c in range(3) for b in range(6)]
        if depth == 0 or max(falls) < 1e-9:
            assert tree["feature"][node] == -1
            return
        assert tree["won"][node] == pytest.approx(max(falls))
        left = cells[tree["feature"][node]] <= tree["bin"][node]
        check(tree["left"][node], at & left, depth - 1)
        check(tree["right"][node], at & ~left, depth - 1)

    check(0, np.ones(200, bool), 4)


def test_large_nodes_and_small_nodes_give_the_same_trees(given, monkeypatch):
    def model():
        return W.ForestModel(*W.fit(given, "features", "total_amount", 3, 6, 42), "features", "prediction")

    whole = model()
    monkeypatch.setattr(W, "LOCAL_ROWS", 500)
    monkeypatch.setattr(B, "TOGETHER", 2)
    monkeypatch.setattr(W, "TREES", 2)
    parts = model()
    x = np.stack([r[0].toArray() for r in given.select("features").collect()])
    # Where two features divide the drawn rows alike, a row that was not drawn may fall on another side.
    assert whole.edges == parts.edges and np.isclose(whole.predict(x), parts.predict(x)).mean() > 0.99
    for a, b in zip(whole.trees, parts.trees):
        assert len(a) == len(b) and len(a) > 40
        assert a["won"].sum() == pytest.approx(b["won"].sum())


def test_forest_is_as_good_as_sparks_and_is_saved_whole(given, tmp_path):
    learns, held = given.where("not held"), given.where("held")
    own = M.forest(trees=10, depth=10).fit(learns)
    other = RandomForestRegressor(featuresCol="features", labelCol="total_amount", numTrees=10, maxDepth=10, featureSubsetStrategy="all", seed=42).fit(learns)
    a, b = (M.evaluate(m.transform(held)).first()["rmse"] for m in (own, other))
    assert a < 1.05 * b
    assert own.featureImportances.toArray() == pytest.approx(other.featureImportances.toArray(), abs=0.03)
    PipelineModel([own]).write().overwrite().save(str(tmp_path / "forest"))
    loaded = M.load(str(tmp_path / "forest"))
    assert [r[0] for r in loaded.transform(held).select("prediction").collect()] == [r[0] for r in own.transform(held).select("prediction").collect()]


def test_deep_levels_exchange_rows_not_sums(given):
    """Sums of every node, feature and bin from every task grow with two to the depth; a tree's rows do not."""
    assert not isinstance(M.forest(), RandomForestRegressor)
    seen = []
    original = W._sums
    try:
        W._sums = lambda *a: seen.append(a) or original(*a)
        M.forest(trees=2, depth=15).fit(given)
    finally:
        W._sums = original
    assert not seen


def test_rows_are_drawn_as_often_as_they_are_there():
    row = np.arange(200_000) * 7_919
    drawn = W.times(row, 3, 42)
    assert abs(drawn.mean() - 1) < 0.01 and abs((drawn == 0).mean() - np.exp(-1)) < 0.005
    assert abs(np.corrcoef(drawn, W.times(row, 4, 42))[0, 1]) < 0.01


def test_sums_of_many_nodes_are_few_rows(spark):
    from fareloom.plans import packed as P

    rng = np.random.default_rng(9)
    cells, y = rng.integers(0, 8, (900, 4)).astype(np.uint8), rng.standard_normal(900)
    shape = "row long, label double, bins binary"
    stored = spark.createDataFrame([(i * 7_919, float(v), bytearray(c.tobytes())) for i, (c, v) in enumerate(zip(cells, y))], shape).repartition(3)
    tops, layout = [np.zeros(1, W.NODE) for _ in range(90)], P.Layout([8] * 4)
    for top in tops:
        top["feature"] = -1
    sums = W._sums(stored, tops, [(t, 0) for t in range(90)], layout, 0.5, 42)
    assert sums.count() == 3 * 2  # a row per task and 64 nodes
    found = {r.node: r for r in W.best_splits(sums, layout, 1.0).collect()}
    assert sorted(found) == list(range(90))
    for t in (0, 77):
        weight = W.times(np.arange(900) * 7_919, t, 42)
        tree = W.grow(np.ascontiguousarray(cells[weight > 0].T), y[weight > 0], weight[weight > 0], 1)
        assert (found[t].feature, found[t].bin) == (tree["feature"][0], tree["bin"][0])
        assert found[t].gain == pytest.approx(tree["won"][0]) and found[t].h == weight.sum()
