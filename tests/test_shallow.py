"""Boosted trees of few levels, from packed rows."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from fareloom.plans import forest as W
from fareloom.plans import models as M
from fareloom.plans import packed as P
from fareloom.plans import shallow as H


@pytest.fixture(scope="module")
def given(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((6000, 6)).round(2)
    x[:, 3] = 7.0  # divides nothing
    x[:, 4] = rng.random(6000) < 0.01  # a rare indicator that matters
    x[:, 5] = rng.integers(0, 5, 6000)
    y = np.where(x[:, 0] > 0, 3.0, 0.0) + x[:, 1] * np.where(x[:, 2] > 0.5, 2.0, -1.0) + 9 * x[:, 4] + 0.1 * rng.standard_normal(6000)
    t = spark.createDataFrame([(a.tolist(), float(b), i % 4 == 0) for i, (a, b) in enumerate(zip(x, y))], "x array<double>, total_amount double, held boolean")
    t = t.select(array_to_vector("x").alias("features"), "total_amount", "held").cache()
    t.count()
    return t


def test_numbers_hold_every_bin_and_give_exact_sums():
    rng = np.random.default_rng(1)
    widths = [32, 2, 1, 5, 2, 64, 3, 2000]
    layout = P.Layout(widths)
    cells = np.stack([rng.integers(0, w, 3000) for w in widths])
    numbers = layout.pack(iter(cells), 3000)
    assert len(layout.sizes) < len(widths) and max(layout.sizes) == 2000
    assert all((layout.of(numbers[layout.group[f]], f) == cells[f]).all() for f, w in enumerate(widths) if w > 1)
    at, y = rng.integers(0, 3, 3000), rng.standard_normal(3000)
    g, h = layout.empty(3), layout.empty(3)
    layout.sums(numbers, at, 3, (y, None), (g, h))
    g, h = layout.features(g, 3), layout.features(h, 3)
    for f, w in enumerate(widths):
        for n in range(3):
            a, b = layout.starts[f : f + 2]
            assert (h[n, a:b] == np.bincount(cells[f, at == n], minlength=w)).all()
            assert g[n, a:b] == pytest.approx(np.bincount(cells[f, at == n], y[at == n], w))
    which, cut, won, left_g, left_h = P.best_splits(g, h, layout)
    for n in range(3):
        c, v = cells[:, at == n], y[at == n]
        best = max(
            ((v[l].sum() ** 2 / l.sum() + v[~l].sum() ** 2 / (~l).sum() - v.sum() ** 2 / len(v), -f, -b) for f, w in enumerate(widths) for b in range(w) for l in (c[f] <= b,) if l.any() and not l.all())
        )
        assert won[n] == pytest.approx(best[0]) and (which[n], cut[n]) == (-best[1], -best[2])
        left = c[which[n]] <= cut[n]
        assert left_h[n] == left.sum() and left_g[n] == pytest.approx(v[left].sum())


def test_a_walk_ends_where_every_comparison_leads():
    rng = np.random.default_rng(2)
    layout = P.Layout([9, 4, 2, 30])
    cells = np.stack([rng.integers(0, w, 500) for w in layout.widths])
    tree = np.zeros(7, P.NODE)
    tree["feature"] = [3, 0, -1, -1, 1, -1, -1]
    tree["bin"] = [11, 4, 0, 0, 2, 0, 0]
    tree["left"], tree["right"] = [1, 3, 0, 0, 5, 0, 0], [2, 4, 0, 0, 6, 0, 0]

    def leaf(row, node=0):
        if tree["feature"][node] < 0:
            return node
        return leaf(row, tree["left" if row[tree["feature"][node]] <= tree["bin"][node] else "right"][node])

    found = P.Walk(tree, layout).nodes(layout.pack(iter(cells), 500))
    assert found.tolist() == [leaf(row) for row in cells.T]


def test_edges_are_exact_for_few_values_and_near_the_quantiles_otherwise(spark, monkeypatch):
    monkeypatch.setattr(P, "SORTED", 700)
    monkeypatch.setattr(P, "POINTS", 256)
    rng = np.random.default_rng(3)
    x = np.stack([rng.integers(0, 20, 40_000), rng.lognormal(0, 2, 40_000), np.full(40_000, 3.0), rng.random(40_000) < 0.001], axis=1).astype(float)
    x[::50, 1] = np.nan
    t = spark.createDataFrame([(v.tolist(),) for v in x], "x array<double>").repartition(5)
    few, many, one, rare = P.quantile_edges(t, "x", 4, 32)
    assert few == list(range(19)) and one == [] and rare == [0.0]
    ranks = np.searchsorted(np.sort(x[~np.isnan(x[:, 1]), 1]), many, "right") / (~np.isnan(x[:, 1])).sum()
    assert len(many) == 31 and np.abs(ranks - np.arange(1, 32) / 32).max() < 0.01


def test_trees_are_those_of_rows_at_hand(given):
    got = given.select("features", "total_amount").collect()
    x, y = np.stack([r[0].toArray() for r in got]), np.array([r[1] for r in got])
    edges, trees, weights = H.fit(given, "features", "total_amount", 5, 6, 0.3)
    cells, left = np.stack([*P.bins(x, edges)]).astype(np.uint8), y
    for n, (tree, weight) in enumerate(zip(trees, weights)):
        whole = W.grow(cells, left * (2 if n else 1), np.ones(len(y), np.int64), 6)
        a, b = (t["value"][W.leaves(t, cells)] for t in (tree, whole))
        assert len(tree) == len(whole) and np.isclose(a, b).all() and weight == (0.3 if n else 1.0)
        assert tree["won"].sum() == pytest.approx(whole["won"].sum())
        left = left - weight * a


def test_a_large_table_is_learned_as_well_as_by_sparks_trees(given, tmp_path, monkeypatch):
    x = vector_to_array("features")  # a sum of effects: greedy trees then hardly depend on the edges
    given = given.withColumn("total_amount", 3 * (x[0] > 0).cast("int") + F.exp(x[1] / 2) + x[2] + 9 * x[4]).cache()
    learns, held = given.where("not held"), given.where("held")
    other = M.gbt(trees=12, depth=4).fit(learns)
    assert isinstance(other, GBTRegressionModel)  # few rows
    monkeypatch.setattr(H, "SMALL", 100)
    monkeypatch.setattr(H, "CHUNK", 5)
    own = M.gbt(trees=12, depth=4).fit(learns)
    assert isinstance(own, H.BoostedModel)
    a, b = (M.evaluate(m.transform(held)).first()["rmse"] for m in (own, other))
    assert a < 1.05 * b
    assert own.treeWeights == pytest.approx(other.treeWeights) and own.getNumTrees == 12
    assert own.featureImportances.toArray() == pytest.approx(other.featureImportances.toArray(), abs=0.1)
    losses = own.evaluateEachIteration(held, "squared")
    assert len(losses) == 12 and losses == sorted(losses, reverse=True) and losses[0] == pytest.approx(other.evaluateEachIteration(held, "squared")[0], rel=0.1)
    assert losses[-1] == pytest.approx(a**2)
    PipelineModel([own]).write().overwrite().save(str(tmp_path / "boosted"))
    loaded = M.load(str(tmp_path / "boosted"))
    assert [r[0] for r in loaded.transform(held).select("prediction").collect()] == [r[0] for r in own.transform(held).select("prediction").collect()]
    again = M.gbt(trees=12, depth=4).fit(learns)
    assert all((s == t).all() for s, t in zip(own.trees, again.trees))


def test_what_the_packed_trees_do_not_do_is_left_to_spark(given, monkeypatch):
    monkeypatch.setattr(H, "SMALL", 100)
    for more in ({"subsamplingRate": 0.5}, {"validationIndicatorCol": "held"}, {"minInstancesPerNode": 3}, {"cacheNodeIds": True}):
        assert isinstance(M.gbt(trees=2, depth=2, **more).fit(given), GBTRegressionModel)


def test_rows_without_a_label_and_tables_without_rows(spark, given, monkeypatch):
    monkeypatch.setattr(H, "SMALL", 0)
    same = given.limit(30).select("features", F.when(F.rand(1) < 0.5, 5.0).alias("total_amount")).cache()
    model = M.gbt(trees=3, depth=2).fit(same)
    assert {round(r[0], 9) for r in model.transform(same).select("prediction").collect()} == {5.0}
    assert M.gbt(trees=2).fit(given.repartition(1).repartition(9)).getNumTrees == 2
    with pytest.raises(ValueError):
        H.fit(given.where("false"), "features", "total_amount", 2, 2, 0.1)
