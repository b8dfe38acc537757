"""Boosted trees from histograms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.plans import boosting as B

SHAPE = "features array<double>, total_amount double, is_validation boolean, bins string, row string, margin string"


def made(n=4000, seed=1, noise=0.1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 5)).round(3)
    y = np.where(x[:, 0] > 0, 3.0, 0.0) + x[:, 1] * np.where(x[:, 2] > 0.5, 2.0, -1.0) + noise * rng.standard_normal(n)
    return x, y


@pytest.fixture(scope="module")
def rows(spark):
    x, y = made()
    t = spark.createDataFrame([(a.tolist(), float(b), i % 4 == 0, "x", "y", "z") for i, (a, b) in enumerate(zip(x, y))], SHAPE).cache()
    t.count()
    return t


def brute_split(bins, g, penalty, least):
    best = None
    for c in range(bins.shape[1]):
        for b in range(B.BINS):
            left = bins[:, c] <= b
            n, m = left.sum(), (~left).sum()
            if n >= least and m >= least:
                won = g[left].sum() ** 2 / (n + penalty) + g[~left].sum() ** 2 / (m + penalty) - g.sum() ** 2 / (n + m + penalty)
                if won > 1e-9 and (best is None or won > best[0] * (1 + 1e-12)):
                    best = won, c, b
    return best


@pytest.mark.parametrize("penalty,least", [(1.0, 1.0), (0.0, 7.0)])
def test_every_split_is_the_best_one(penalty, least):
    rng = np.random.default_rng(3)
    bins, g = rng.integers(0, 6, (300, 3)).astype(np.uint8), rng.standard_normal(300)
    s = B.Settings(penalty=penalty, min_child=least)
    tree = B.grow(bins, g, [0, 1, 2], 4, s)

    def check(node, at, depth):
        found = brute_split(bins[at], g[at], penalty, least) if depth else None
        assert tree.value[node] == pytest.approx(-g[at].sum() / (at.sum() + penalty))
        if found is None:
            assert tree.feature[node] == -1
            return
        assert (tree.feature[node], tree.bin[node]) == found[1:]
        left = bins[:, found[1]] <= found[2]
        check(tree.left[node], at & left, depth - 1)
        check(tree.right[node], at & ~left, depth - 1)

    check(0, np.ones(300, bool), 4)


def test_levels_by_sums_and_whole_subtrees_agree(rows, monkeypatch):
    s = B.Settings(trees=2, depth=5)
    whole = B.fit(rows, s)
    monkeypatch.setattr(B, "LOCAL_ROWS", 200)
    parts = B.fit(rows, s, edges=whole.edges)
    assert np.allclose(whole.curve, parts.curve)
    x, _ = made()
    assert np.allclose(whole.predict(x), parts.predict(x))


def test_columns_are_drawn_once_per_tree(rows):
    model = B.fit(rows, B.Settings(trees=6, depth=4, columns=0.4), validation=None)
    used = [{f for f in t.feature if f >= 0} for t in model.trees]
    assert all(len(u) <= 2 for u in used) and len(set().union(*used)) > 2


def test_rows_are_sampled_alike_every_time():
    row = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 20_000)
    one = B.sampled(row, 3, 0.8, 42)
    assert (one == B.sampled(row, 3, 0.8, 42)).all() and abs(one.mean() - 0.8) < 0.02
    assert abs((one & B.sampled(row, 4, 0.8, 42)).mean() - 0.64) < 0.02
    assert B.sampled(row, 0, 1.0, 1).all()


def test_training_stops_and_keeps_the_best_prefix(spark):
    x, y = made(600, noise=2.0)
    t = spark.createDataFrame([(a.tolist(), float(b), i % 3 == 0) for i, (a, b) in enumerate(zip(x, y))], "features array<double>, total_amount double, is_validation boolean")
    model = B.fit(t, B.Settings(trees=60, depth=12, rate=0.5, patience=3))
    losses = [b for _, b in model.curve]
    assert len(model.curve) < 60 and len(model.trees) == int(np.argmin(losses)) + 1
    assert len(model.curve) == len(model.trees) + 3
    shown = model.loss_table(spark)
    assert shown.where("kept").count() == len(model.trees) and shown.count() == len(model.curve)
    held = t.where("is_validation")
    rmse = model.transform(held).select(F.sqrt(F.avg((F.col("prediction") - F.col("total_amount")) ** 2))).first()[0]
    assert rmse == pytest.approx(min(losses))


def test_margins_are_stored_again_after_a_chunk(rows, monkeypatch):
    s = B.Settings(trees=5, depth=3)
    one = B.fit(rows, s)
    monkeypatch.setattr(B, "CHUNK", 2)
    assert np.allclose(one.curve, B.fit(rows, s, edges=one.edges).curve)


def test_validation_rows_teach_nothing(spark, rows):
    s = B.Settings(trees=2, depth=4)
    one = B.fit(rows, s)
    other = rows.withColumn("total_amount", F.when(F.col("is_validation"), 1e6).otherwise(F.col("total_amount")))
    two = B.fit(other, B.Settings(trees=2, depth=4, patience=99))
    assert one.base == two.base and one.edges == two.edges
    assert [t.value for t in one.trees[:1]] == [t.value for t in two.trees[:1]]


def test_model_as_a_table_scores_alike(spark, rows):
    model = B.fit(rows, B.Settings(trees=2, depth=3), validation=None)
    nodes = {(r.tree, r.node): r for r in model.nodes(spark).collect()}
    for r in model.transform(rows).limit(50).collect():
        total = model.base
        for tree in range(2):
            n = nodes[tree, 0]
            while n.feature is not None:
                n = nodes[tree, n.left if r.features[n.feature] <= n.edge else n.right]
            total += model.rate * n.value
        assert r.prediction == pytest.approx(total)


def test_odd_tables(spark):
    shape = "features array<double>, total_amount double, is_validation boolean"
    with pytest.raises(ValueError):
        B.fit(spark.createDataFrame([], shape))
    same = spark.createDataFrame([([1.0, 2.0], 5.0, False)] * 30 + [([1.0, 2.0], None, False)], shape)
    model = B.fit(same, B.Settings(trees=3))
    assert all(len(t.value) == 1 for t in model.trees)
    assert {round(r.prediction, 9) for r in model.transform(same).collect()} == {5.0}


def test_a_batch_without_rows_of_an_open_node_adds_nothing(spark, monkeypatch):
    x = np.repeat([[0.0, 1.0], [1.0, 0.0], [1.0, 1.0]], 200, axis=0)  # sorted: whole batches lie on one side
    y = np.where(x[:, 0] > 0, 5.0 + x[:, 1], 0.0)
    t = spark.createDataFrame([(a.tolist(), float(b), False, n) for n, (a, b) in enumerate(zip(x, y))], "features array<double>, total_amount double, is_validation boolean, n long").coalesce(1)
    monkeypatch.setattr(B, "LOCAL_ROWS", 100)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        model = B.fit(t, B.Settings(trees=1, depth=3, rate=1.0, rows=1.0, columns=1.0), keep=("n",))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert np.abs(model.predict(x) - y).max() < 0.1


def test_columns_of_few_bins_and_sliced_bytes():
    import pyarrow as pa

    cells = np.arange(12, dtype=np.uint8).reshape(4, 3)
    column = pa.array([c.tobytes() for c in cells], pa.binary())
    assert (B._bytes(column[1:3]) == cells[1:3]).all() and len(B._bytes(column[:0])) == 0


def test_trees_go_to_tasks_as_arrays():
    import pickle

    rng = np.random.default_rng(4)
    bins = rng.integers(0, 9, (500, 3)).astype(np.uint8)
    tree = B.grow(bins, rng.standard_normal(500), [0, 1, 2], 6, B.Settings())
    sent = pickle.loads(pickle.dumps(tree))
    assert all(isinstance(x, np.ndarray) for x in (sent.feature, sent.bin, sent.left, sent.right, sent.value))
    assert (sent.predict(bins) == tree.predict(bins)).all()
