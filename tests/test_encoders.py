"""Fitted encoders: learned on one table, applied to another."""

import random

import pytest
from pyspark.sql import functions as F

from fareloom.operators import encode as E
from fareloom.plans.encoder import TripEncoder, fit_robust_at_once, flag_quantile, slot_names, slot_table
from tests.conftest import plan, rows


def test_standard_uses_population_deviation_and_survives_a_constant(spark):
    t = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (None, 7.0)], "a double, b double")
    fit = E.fit_standard(t, ["a", "b"])
    assert fit.median["a"] == 2.0 and fit.mean["a"] == 2.0
    assert fit.sd["a"] == pytest.approx((2 / 3) ** 0.5)
    assert [r["b"] for r in E.apply_standard(t, fit).collect()] == [0.0, 0.0, 0.0]


def test_robust_interpolates(spark):
    t = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    assert rows(E.apply_robust(t, E.fit_robust(t, ["x"]))) == [(-1 / 1.5,), (0.0,), (2 / 1.5,)]


def test_caps_keep_missing(spark):
    train = spark.createDataFrame([(float(i),) for i in range(101)], "x double")
    other = spark.createDataFrame([(-5.0,), (50.0,), (500.0,), (None,)], "x double")
    assert rows(E.apply_caps(other, E.fit_caps(train, ["x"]))) == [(1.0,), (50.0,), (99.0,), (None,)]


def test_gaps_flag_and_fill(spark):
    t = spark.createDataFrame([(1.0, "a"), (None, None), (5.0, "b")], "x double, s string")
    got = E.apply_gaps(t, E.fit_gaps(t, ["x"], ["s"])).select("x", "x_is_missing", "s")
    assert rows(got) == [(1.0, 0, "a"), (3.0, 1, "MISSING"), (5.0, 0, "b")]


def test_frequencies_count_the_missing_key_and_zero_the_unseen(spark):
    train = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    other = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    fitted = E.fit_frequencies(train, ["k"])
    got = {r["k"]: r["k_freq"] for r in E.apply_frequencies(other, fitted).collect()}
    assert got == {1: 2, 2: 0, None: 1}
    own = {r["k"]: r["k_freq"] for r in E.freq_encode(train, ["k"]).collect()}
    assert own == {1: 2, None: None}


def test_one_hot_unseen_and_first_level(spark):
    train = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "c string")
    other = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z"), (4, None)], "id int, c string")
    fit = E.fit_categories(train, ["c"])
    assert fit.known["c"] == ["a", "b"] and fit.fill["c"] == "b"
    got = sorted(rows(E.onehot_long(other, fit, ["id"])))
    assert got == [(1, "c", "a", 1), (2, "c", "b", 1), (4, "c", "b", 1)]
    assert sorted(rows(E.onehot_long(other, fit, ["id"], drop_first=True))) == [(2, "c", "b", 1), (4, "c", "b", 1)]
    wide = E.onehot_wide(other, fit)
    assert [tuple(r)[2:] for r in wide.collect()] == [(1, 0), (0, 1), (0, 0), (0, 1)]


def test_too_many_categories_are_refused(spark):
    t = spark.range(50).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError):
        E.fit_categories(t, ["c"], max_categories=10)


@pytest.mark.parametrize("style", ["standard", "robust"])
def test_trip_encoder_slots(spark, style):
    train = spark.createDataFrame(
        [(1.0, "a", 1), (2.0, "b", 1), (4.0, "it's", 1), (None, None, 1)], "x double, c string, k int"
    )
    model = TripEncoder(["x"], ["c", "k"], style).fit(train)
    encoded = model.transform(train)
    names = slot_names(encoded)
    if style == "standard":
        assert names == ["scaled_x", "is_c_a", "is_c_b", "is_c_it's", "is_k_1"]
    else:
        assert names == ["scaled_x", "missing_x", "is_c_a", "is_c_b", "is_c_it's"]
    unseen = spark.createDataFrame([(2.0, "zzz", 9)], "x double, c string, k int")
    vector = model.transform(unseen).first()["features"].toArray()
    assert all(v == 0 for n, v in zip(names, vector) if n.startswith("is_"))
    totals = {r["feature"]: r["rows"] for r in slot_table(encoded).collect()}
    assert totals["is_c_it's"] == 1


def test_mode_fill(spark):
    t = spark.createDataFrame([(2.0,), (2.0,), (1.0,), (None,)], "passenger_count double")
    assert [r[0] for r in rows(E.mode_fill(t))] == [2.0, 2.0, 1.0, 2.0]


def test_category_table_has_no_limit(spark):
    train = spark.range(50_000).select(F.concat(F.lit("k"), F.col("id")).alias("many"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("few"))
    table = E.fit_category_table(train, ["many", "few"])
    slots = {c: sorted(r.slot for r in table.where(F.col("column") == c).collect()) for c in ("many", "few")}
    assert slots == {"many": list(range(50_000)), "few": [0, 1]}
    with pytest.raises(ValueError, match="^many has 50000"):
        E.fit_categories(train, ["few", "many"])
    other = spark.createDataFrame([(1, "k7", None), (2, "unseen", 2), (3, None, 9)], "id int, many string, few int")
    got = sorted((r.id, r.column, r.category) for r in E.onehot_rows(other, table, ["many", "few"], ["id"]).collect())
    assert got == [(1, "few", "1"), (1, "many", "k7"), (2, "few", "2"), (3, "many", "k0")]
    vectors = {r.id: r.features for r in E.onehot_vectors(other, table, ["few", "many"], ["id"]).collect()}
    assert all(v["size"] == 50_002 for v in vectors.values())
    assert len(vectors[1]["indices"]) == 2 and vectors[1]["indices"] == sorted(vectors[1]["indices"]) and vectors[1]["values"] == [1.0, 1.0]
    assert vectors[2]["indices"][0] < 2 <= vectors[3]["indices"][0]


def test_category_table_fills_and_empty_columns(spark):
    t = spark.createDataFrame([("b", None), ("a", None), (None, None)], "x string, y string")
    named = {(r.column, r.category): r.slot for r in E.fit_category_table(t, ["x", "y"], "MISSING").collect()}
    assert set(named) == {("x", "a"), ("x", "b"), ("x", "MISSING"), ("y", "MISSING")} and named["y", "MISSING"] == 0
    assert {r.fill for r in E.fit_category_table(t, ["x"]).collect()} == {"a"}
    assert E.fit_category_table(t.limit(0), ["x"]).count() == 0


def test_missing_flag_is_centred_and_scaled_like_any_number(spark):
    import numpy as np

    for missing in (0, 10, 30, 55, 60, 80, 100):
        flag = np.array([0.0] * (100 - missing) + [1.0] * missing)
        assert [flag_quantile(100, 100 - missing, q) for q in (0.25, 0.5, 0.75)] == pytest.approx(np.quantile(flag, [0.25, 0.5, 0.75]))
    t = spark.createDataFrame([(float(i) if i % 5 < 2 else None, "a" if i % 2 else "b") for i in range(100)], "x double, s string")
    got = TripEncoder(["x"], ["s"], "robust").fit(t).transform(t)
    assert {(r.x is None, r.missing_x) for r in got.collect()} == {(True, 0.0), (False, -1.0)}


def test_limits_medians_and_quartiles_from_one_search(spark):
    """The three fits in a row, and no more passes than a single search takes."""
    from fareloom.operators import encode as E

    rng = random.Random(11)
    gap = lambda share, x: None if rng.random() < share else x
    data = [(rng.gauss(0, 9), gap(0.6, rng.random()), gap(0.3, float(rng.choice((0, 0, 1)))), gap(0.1, rng.uniform(-2, 40)), None) for _ in range(3001)]
    t = spark.createDataFrame([*data, (float("nan"), 1.0, 0.0, 2.0, None)], "a double, b double, c double, d double, e double")
    caps = E.fit_caps(t, t.columns)
    capped = E.apply_caps(t, caps)
    gaps = E.fit_gaps(capped, t.columns)
    scale = E.fit_robust(E.apply_gaps(capped, gaps, indicator=False), t.columns)
    found = fit_robust_at_once(t, t.columns)
    for c in t.columns:
        assert found[0][c] == (pytest.approx(caps[c], rel=1e-12) if c != "e" else caps[c]), c
        assert found[1][c] == pytest.approx(gaps.median[c], rel=1e-12), c
        assert found[2][c] == pytest.approx(scale[c], rel=1e-12), c


def test_slots_are_added_up_without_a_row_per_cell(spark, monkeypatch):
    from fareloom.plans import encoder

    held = []
    monkeypatch.setattr(encoder, "settle", lambda df, name: held.append(df) or df)
    t = spark.createDataFrame([(float(i), "ab"[i % 2]) for i in range(20)], "x double, c string")
    encoded = TripEncoder(["x"], ["c"]).fit(t).transform(t)
    found = {r["feature"]: r["rows"] for r in slot_table(encoded).collect()}
    assert "Generate" not in plan(held[0]) and sorted(found.values()) == [10, 10, 20]


def test_rows_of_a_frequent_category_are_not_gathered(spark):
    """Beside a column of many categories one of a few is still joined where its rows are."""
    n = E.MAX_CATEGORIES + 2000
    t = spark.range(n).select(F.col("id"), F.concat(F.lit("key-of-some-length-"), F.col("id")).alias("key"), (F.col("id") % 3).alias("kind"))
    table = E.fit_category_table(t, ["key", "kind"])
    with_few, with_many = (E.onehot_rows(t, table, cols, ("id",)) for cols in (["kind"], ["key"]))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        assert "SortMergeJoin" not in plan(with_few) and "SortMergeJoin" in plan(with_many)
        both = E.onehot_rows(t, table, ["kind", "key"], ("id",))
        assert both.columns == ["id", "column", "category", "slot", "value"]
        found = {r["column"]: (r["n"], r["slots"]) for r in both.groupBy("column").agg(F.count("*").alias("n"), F.count_distinct("slot").alias("slots")).collect()}
        assert found == {"kind": (n, 3), "key": (n, n)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
