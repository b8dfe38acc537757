"""Reports on edge cases: empty tables, constant columns, ties, gaps."""

import pytest
from pyspark.sql import functions as F

from fareloom import schema as S
from fareloom.functions.tails import chi2_tail, student_tail
from fareloom.operators import profile as P
from fareloom.operators import quality as Q
from fareloom.operators import stats as A
from tests.conftest import rows


def test_shape_of_constant_and_single_values(spark):
    t = spark.createDataFrame([(1.0, 5.0)], "a double, b double")
    one = {r["column"]: r for r in P.shape_stats(t, ["a", "b"]).collect()}
    assert one["a"]["skewness"] is None and one["a"]["kurtosis"] is None
    same = spark.createDataFrame([(1.0,)] * 6, "a double")
    r = P.shape_stats(same, ["a"]).first()
    assert (r["median"], r["mode"], r["skewness"]) == (1.0, 1.0, None)


def test_reports_survive_an_empty_table(sample):
    empty = sample.where("false")
    for report in (
        P.describe_numeric(empty),
        P.iqr_outliers(empty),
        P.duration_stats(empty),
        P.speed_report(empty),
        P.tip_report(empty),
        P.target_dist(empty),
        Q.refund_stats(empty),
        Q.missing_overlap(empty),
        Q.anomaly_counts(empty),
        A.welch_t(empty.withColumn("trip_duration_minutes", F.lit(1.0)), P.has_missing()),
    ):
        report.collect()
    assert P.value_dist(empty).count() == 0


def test_peak_hour_tie_goes_to_the_earlier(spark):
    counts = spark.createDataFrame([(3, 10), (5, 10), (7, 1), (9, 1)], "k int, n int")
    assert rows(P._extremes(counts, "k", "n", "peak", "low")) == [(3, 10, 7, 1)]


def test_correlation_of_a_constant_is_missing(spark):
    t = spark.createDataFrame([(1.0, 1.0, None), (1.0, 2.0, 5.0), (1.0, 4.0, 9.0)], "a double, b double, c double")
    got = {(r["left"], r["right"]): r["correlation"] for r in A.corr_matrix(t, ["a", "b", "c"]).collect()}
    assert got["a", "b"] is None and got["a", "a"] is None
    assert got["b", "c"] == pytest.approx(1.0)
    assert got["c", "b"] == got["b", "c"]


def test_near_constant(spark):
    data = [(1.0, 1.0, float(i % 3), None, 0.0) for i in range(400)]
    data[0] = (1.0, 2.0, 0.0, None, None)
    t = spark.createDataFrame(data, "same double, rare double, three double, nothing double, zero_or_null double")
    got = {r["feature"]: r["distinct"] for r in P.near_constant(t, t.columns).collect()}
    assert got == {"same": 1, "rare": 2, "nothing": 0, "zero_or_null": 1}


def test_distinct_counts_treat_minus_zero_as_zero(spark):
    t = spark.createDataFrame([(0.0, "a"), (-0.0, "b"), (None, None)], "x double, s string")
    assert dict(rows(P.distinct_counts(t, ["x", "s"]))) == {"x": 1, "s": 2}


def test_margins_are_not_counted_twice(spark):
    t = spark.createDataFrame([("p", True), ("p", False), ("q", False)], "a string, b boolean")
    got = {(r["a"], r["b"]): (r["n"], r["row_pct"]) for r in Q.crosstab_margins(t, F.col("a"), F.col("b")).collect()}
    assert got["p", "true"] == (1, 50.0)
    assert got["p", "All"] == (2, 100.0)
    assert got["All", "All"] == (3, 100.0)


def test_missing_profile_lists_gaps_first(spark):
    t = spark.createDataFrame([(1, None, None), (2, None, 1.0)], "a int, b string, c double")
    got = [(r["column"], r["type"], r["missing"], r["missing_pct"]) for r in Q.missing_profile(t).collect()]
    assert got == [("b", "string", 2, 100.0), ("c", "double", 1, 50.0)]


def test_welch_against_known_values(spark):
    a, b = [1.0, 2.0, 3.0, 4.0, 5.0], [2.0, 4.0, 6.0, 8.0, 10.0, 12.0]
    t = spark.createDataFrame([(True, x) for x in a] + [(False, x) for x in b], "g boolean, x double")
    r = A.welch_test(t, F.col("g"), ["x"]).first()
    # Worked by hand: variances 2.5 and 14, so t = -4 / sqrt(0.5 + 14/6).
    assert r["t"] == pytest.approx(-4 / (0.5 + 14 / 6) ** 0.5)
    assert r["dof"] == pytest.approx((0.5 + 14 / 6) ** 2 / (0.25 / 4 + (14 / 6) ** 2 / 5))
    assert 0.03 < r["p_value"] < 0.06


TABLE = [(2.228139, 10, 0.05), (1.959964, 1e7, 0.05), (12.7062, 1, 0.05), (0.0, 5, 1.0), (-2.228139, 10, 0.05), (1e-4, 3, 0.9999265), (40.0, 200, 0.0)]


def test_student_tail_matches_tables(spark):
    t = spark.createDataFrame([(float(a), float(b), c) for a, b, c in TABLE], "t double, dof double, p double")
    for r in t.select("p", student_tail(F.col("t"), F.col("dof")).alias("got")).collect():
        assert r.got == pytest.approx(r.p, abs=2e-6)
    odd = [(None, 3.0), (1.0, None), (float("nan"), 3.0), (float("inf"), 3.0), (1.0, 0.0), (1.0, -1.0)]
    t = spark.createDataFrame(odd, "t double, dof double")
    assert all(r.p is None for r in t.select(student_tail(F.col("t"), F.col("dof")).alias("p")).collect())


def test_chi2_tail_matches_tables(spark):
    table = [(3.841459, 1, 0.05), (18.307038, 10, 0.05), (124.342113, 100, 0.05), (2.0, 2, 0.36787944), (0.0, 4, 1.0), (0.1, 1, 0.75182963)]
    t = spark.createDataFrame([(a, b, c) for a, b, c in table], "x double, dof long, p double")
    for r in t.select("p", chi2_tail(F.col("x"), F.col("dof")).alias("got")).collect():
        assert r.got == pytest.approx(r.p, abs=1e-7)
    assert t.select(chi2_tail(F.col("x"), F.lit(0)).alias("p")).first().p is None


def test_margins_and_values_of_the_same_name_stay_apart(spark):
    t = spark.createDataFrame([("All", "x"), ("All", "null"), (None, "x"), ("null", None), ("q", "All")], "a string, b string")
    got = {(r.all_a, r.a, r.all_b, r.b): (r.n, r.row_pct) for r in Q.crosstab_margins(t, F.col("a"), F.col("b")).collect()}
    assert got[False, "All", True, "All"] == (2, 100.0) and got[False, "All", False, "x"] == (1, 50.0)
    assert got[True, "All", False, "x"] == (2, 40.0) and got[True, "All", True, "All"] == (5, 100.0)
    assert got[False, None, True, "All"] == (1, 100.0) and got[False, "null", False, None] == (1, 100.0)
    assert got[True, "All", False, "All"] == (1, 20.0) and len(got) == 5 + 4 + 4 + 1


def test_chi2_forms_agree(sample):
    a, b = F.hour(S.PICKUP), P.has_missing()
    ours = A.chi2(sample, a, b).first()
    spark_test = A.chi2_test(sample, a, b.cast("int")).first()
    assert ours["statistic"] == pytest.approx(spark_test["statistic"])
    assert ours["dof"] == spark_test["dof"]


def test_fold_lines_never_see_their_fold(spark):
    data = [(f, float(x), 2.0 * x + f) for f in range(3) for x in range(5)]
    t = spark.createDataFrame(data, "fold int, fare_amount double, total_amount double")
    lines = A.fit_fold_lines(t, "fold", 3)
    for f, line in enumerate(lines):
        alone = A.fit_line(t.where(F.col("fold") != f))
        assert (line.slope, line.intercept) == pytest.approx((alone.slope, alone.intercept))


def test_regression_metrics_by_hand(spark):
    t = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0), (None, 9.0)], "y double, p double")
    r = A.regression_metrics(t, "y", "p").first()
    assert (r["n"], r["mse"], r["mae"]) == (3, pytest.approx(5 / 3), pytest.approx(1.0))
    assert r["r2"] == pytest.approx(1 - 5 / 8)


def test_near_constant_and_modes_keep_large_integers_and_texts(spark):
    big = 1 << 60
    t = spark.createDataFrame([(big + 1, "a", True, None)] * 150 + [(big + 2, "b", True, None)], "n long, s string, b boolean, e string")
    got = {r.feature: (r.distinct, r.top_share) for r in P.near_constant(t, ["n", "s", "b", "e"]).collect()}
    assert got == {"n": (2, 150 / 151), "s": (2, 150 / 151), "b": (1, 1.0), "e": (0, None)}
    three = spark.createDataFrame([(big,)] * 2 + [(big + 1,)] * 2 + [(5,)] * 3, "n long")
    assert P.shape_stats(three, ["n"]).first()["mode"] == 5.0


def test_columns_of_three_values_are_not_aggregated(spark):
    t = spark.createDataFrame([(float(i), 1.0, float("nan")) for i in range(9)], "many double, one double, nan double")
    found = {r["feature"]: r["distinct"] for r in P.near_constant(t, t.columns).collect()}
    assert found == {"one": 1, "nan": 1}
    assert P.near_constant(t, ["many"]).collect() == []


def test_stored_analysis_holds_only_what_the_reports_read(spark):
    from fareloom.catalog import reports

    held = set(reports.analysis_table(spark, "/root/testdata/sf0.001").columns)
    assert "trip_id" not in held and set(S.ANALYSIS_COLUMNS) <= held


def test_the_method_limit_is_given_back(spark):
    from fareloom.session import METHOD_CONF, split_methods

    given = spark.conf.get(METHOD_CONF)
    try:
        for limit, inside in (("65535", "8000"), ("5000", "5000")):
            spark.conf.set(METHOD_CONF, limit)
            with pytest.raises(KeyError), split_methods(spark):
                assert spark.conf.get(METHOD_CONF) == inside
                raise KeyError
            assert spark.conf.get(METHOD_CONF) == limit
    finally:
        spark.conf.set(METHOD_CONF, given)
