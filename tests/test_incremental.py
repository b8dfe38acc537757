"""Reports from the rows that periods left."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.operators import incremental as G


def states(spark, rows):
    t = spark.createDataFrame(rows, "day int, x double, s string, n string, q string")
    return G.period_states(t, F.col("day"), ["x"], ["s"])


def test_merged_periods_equal_one_scan(spark):
    rng = np.random.default_rng(5)
    data = [(int(d), float(x), f"v{int(v)}", "n", "q") for d, x, v in zip(rng.integers(0, 9, 9000), 1e6 + 10 * rng.standard_normal(9000), rng.integers(0, 3000, 9000))]
    data += [(3, None, None, "n", "q"), (4, float("nan"), "v1", "n", "q"), (None, 1e6, "v2", "n", "q")]
    early, late = [r for r in data if r[0] is None or r[0] < 5], [r for r in data if r[0] is not None and r[0] >= 5]
    # The later periods are appended without reading the earlier ones again.
    both = states(spark, early).union(states(spark, late))
    got = {r["column"]: r for r in G.merged(both, (0.1, 0.5, 0.9)).collect()}
    x = np.array([r[1] for r in data if r[1] is not None and r[1] == r[1]])
    one = got["x"]
    assert (one["count"], one["min"], one["max"]) == (len(x), x.min(), x.max())
    assert one["mean"] == pytest.approx(x.mean(), rel=1e-12) and one["std"] == pytest.approx(x.std(ddof=1), rel=1e-6)
    for p in (10, 50, 90):
        assert abs((x <= one[f"p{p}"]).mean() - p / 100) < 0.015
    assert abs(one["distinct"] - len(set(x))) <= 0.03 * len(set(x))
    exact = len({r[2] for r in data if r[2] is not None})
    assert abs(got["s"]["distinct"] - exact) <= 0.03 * exact and got["s"]["count"] == sum(r[2] is not None for r in data)
    assert got["s"]["mean"] is None and got["s"]["p50"] is None
    rank = G.rank_of(both, "x", 1e6).first()["rank"]
    assert abs(rank - (x <= 1e6).mean()) < 0.015


def test_empty_and_missing_periods(spark):
    assert G.merged(states(spark, [])).count() == 0
    got = {r["column"]: r for r in G.merged(states(spark, [(1, None, None, "n", "q"), (2, 5.0, "a", "n", "q"), (2, 0.0, "b", "n", "q"), (3, -0.0, "a", "n", "q")])).collect()}
    assert (got["x"]["count"], got["x"]["mean"], got["x"]["distinct"]) == (3, pytest.approx(5 / 3), 2)
    none = {r["column"]: r for r in G.merged(states(spark, [(1, None, None, "n", "q")])).collect()}
    assert (none["x"]["count"], none["x"]["mean"], none["x"]["std"], none["x"]["p50"], none["x"]["distinct"]) == (0, None, None, None, 0)
