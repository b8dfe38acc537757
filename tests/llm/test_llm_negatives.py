import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, id string, unit string, kind string, wants string, score string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA)


def by_hand(rows, positives=5, negatives=3):
    taken = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            taken[i] = min(taken.get(i, (label, v)), (label, v))
    whole = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in taken.items()}
    out = []
    for a, (label, v) in whole.items():
        if a % 50:
            continue
        scores = [(-sum(x * y for x, y in zip(v, w)), i, m == label) for i, (m, w) in whole.items() if i != a and len(w) == len(v)]
        scores.sort()
        for s, p, _ in [t for t in scores if t[2]][:positives]:
            fits = [t for t in scores if not t[2] and 50 * -s <= 100 * -t[0] <= 95 * -s]
            out += [(a, p, n + 1, t[1], -s, -t[0]) for n, t in enumerate(fits[:negatives])]
    return sorted(out)


def found(spark, rows):
    return sorted(tuple(r) for r in hard_negatives.mine(table(spark, rows), F.col("vec_id") % 50 == 0).collect())


def vectors(n, size, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal(size)
    return (scale * (centre + 0.7 * rng.standard_normal((n, size)))).tolist()


def test_packed_products_are_exact():
    rng = random.Random(1)
    for size, most in ((1, 3), (64, 300), (64, 1 << 20), (5, 1 << 40), (3, 1 << 200)):
        rows = [[rng.randint(-most, most) for _ in range(size)] for _ in range(37)]
        anchor = [rng.randint(-most, most) for _ in range(size)]
        kind = np.int64 if most < 1 << 31 else object
        got = hard_negatives.Packed(np.array(rows, dtype=kind)).scores(np.array(anchor, dtype=kind))
        assert got.tolist() == [sum(x * y for x, y in zip(anchor, r)) for r in rows]
    rows, anchor = [[10**9 + i, 10**9] for i in range(9)], [3 * 10**9, 10**9]
    got = hard_negatives.Packed(np.array(rows)).scores(np.array(anchor))
    assert got.tolist() == [sum(x * y for x, y in zip(anchor, r)) for r in rows]
    same = hard_negatives.Packed(np.array([[7, 7], [7, 7]]))
    assert same.scores(np.array([-2, -2])).tolist() == [-28, -28]


@pytest.mark.parametrize("group,fields", [(2048, 512), (3, 7)])
def test_mined_negatives_equal_all_pairs(spark, monkeypatch, group, fields):
    monkeypatch.setattr(hard_negatives, "GROUP", group)
    monkeypatch.setattr(hard_negatives, "FIELDS", fields)
    rng = random.Random(group)
    rows = [(i, v, 0 if rng.random() < 0.4 else rng.randint(0, 4)) for i, v in enumerate(vectors(700, 8, 3))]
    rows += [(2000 + i, rows[100][1], rng.randint(0, 2)) for i in range(60)]  # many ties
    assert found(spark, rows) == by_hand(rows)


def test_awkward_vectors(spark):
    rows = [(i, v, i % 3) for i, v in enumerate(vectors(120, 4, 5))]
    rows += [(200 + i, v, i % 2) for i, v in enumerate(vectors(110, 6, 6))] + [(400 + i, [], i % 2) for i in range(60)]
    rows += [(500, None, 1), (550, [1.0, None, 1.0, 1.0], 1), (600, [1.0, float("nan"), 1.0, 1.0], 1), (650, [float("inf")] * 4, 1)]
    rows += [(700, [1.0] * 4, None), (None, [1.0] * 4, 1), (750, [0.0] * 4, 1), (50, [0.5] * 4, 0), (50, [0.5] * 4, 0)]
    assert found(spark, rows) == by_hand(rows)


def test_huge_components_and_tables_without_partners(spark):
    rows = [(i, v, i % 3) for i, v in enumerate(vectors(110, 4, 8, scale=8e5))]
    assert found(spark, rows) == by_hand(rows)
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0], 1), (1, [1.0], 2)]) == []
    assert found(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == []
    far = [(0, [1e30], 1), (1, [1e30], 1), (2, [0.7e30], 2)]
    assert len(found(spark, far)) <= 1
