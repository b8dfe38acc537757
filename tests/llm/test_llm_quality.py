import random

import numpy as np
import pytest

from fareloom.llm import quality

LABELS = "doc_id long, quality int, toxic int, id string, at string, low string"


def labels(spark, rows):
    return spark.createDataFrame([(i, q, 0, "x", "x", "x") for i, q in rows], LABELS)


def corpus(n, seed=3):
    """Rows of (id, text) and whether the text is good: prose, or shouted, marked or repeated junk."""
    rng = random.Random(seed)
    word = ["".join(rng.choice("abcdeéo") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    rows, good = [], {}
    for i in range(n):
        text = " ".join(rng.choice(word) for _ in range(rng.randint(20, 120))) + "."
        good[i] = rng.random() < 0.7
        if not good[i]:
            text = rng.choice([text.upper(), text.replace(" ", "$$$ "), " ".join([text.split()[0]] * 80)])
        rows.append((i, text))
    return rows, good


def test_held_out_accuracy_and_prior(spark, table):
    rows, good = corpus(1200)
    docs = table(rows)
    train = docs.where(~quality.held_out("doc_id"))
    # Only some good documents are known to be good; bad labels teach nothing.
    known = labels(spark, [(i, int(g)) for i, g in good.items() if i % 3 == 0])
    model = quality.learn(train, known.where(~quality.held_out("doc_id")))
    assert 0.6 < model.prior < 0.85
    found = quality.score(docs.where(quality.held_out("doc_id")), model).collect()
    assert len(found) > 150
    right = sum((r.score >= 0.5) == good[r.doc_id] for r in found)
    assert right / len(found) > 0.97
    again = quality.learn(train, known.where(~quality.held_out("doc_id")))
    assert (again.weights == model.weights).all()


def test_labels_of_held_out_rows_and_bad_labels_change_nothing(spark, table):
    rows, good = corpus(200)
    train = table(rows).where(~quality.held_out("doc_id"))
    known = [(i, 1) for i, g in good.items() if g and i % 2]
    models = [
        quality.learn(train, labels(spark, rows).where(~quality.held_out("doc_id")))
        for rows in (known, known + [(i, 0) for i, g in good.items() if not g] + [(None, 1), (10**9, 1)])
    ]
    assert (models[0].weights == models[1].weights).all()


def test_every_row_has_a_score(spark, table, awkward):
    rows, good = corpus(100)
    docs = table(rows + [(1000 + (r[0] or 0) if r[0] is not None else None, r[1]) for r in awkward])
    model = quality.learn(docs, labels(spark, [(i, int(g)) for i, g in good.items()]))
    found = quality.score(docs, model).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    empty = {r.doc_id: r.score for r in found}
    assert empty[1020] == empty[1021]  # missing and empty texts agree
    assert quality.score(docs.limit(0), model).count() == 0


def test_without_labels_or_rows(spark, table):
    docs = table([(1, "a b"), (2, None)])
    assert quality.learn(docs, labels(spark, [])) is None
    assert quality.learn(docs.limit(0), labels(spark, [(1, 1)])) is None
    assert [r.score for r in quality.score(docs, None).collect()] == [0.5, 0.5]
    # A contradicted label is not trusted.
    assert quality.learn(docs, labels(spark, [(1, 1), (1, 0), (2, None)])) is None


def test_features_do_not_depend_on_the_chunk(monkeypatch):
    text = ("Ab cd!! é\n" * 500).encode()
    whole = quality.features(text)
    monkeypatch.setattr(quality, "CHUNK", 37)
    assert np.allclose(quality.features(text), whole)


@pytest.mark.parametrize("prior", [0.2, 0.6])
def test_slopes_match_finite_differences(prior):
    rng = np.random.default_rng(1)
    good, web, w = rng.standard_normal((9, 4)), rng.standard_normal((13, 4)) - 1, 0.1 * rng.standard_normal(5)
    plus, minus, g = quality.risk(w, good, web, prior)
    assert minus > 0
    for i in range(5):
        step = np.eye(5)[i] * 1e-6
        up, down = (sum(quality.risk(w + s, good, web, prior)[:2]) for s in (step, -step))
        assert abs((up - down) / 2e-6 - g[i]) < 1e-5


def test_a_negative_part_turns_the_step():
    good, web, prior, w = np.array([[1.0]]), np.array([[0.9], [0.8]]), 0.99, np.array([3.0, 0.0])
    _, minus, g = quality.risk(w, good, web, prior)
    u, p = (1 / (1 + np.exp(-3 * x)) for x in (web, good))
    assert minus == 0.0
    assert np.allclose(g, [prior * (p * good).mean() - (u * web).mean(), prior * p.mean() - u.mean()])
