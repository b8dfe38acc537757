"""Text quality from trusted positives and unlabelled text, by non-negative risk.

Only documents labelled good are trusted; everything else, labelled bad or not at all, is unlabelled web
text, a mixture of good and bad. A linear score over hashed byte trigrams and a few shares is fitted by
minimising the non-negative unbiased risk

    prior * E_good[loss(+)] + max(0, E_unlabelled[loss(-)] - prior * E_good[loss(-)]),

in which unlabelled rows count as bad and the good ones among them are taken off again. Where that second
part falls below zero the fit has begun to learn single rows, and a step goes the other way.

The prior, the share of good text in the web text, is estimated: a short fit with a guessed prior on one half of
the rows ranks the other half, where the prior is the share of unlabelled rows over a threshold as a multiple of
the good ones over it, at the threshold whose confidence bound is the smallest; that guess is used for the next
such fit.

The fit uses bounded samples, at most ``POSITIVES`` and ``UNLABELLED`` rows in the order of a seeded hash, of which
each is read whole; scoring reads every text whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import pieces, settle, ship, texts

POSITIVES = 2048
UNLABELLED = 4096
BUCKETS = 2048
STEPS = 400
PRIOR_ROUNDS = 3
PRIOR_STEPS = 100
RATE = 0.02
RIDGE = 1e-4
#: Bytes whose trigrams are counted at a time; only what is held is bounded by it.
CHUNK = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_UPPER, _DIGIT, _LETTER, _HIGH = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_LETTER[97:123] = True
_HIGH[128:] = True
_MARK = ~(_BLANK | _UPPER | _DIGIT | _LETTER | _HIGH)
SHARES = 13


def features(text: bytes) -> np.ndarray:
    """Roots of the shares of hashed byte trigrams, and shares of kinds of bytes and of repetition; zeros for an empty text."""
    out = np.zeros(BUCKETS + SHARES, np.float32)
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return out
    counts = np.zeros(BUCKETS, np.int64)
    kinds = np.zeros(256, np.int64)
    for at in range(0, len(data), CHUNK):
        kinds += np.bincount(data[at : at + CHUNK], minlength=256)
        x = data[at : at + CHUNK + 2].astype(np.uint32)
        if len(x) > 2:
            code = (x[:-2] << 16 | x[1:-1] << 8 | x[2:]) * np.uint32(2654435761)
            counts += np.bincount(code >> np.uint32(21), minlength=BUCKETS)
    if total := counts.sum():
        out[:BUCKETS] = np.sqrt(counts / total)
    n = len(data)
    words = text.split()
    lines = text.split(b"\n")
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    upper, digit, mark, blank, high = (kinds[k].sum() / n for k in (_UPPER, _DIGIT, _MARK, _BLANK, _HIGH))
    many = len(words) or 1
    out[BUCKETS:] = [
        upper,
        digit,
        mark,
        blank,
        high,
        len(seen) / many,
        max(seen.values(), default=0) / many,
        len(set(lines)) / len(lines),
        sum(w[-1:] not in b".,;:!?" and _MARK[w[-1]] for w in words) / many,
        min(1.0, (n / many) / 32),
        min(1.0, math.log1p(many) / 10),
        kinds[[33, 124]].sum() / n,
        sum(map(bytes.__eq__, words, words[1:])) / many,
    ]
    return out


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    prior: float
    mean: np.ndarray
    scale: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(((x - self.mean) * self.scale) @ self.weights + self.bias)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(size: int, gradient, steps: int) -> tuple[np.ndarray, float]:
    """Adam from zero; ``gradient`` takes weights (the last one is the bias) and gives their slopes."""
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        g = gradient(w.astype(np.float32))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def risk(w: np.ndarray, good: np.ndarray, web: np.ndarray, prior: float) -> tuple[float, float, np.ndarray]:
    """Both parts of the risk under logistic loss, and the slopes of the step to take."""
    z, y = good @ w[:-1] + w[-1], web @ w[:-1] + w[-1]
    p, u = _sigmoid(z), _sigmoid(y)

    def slope(x: np.ndarray, by: np.ndarray) -> np.ndarray:
        return np.append(by @ x, by.sum()) / len(x)

    plus = prior * float(np.logaddexp(0, -z).mean())
    minus = float(np.logaddexp(0, y).mean()) - prior * float(np.logaddexp(0, z).mean())
    g_minus = slope(web, u) - prior * slope(good, p)
    g = prior * slope(good, p - 1) + g_minus if minus >= 0 else -g_minus
    return plus, max(0.0, minus), g


def class_prior(good: np.ndarray, web: np.ndarray, rounds: int = PRIOR_ROUNDS, steps: int = PRIOR_STEPS) -> float:
    """Share of rows like ``good`` among ``web``, at least 0.01 and at most 0.99.

    A short fit on every second row, with the prior found so far (first 0.5), ranks the other rows.
    """
    (g1, g2), (u1, u2) = ((x[::2], x[1::2]) for x in (good, web))
    prior = 0.5
    if not len(g2) or not len(u2):
        return prior
    slack = sum(math.sqrt(math.log(40) / 2 / len(x)) for x in (g2, u2))
    for _ in range(rounds):
        w, _ = _descend(good.shape[1], lambda w, prior=prior: risk(w, g1, u1, prior)[2] + np.append(RIDGE * w[:-1], 0), steps)
        p, u = np.sort(g2 @ w), np.sort(u2 @ w)
        over_p, over_u = (1 - np.searchsorted(x, p) / len(x) for x in (p, u))
        at = np.argmin((over_u + slack) / over_p)
        prior = float(np.clip(over_u[at] / over_p[at], 0.01, 0.99))
    return prior


def fit(good: np.ndarray, web: np.ndarray, prior: float | None = None, steps: int = STEPS) -> Model | None:
    """A model from rows of features; none if either side is empty."""
    if not len(good) or not len(web):
        return None
    mean = web.mean(axis=0)
    scale = 1 / np.maximum(web.std(axis=0), 1e-2)
    scale[: web.shape[1] - SHARES] = 20.0
    mean, scale = mean.astype(np.float32), scale.astype(np.float32)
    good, web = ((x - mean) * scale for x in (good, web))
    prior = class_prior(good, web) if prior is None else prior
    w, bias = _descend(good.shape[1], lambda w: risk(w, good, web, prior)[2] + np.append(RIDGE * w[:-1], 0), steps)
    return Model(w, bias, prior, mean, scale)


def _features(docs: DataFrame, keep: str) -> DataFrame:
    """(keep, x): the features of every text as half-precision bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            x = [features(t).astype(np.float16).tobytes() for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("good"), pa.array(x)], ["good", "x"])

    return docs.select(F.col(keep).alias("good"), "text").mapInArrow(run, "good boolean, x binary")


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
    seed: int = 5,
) -> Model | None:
    """A model from ``docs`` (the training rows) and the good ones among them.

    A document is good if it has a label and all its labels are 1; labels of other ids teach nothing. Rows without an
    id are unlabelled. The samples are chosen by ids and hashes alone; texts are read for chosen rows only.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("at"), F.col(text_col).cast("string").alias("text"))
    good = labels.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(label_col).alias("low"), F.count(label_col).alias("n"))
    good = good.where("low = 1 AND n > 0 AND id IS NOT NULL").select("id")
    parts = []
    for name, pool, most in (("good", rows.join(good, "id", "left_semi"), positives), ("web", rows, unlabelled)):
        # The hash of the last row that the sample takes; equal rows have equal hashes and are one.
        last = pool.select("at").distinct().orderBy("at").limit(most).agg(F.max("at")).first()[0]
        if last is None:
            return None
        chosen = pool.where(F.col("at") <= last).dropDuplicates(["at"])
        parts.append(chosen.select(F.lit(name == "good").alias("good"), "text", "at"))
    chosen = settle(parts[0].union(parts[1]), "quality-sample").select("good", "text")
    found = _features(chosen, "good").orderBy("x").collect()
    good_x, web_x = ([np.frombuffer(r.x, np.float16) for r in found if r.good == side] for side in (True, False))
    del found
    return fit(np.array(good_x, np.float32), np.array(web_x, np.float32))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id and score (0 to 1, higher is better). Without a model every score is 0.5.

    A missing text is an empty one; both have the score of a text without any feature. The model is bounded by its
    number of buckets and is sent to the executors.
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            n = batch.num_rows
            found = np.full(n, 0.5)
            if held.value is not None:
                data = texts(batch.column("text"))
                for at in range(0, n, 256):
                    found[at : at + 256] = held.value.score(np.array([features(t) for t in data[at : at + 256]]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def held_out(id_col: str) -> Column:
    """Whether a document is kept from training: the checksum of its id divides by 5. A missing id is not kept."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
