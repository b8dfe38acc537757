"""Language identification by compression with one zstandard dictionary per language.

A language's dictionary is raw text of documents labelled with it. A text is cut into pieces,
each is compressed with every dictionary, and the language with the smallest total wins. Pieces
are short, so the dictionary helps from the first to the last. Texts are compared in lower case
with everything but letters as one blank, so that shouting and junk do not hide the language.

The dictionaries come from a bounded sample: at most ``documents`` (128) labelled documents per
language, in the order of a seeded hash, at most ``sample_bytes`` (1,700) of each. Labels are
taken to be a fixed, short list. Everything else reads every text whole.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import pieces, ship, strings

DOCUMENTS = 128
SAMPLE_BYTES = 1700
PIECE = 1024
LEVEL = 6
#: Before every piece. It compresses to nothing, but with it even a few words make a block that can gain.
LEAD = bytes(64)
UNKNOWN = "und"
#: A text is rejected if the second language needs less than this share of bytes more.
MIN_MARGIN = 0.002
#: Bits of difference that count as one step of the score.
SOFTNESS = 16
#: Numerals such as halves, circled and Roman ones count as word characters but are no letters.
_NUMERALS = {c: " " for c in map(chr, range(1 << 17)) if unicodedata.category(c) in ("No", "Nl")}
_BLANKED = str.maketrans(_NUMERALS)
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def plain(text: str) -> bytes:
    low = text.lower()
    if not low.isascii() and not _NUMERALS.keys().isdisjoint(low):
        low = low.translate(_BLANKED)
    return _NOT_LETTERS.sub(" ", low).strip().encode("utf-8", "replace")


def held_out(id_col: str) -> Column:
    """Whether a document is kept from training: the checksum of its id leaves 2 of 4. A missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    documents: int = DOCUMENTS,
    sample_bytes: int = SAMPLE_BYTES,
    seed: int = 11,
) -> dict[str, bytes]:
    """A dictionary per label among ``docs`` (the training rows); rows without text or label teach nothing.

    The sample is chosen from hashes alone: the window's limit on row numbers is applied before its
    shuffle, so each task sends at most ``documents`` rows per language. Repeated rows count once.
    """
    rows = docs.select(
        F.col(lang_col).cast("string").alias("lang"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("at"),
        F.col(text_col).cast("string").alias("text"),
    ).where("lang is not null and text is not null")
    order = F.row_number().over(Window.partitionBy("lang").orderBy("at"))
    chosen = rows.select("lang", "at").withColumn("n", order).where(F.col("n") <= documents)
    last = {lang: at for lang, at in chosen.groupBy("lang").agg(F.max("at")).collect()}
    if not last:
        return {}
    wanted = F.lit(False)
    for lang, at in last.items():
        wanted = wanted | ((F.col("lang") == lang) & (F.col("at") <= at))
    head = F.substring("text", 1, 4 * sample_bytes).alias("head")
    sample = rows.where(wanted).select("lang", "at", head).dropDuplicates(["lang", "at"])
    out: dict[str, list[bytes]] = {}
    for lang, _, text in sorted(tuple(r) for r in sample.collect()):
        out.setdefault(lang, []).append(plain(text)[:sample_bytes])
    return {lang: b" ".join(parts[:documents]) for lang, parts in out.items()}


class Classifier:
    def __init__(self, model: dict[str, bytes]):
        self.languages = sorted(model)
        # With a window of up to 14 bits every call searches the whole dictionary and nothing of earlier calls.
        usual = {"compression_level": LEVEL, "window_log": 14}
        finer = {**usual, "min_match": 3, "strategy": zstandard.STRATEGY_BTOPT}
        self.compressors, self.finer = ([self._compressor(model[x], **how) for x in self.languages] for how in (usual, finer))

    @staticmethod
    def _compressor(dictionary: bytes, compression_level: int, **how: int) -> zstandard.ZstdCompressor:
        settings = zstandard.ZstdCompressionParameters.from_level(
            compression_level, write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS, **how
        )
        # Fewer than 8 bytes are no dictionary.
        data = zstandard.ZstdCompressionDict(dictionary.ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(dict_data=data, compression_params=settings)

    def __call__(self, text: str) -> tuple[str, float, float]:
        """Language, score and margin; ``und``, 0 and 0 if there is no letter."""
        data = plain(text)
        if not data or not self.languages:
            return UNKNOWN, 0.0, 0.0
        cut = [LEAD + data[i : i + PIECE] for i in range(0, len(data), PIECE)]
        size = [sum(len(c.compress(p)) for p in cut) for c in self.compressors]
        if size.count(min(size)) > 1:
            size = [sum(len(c.compress(p)) for p in cut) for c in self.finer]
        best = min(size)
        score = 1 / sum(math.exp2(-8 * min(n - best, 4096) / SOFTNESS) for n in size)
        second = sorted(size)[1] if len(size) > 1 else math.inf
        return self.languages[size.index(best)], score, min(1.0, (second - best) / best)


def classify(docs: DataFrame, model: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, lang_pred, score, margin, rejected.

    A missing text, and one without a letter, is ``und`` with score 0 and is rejected; so is a
    text whose margin is narrower than ``MIN_MARGIN``. Equal sizes are measured again with finer
    settings; what is equal then goes to the first language by name.
    The model is bounded by its sample and is sent to the executors.
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = Classifier(held.value)
        for batch in pieces(batches, "text"):
            lang, score, margin = zip(*map(ask, strings(batch.column("text"))))
            rejected = [x == UNKNOWN or m < MIN_MARGIN for x, m in zip(lang, margin)]
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(lang), pa.array(score), pa.array(margin), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "lang_pred", "score", "margin", "rejected"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, lang_pred string, score double, margin double, rejected boolean")


def keep_identified(docs: DataFrame, model: dict[str, bytes], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, with their columns, in one pass."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = Classifier(held.value)
        for batch in pieces(batches, text_col):
            found = [ask(t) for t in strings(batch.column(place))]
            yield batch.filter(pa.array([x != UNKNOWN and m >= MIN_MARGIN for x, _, m in found]))

    return docs.mapInArrow(run, docs.schema)
