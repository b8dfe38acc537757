"""From raw documents to token ids: the training-data pipeline.

``STAGES`` are (name, function) pairs. Each function takes (spark, docs, sf_dir) and returns a table
that is written as Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``docs``. Null texts have no letters and go in the first stage; an empty table stays
empty through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm import bpe, exact_dedup, language_id, mixing, simhash
from fareloom.llm.common import read, settle
from fareloom.llm.queries import byte_pattern, tokenizer_file

#: Pieces that a worker of the last stage keeps; it runs in workers that hold what earlier stages learned.
REMEMBERED = 200_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those that two languages compress almost equally well."""
    return language_id.keep_identified(docs, language_id.learn(docs.where(~language_id.held_out("doc_id"))))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id.

    Three fingerprints of two-word shingles, of which one has to link. In random texts of 100 to 3,000 words with
    words replaced at random, one such fingerprint links 12 % of the pairs whose five-word similarity is 0.8, 44 % of those at
    0.9 and 75 % of those at 0.95; README has the figures for three.
    """
    return simhash.keep_one(docs, shingle=2, tables=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: a row per copy, none for what it leaves out."""
    mixed, _ = mixing.mix(docs, F.array("source"))
    copies = F.explode(F.array_repeat(F.lit(0), F.col("_fl_copies").cast("int")))
    return mixed.select(*docs.columns, copies.alias("_fl_copy")).drop("_fl_copy")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and ids of every document; decoding the ids gives back the text or fails."""
    ranks = tokenizer_file("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(docs.select("doc_id", "source", "text"), ranks, byte_pattern(), decoded="decoded", remembered=REMEMBERED)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    checked = F.when(same, F.col("ids")).otherwise(F.raise_error(F.lit("decoded ids differ from their text")).cast("array<int>"))
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), checked.alias("ids"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("byte_bpe", encode),
]

#: Compression, fingerprints and merges have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table, each stored before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
