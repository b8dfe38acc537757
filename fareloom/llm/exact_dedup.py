"""Exact duplicates by a persistent digest index.

The index is a Parquet table bucketed and sorted by the SHA-256 digest of the normalised
text. A batch of documents is reduced to one row per digest before it meets the index, so
a text that fills a third of the batch is one row there. A sort-merge anti-join against the
index, which needs no shuffle on the index side, finds the new digests; they are appended.

Two texts are equal if they are identical after every run of white space is replaced by one
space. A missing text counts as empty. Of equal texts in one batch the row with the
smallest id stays; a missing id comes last. A text that an earlier batch brought into the
index keeps that batch's row. Rows that agree in id and text are one row and its repeats:
``flags`` marks all of them as kept, ``keep_first`` returns one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm.common import given_id, ordered_id, settle
from fareloom.session import scratch_path

#: Only what differs from the normal form is matched: runs of two or more, or one that is not a blank.
UNEVEN_SPACE = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"


def normalised(text: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), UNEVEN_SPACE, " ")


def digest(text: str) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


class DigestIndex:
    """Digests seen so far, with the id of the row that stays for each.

    ``path`` must be a folder that every executor reaches. An index that exists there is
    opened again; ``buckets`` has to be the number it was made with.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, groups: DataFrame) -> None:
        """Add the digests of (digest, keep_id) that the index does not hold; a repeat adds nothing."""
        new = groups.select("digest", "keep_id").join(self.read().hint("merge"), "digest", "left_anti")
        new.repartition(self.buckets, "digest").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)


def flags(
    docs: DataFrame,
    index: DigestIndex | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int | None = None,
) -> DataFrame:
    """Per row of ``docs``: doc_id, digest, keep_id, group_size, kept; new digests enter ``index``.

    ``group_size`` counts the equal texts of this batch. Without an index, a fresh one in
    the shared folder is used. No rows in, no rows out.
    """
    spark = docs.sparkSession
    if index is None:
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        index = DigestIndex(spark, scratch_path(spark, "digest-index"), n)
    rows = settle(docs.select(ordered_id(id_col).alias("oid"), digest(text_col).alias("digest")), "digests")
    groups = settle(rows.groupBy("digest").agg(F.min("oid").alias("keep_id"), F.count("*").alias("group_size")), "digest-groups")
    index.append(groups)
    # Stored, so that the next join deals out both of its sides and can split a digest of many rows.
    stays = settle(groups.drop("keep_id").join(index.read().hint("merge"), "digest"), "digest-stays")
    found = rows.join(stays, "digest")
    return found.select(
        given_id("oid").alias("doc_id"),
        "digest",
        given_id("keep_id").alias("keep_id"),
        "group_size",
        (F.col("oid") == F.col("keep_id")).alias("kept"),
    )


def keep_first(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns; one of those that agree in id and text."""
    stay = (
        flags(docs, index, id_col, text_col)
        .where("kept")
        .select(ordered_id("doc_id").alias("_fl_id"), F.col("digest").alias("_fl_digest"))
        .distinct()
    )
    marked = docs.select("*", ordered_id(id_col).alias("_fl_id"), digest(text_col).alias("_fl_digest"))
    kept = marked.join(stay, ["_fl_id", "_fl_digest"], "left_semi")
    return kept.dropDuplicates(["_fl_id", "_fl_digest"]).select(*docs.columns)
