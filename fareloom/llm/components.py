"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import settle


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first())


def components(links: DataFrame) -> DataFrame:
    """Node and root (the smallest node of its component) for every node of (a, b) links.

    Large-star and small-star steps in turn: each links the neighbours of a node to the
    smallest of them, so the links become stars in about log(diameter) rounds. Every round is
    written to the shared folder. The minimum per node is combined before the shuffle, so a
    node with very many links is no large group, and no component meets in one task.
    Links of a node to itself are ignored; the table may be empty.
    """
    small, large = F.least("a", "b"), F.greatest("a", "b")
    links = settle(links.where("a <> b").select(small.alias("a"), large.alias("b")).distinct(), "links")
    before = None
    while (now := _state(links)) != before and now[0]:
        before = now
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        stars = both.join(least, "a").where("b > a and b <> m").select(F.col("m").alias("a"), "b").distinct()
        least = stars.groupBy("b").agg(F.min("a").alias("m"))
        near = stars.join(least, "b").where("a <> m").select("m", F.col("a").alias("b"))
        links = settle(near.union(least.select("m", "b")).toDF("a", "b").distinct(), "links")
    roots = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.union(links.select("a", "a").distinct())
