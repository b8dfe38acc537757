"""Named queries over a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        return f

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles, whose last bits depend on the order of a distributed sum."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.select(*[F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns])
