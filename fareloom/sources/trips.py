"""Reading and writing trip tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom import schema as S
from fareloom.functions.exprs import nan_to_null

INT_MAX = 2**31 - 1
SHORT_MAX = 2**15 - 1


def normalise_missing(t: DataFrame) -> DataFrame:
    """One kind of missing value: NaN in any floating column becomes null."""
    floats = [f.name for f in t.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return t.withColumns({c: nan_to_null(c) for c in floats}) if floats else t


def read_trips(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    where: str | Column | None = None,
    columns: Iterable[str] | None = None,
    bad_cells: str | None = None,
) -> DataFrame:
    """Read Parquet or CSV trips, chosen by suffix (a folder counts as Parquet).

    CSV columns are found by their name in the header. A cell that is there but cannot be read as
    its type is an error; with ``bad_cells`` it is null, and an array column of that name lists
    the columns it happened in.

    ``where`` is applied to the stored columns, below the NaN clean-up, so it reaches the
    Parquet reader as a pushed filter and prunes partitions. A path that does not exist
    raises Spark's own error, which names it.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if all(p.rstrip("/").lower().endswith((".csv", ".csv.gz")) for p in paths):
        t = typed_cells(spark.read.option("header", True).csv(paths), schema or S.TRIP_SCHEMA, bad_cells)
    else:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        t = reader.parquet(*paths)
    if where is not None:
        t = t.where(where)
    if columns is not None:
        t = t.select(*columns)
    return normalise_missing(t)


def typed_cells(text: DataFrame, schema: T.StructType, bad_cells: str | None = None) -> DataFrame:
    """Text columns as the columns of ``schema``, by name; those that are absent are null."""
    names = {c.lower(): c for c in text.columns}

    def cell(f: T.StructField) -> tuple[Column, Column]:
        raw = F.col(f"`{names[f.name.lower()]}`") if f.name.lower() in names else F.lit(None).cast("string")
        value = F.trim(raw).try_cast(f.dataType)
        return value, raw.isNotNull() & (F.trim(raw) != "") & value.isNull()

    cells = {f.name: cell(f) for f in schema.fields}
    if bad_cells:
        failed = F.array_compact(F.array(*[F.when(bad, F.lit(c)) for c, (_, bad) in cells.items()]))
        return text.select(*[v.alias(c) for c, (v, _) in cells.items()], failed.alias(bad_cells))

    def strict(f: T.StructField) -> Column:
        value, bad = cells[f.name]
        return F.when(bad, F.raise_error(F.lit(f"a cell of {f.name} cannot be read as {f.dataType.simpleString()}")).cast(f.dataType)).otherwise(value)

    return text.select(*[strict(f).alias(f.name) for f in schema.fields])


def read_periods(spark: SparkSession, paths: dict[str, str | list[str]], **kw) -> DataFrame:
    """Several periods in one table, told apart by a ``period`` column."""
    return union_periods({name: read_trips(spark, p, **kw) for name, p in paths.items()})


def union_periods(parts: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, part in parts.items():
        part = part.withColumn("period", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def to_ts(t: DataFrame, cols: Iterable[str] = (S.PICKUP, S.DROPOFF)) -> DataFrame:
    """Text or zoned timestamps to zone-less timestamps; text that does not parse becomes null."""
    return t.withColumns({c: F.col(c).try_cast("timestamp_ntz") for c in cols})


def narrow_types(t: DataFrame) -> DataFrame:
    """Store 64-bit integer columns in the narrowest of 16, 32 or 64 bits that fits.

    One pass finds every range; only two scalars per column come back. Floating columns
    stay double, since narrowing them changes sums.
    """
    longs = [f.name for f in t.schema.fields if isinstance(f.dataType, T.LongType)]
    if not longs:
        return t
    bounds = t.agg(
        *[F.min(c).alias(f"lo_{i}") for i, c in enumerate(longs)],
        *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(longs)],
    ).first()
    casts = {}
    for i, c in enumerate(longs):
        lo, hi = bounds[f"lo_{i}"], bounds[f"hi_{i}"]
        if lo is None:
            continue
        if -SHORT_MAX - 1 < lo and hi < SHORT_MAX:
            casts[c] = F.col(c).cast("smallint")
        elif -INT_MAX - 1 < lo and hi < INT_MAX:
            casts[c] = F.col(c).cast("int")
    return t.withColumns(casts) if casts else t


def write_trips(
    t: DataFrame,
    path: str,
    mode: str = "overwrite",
    by_date: str | None = None,
) -> str:
    """Write Parquet; ``by_date`` partitions the files by the day of that timestamp."""
    if by_date is None:
        t.write.mode(mode).parquet(path)
        return path
    day = f"{by_date}_day"
    (
        t.withColumn(day, F.to_date(by_date))
        .write.mode(mode)
        .partitionBy(day)
        .parquet(path)
    )
    return path


def write_csv(t: DataFrame, path: str, mode: str = "overwrite") -> str:
    (
        t.write.mode(mode)
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )
    return path
