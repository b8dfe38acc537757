"""Fare requests as JSON records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom import schema as S

CORRUPT = "_corrupt_record"

# What a request that leaves a field out means.
REQUEST_DEFAULTS = {
    "passenger_count": 1,
    "VendorID": 1,
    "RatecodeID": 1,
    "store_and_fwd_flag": "N",
    "payment_type": 1,
    "fare_amount": 0.0,
    "tip_amount": 0.0,
    "tolls_amount": 0.0,
}

# Charges assumed for every requested trip.
CHARGE_DEFAULTS = {
    "extra": 0.0,
    "mta_tax": 0.5,
    "improvement_surcharge": 0.3,
    "congestion_surcharge": 2.5,
    "Airport_fee": 0.0,
}


def read_requests(
    spark: SparkSession, path: str, stream: bool = False, extra: tuple[T.StructField, ...] = (), files_per_batch: int = 1000
) -> DataFrame:
    """One request per JSON line; a line that is no JSON object is kept in ``_corrupt_record``.

    A stream takes up to ``files_per_batch`` files at a time, so that a backlog is not one huge batch.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch) if stream else spark.read
    lines = reader.text(path).where(F.trim("value") != "")
    return lines.select(*request_fields(F.col("value"), extra))


def parse_requests(t: DataFrame, body: str | Column = "body") -> DataFrame:
    """The same for JSON text that already sits in a column."""
    text = F.col(body) if isinstance(body, str) else body
    return t.select("*", *request_fields(text))


def request_fields(text: Column, extra: tuple[T.StructField, ...] = ()) -> list[Column]:
    """The fields of a request in JSON.

    A field that is left out has its default. One that is there but null, or of a type that does not fit, is
    missing, which breaks its rule. All fields are read in one cast, which is null unless the text is an object;
    a second one, to values of no type, tells the fields left out. A path for each field would be dearer, most of all
    one that leads nowhere.
    """
    body = F.try_parse_json(text)
    fields = [*extra, *S.REQUEST_SCHEMA.fields]
    record = F.try_variant_get(body, "$", struct_type({f.name: f.dataType.simpleString() for f in fields}))
    given = F.try_variant_get(body, "$", struct_type(dict.fromkeys(REQUEST_DEFAULTS, "variant")))
    out = []
    for f in fields:
        value = record.getField(f.name)
        if f.name in REQUEST_DEFAULTS:
            left_out = record.isNotNull() & given.getField(f.name).isNull()
            value = F.when(left_out, F.lit(REQUEST_DEFAULTS[f.name]).cast(f.dataType)).otherwise(value)
        out.append(value.alias(f.name))
    return [*out, F.when(record.isNull(), text).alias(CORRUPT)]


def struct_type(fields: dict[str, str]) -> str:
    """The type of a record with these fields, under any names."""
    quoted = {name.replace("`", "``"): kind for name, kind in fields.items()}
    return f"struct<{', '.join(f'`{name}`: {kind}' for name, kind in quoted.items())}>"


def with_request_defaults(r: DataFrame) -> DataFrame:
    """Defaults for a table, in which a value that was left out and a missing one are the same."""
    return r.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in REQUEST_DEFAULTS.items()})


def time_text(c: str) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` of a zone-less timestamp, whatever the session zone is."""
    return F.substring(F.col(c).cast("string"), 1, 19)


def requests_from_trips(t: DataFrame, ids: tuple[str, ...] = ("trip_id",)) -> DataFrame:
    """Project recorded trips to what a client would have sent."""
    return t.select(
        *ids,
        time_text(S.PICKUP).alias("pickup_datetime"),
        time_text(S.DROPOFF).alias("dropoff_datetime"),
        "trip_distance",
        F.coalesce(F.col("passenger_count"), F.lit(1)).cast("int").alias("passenger_count"),
        "VendorID",
        F.coalesce(F.col("RatecodeID"), F.lit(1)).cast("int").alias("RatecodeID"),
        F.coalesce(F.col("store_and_fwd_flag"), F.lit("N")).alias("store_and_fwd_flag"),
        F.col("payment_type").cast("int").alias("payment_type"),
        "fare_amount",
        "tip_amount",
        "tolls_amount",
    )


def write_requests(r: DataFrame, path: str) -> str:
    r.write.mode("overwrite").json(path)
    return path


def rows_from_literals(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A table from values given in code, such as one request or a list of code labels."""
    return spark.createDataFrame(rows, schema)
