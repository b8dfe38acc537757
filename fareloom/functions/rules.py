"""Validation rules of fare requests.

A rule set is data: rule name to the condition a valid request meets. A missing value
breaks the rule that needs it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: four-digit year, one or two digits elsewhere, one space, nothing more.
TIME_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"


def parsed_time(c: str) -> Column:
    """Zone-less time, or null where the text has another form or is no real date.

    Parsing straight to a zone-less type keeps hours that a clock change skips.
    """
    text = F.col(c)
    return F.when(text.rlike(TIME_PATTERN), text.try_cast("timestamp_ntz"))


def is_number(c: str) -> Column:
    """Neither NaN, which Spark orders above infinity, nor infinite; null if missing."""
    return F.abs(F.col(c).cast("double")) < float("inf")


def request_rules() -> dict[str, Column]:
    return {
        "pickup_datetime": parsed_time("pickup_datetime").isNotNull(),
        "dropoff_datetime": parsed_time("dropoff_datetime").isNotNull(),
        "trip_distance": is_number("trip_distance"),
        "passenger_count": F.col("passenger_count").between(0, 4),
        "VendorID": F.col("VendorID").between(1, 2),
        "RatecodeID": F.col("RatecodeID").between(1, 6),
        "store_and_fwd_flag": F.upper("store_and_fwd_flag").isin("Y", "N"),
        "payment_type": F.col("payment_type").between(1, 6),
        "fare_amount": is_number("fare_amount"),
        "tip_amount": is_number("tip_amount") & (F.col("tip_amount") >= 0),
        "tolls_amount": is_number("tolls_amount") & (F.col("tolls_amount") >= 0),
    }


def strict_rules() -> dict[str, Column]:
    """What the request form itself would not let through."""
    return {
        **request_rules(),
        "passenger_count": F.col("passenger_count").between(1, 4),
        "trip_distance": F.col("trip_distance").between(0.1, 100.0),
        "trip_order": parsed_time("dropoff_datetime") > parsed_time("pickup_datetime"),
    }


def with_violations(r: DataFrame, rules: dict[str, Column], name: str = "violations") -> DataFrame:
    """Add the names of the broken rules, in rule order; empty for a valid request."""
    # Joined short arrays are compiled; ``array_compact`` is not, nor is anything inside it.
    none = F.array().cast(T.ArrayType(T.StringType(), False))
    broken = [F.when(ok, none).otherwise(F.array(F.lit(rule))) for rule, ok in rules.items()]
    if "_corrupt_record" in r.columns:
        broken.append(F.when(F.col("_corrupt_record").isNull(), none).otherwise(F.array(F.lit("json"))))
    return r.withColumn(name, F.concat(*broken) if broken else none)


def validate_requests(r: DataFrame, strict: bool = False) -> DataFrame:
    """Every request with its broken rules and the flag in upper case."""
    checked = with_violations(r, strict_rules() if strict else request_rules())
    return checked.withColumns(
        {
            "store_and_fwd_flag": F.upper("store_and_fwd_flag"),
            "is_valid": F.size("violations") == 0,
        }
    )


def accepted(r: DataFrame) -> DataFrame:
    return r.where("is_valid").drop("violations", "is_valid")


def rejected(r: DataFrame) -> DataFrame:
    return r.where("not is_valid")
