"""Column names, types and fixed value lists of trip tables and fare requests."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
TARGET = "total_amount"
PREDICTED = "predicted_total_amount"

TRIP_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField(PICKUP, T.TimestampNTZType()),
        T.StructField(DROPOFF, T.TimestampNTZType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("Airport_fee", T.DoubleType()),
        T.StructField("cbd_congestion_fee", T.DoubleType()),
    ]
)

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("pickup_datetime", T.StringType()),
        T.StructField("dropoff_datetime", T.StringType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("RatecodeID", T.IntegerType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
    ]
)

# Columns a batch must carry before it can be scored.
REQUIRED_COLUMNS = [
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "trip_distance",
    "passenger_count",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "VendorID",
    "payment_type",
    "RatecodeID",
    "store_and_fwd_flag",
]

# The columns whose values go missing together.
MISSING_TOGETHER = [
    "passenger_count",
    "RatecodeID",
    "store_and_fwd_flag",
    "congestion_surcharge",
    "Airport_fee",
]

# Columns that should never be negative.
NON_NEGATIVE = [
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "Airport_fee",
    "cbd_congestion_fee",
]

# Charges that may be negative beside a negative fare.
OTHER_CHARGES = [
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "Airport_fee",
    "cbd_congestion_fee",
]

# Columns of the numeric summary, outlier and correlation reports.
KEY_NUMERIC = [
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
]
OUTLIER_COLUMNS = [
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "passenger_count",
]
CORRELATION_COLUMNS = [
    "trip_distance",
    "trip_duration_minutes",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "passenger_count",
]
COMPARED_COLUMNS = [
    "trip_distance",
    "fare_amount",
    "total_amount",
    "trip_duration_minutes",
]
ZERO_CHECKED = ["trip_distance", "trip_duration_minutes", "fare_amount"]

# Columns the trained model reads (22 numeric, 7 categorical).
MODEL_NUMERIC = [
    "trip_distance",
    "trip_duration_minutes",
    "passenger_count",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "fare_per_mile",
    "tip_percentage",
    "speed_mph",
    "pickup_hour",
    "pickup_dayofweek",
    "pickup_month",
    "is_weekend",
    "is_rush_hour",
    "is_night",
    "hour_sin",
    "hour_cos",
    "dayofweek_sin",
    "dayofweek_cos",
    "refund_amount",
    "has_negative_fare",
    "is_full_refund",
]
MODEL_CATEGORICAL = [
    "VendorID",
    "payment_type",
    "RatecodeID",
    "store_and_fwd_flag",
    "time_of_day",
    "negative_fare_category",
    "vendor_payment_interaction",
]

# The analysis set trains on one numeric column more.
ANALYSIS_MODEL_NUMERIC = (
    MODEL_NUMERIC[:7] + ["revenue_per_mile"] + MODEL_NUMERIC[7:]
)

# Columns of the feature-usefulness analysis.
ANALYSIS_COLUMNS = [
    "trip_distance",
    "fare_amount",
    "total_amount",
    "tip_amount",
    "trip_duration_minutes",
    "passenger_count",
    "tolls_amount",
    "pickup_hour",
    "pickup_dayofweek",
    "pickup_month",
    "is_weekend",
    "is_rush_hour",
    "is_night",
    "hour_sin",
    "hour_cos",
    "dayofweek_sin",
    "dayofweek_cos",
    "PULocationID",
    "DOLocationID",
    "PULocationID_freq",
    "DOLocationID_freq",
    "same_pickup_dropoff",
    "tip_percentage",
    "fare_per_mile",
    "total_charges",
    "tip_ratio",
    "revenue_per_mile",
    "refund_amount",
    "speed_mph",
    "distance_per_minute",
    "passengers_per_mile",
    "has_negative_fare",
    "is_cancelled_ride",
    "is_full_refund",
    "is_partial_adjustment",
    "is_large_refund",
    "is_small_adjustment",
    "is_voided_trip",
    "has_multiple_negative_charges",
]

# Grouping of the analysis columns in the feature profile.
FEATURE_GROUPS = {
    "core": [
        "trip_distance",
        "trip_duration_minutes",
        "passenger_count",
        "fare_amount",
        "total_amount",
        "tip_amount",
        "tolls_amount",
    ],
    "temporal": [
        "pickup_hour",
        "pickup_dayofweek",
        "pickup_month",
        "is_weekend",
        "is_rush_hour",
        "is_night",
        "hour_sin",
        "hour_cos",
        "dayofweek_sin",
        "dayofweek_cos",
    ],
    "location": [
        "PULocationID",
        "DOLocationID",
        "PULocationID_freq",
        "DOLocationID_freq",
        "same_pickup_dropoff",
    ],
    "financial": [
        "tip_percentage",
        "fare_per_mile",
        "total_charges",
        "tip_ratio",
        "revenue_per_mile",
    ],
    "efficiency": ["speed_mph", "distance_per_minute", "passengers_per_mile"],
    "negative_fare": [
        "has_negative_fare",
        "is_cancelled_ride",
        "is_full_refund",
        "is_partial_adjustment",
        "is_voided_trip",
        "refund_amount",
    ],
    "categorical": [
        "VendorID",
        "payment_type",
        "RatecodeID",
        "store_and_fwd_flag",
        "time_of_day",
        "negative_fare_category",
    ],
}

# Names behind the coded columns.
DAY_NAMES = [
    "Monday",
    "Tuesday",
    "Wednesday",
    "Thursday",
    "Friday",
    "Saturday",
    "Sunday",
]
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided",
}
RATE_LABELS = {
    1: "Standard",
    2: "JFK",
    3: "Newark",
    4: "Nassau/Westchester",
    5: "Negotiated",
    6: "Group",
}


class MissingColumns(ValueError):
    """A table lacks columns an operator needs."""


def missing_columns(t: DataFrame, needed: Iterable[str]) -> list[str]:
    """Names in ``needed`` that ``t`` does not have, in the order given."""
    have = set(t.columns)
    return [c for c in needed if c not in have]


def require_columns(t: DataFrame, needed: Iterable[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Return ``t`` unchanged, or raise when a needed column is absent."""
    absent = missing_columns(t, needed)
    if absent:
        raise MissingColumns(f"missing required columns: {', '.join(absent)}")
    return t
