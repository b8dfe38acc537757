"""Derived trip features.

Each function adds columns to a trip table by projection only: no shuffle, no Python
per row. ``features_v1`` is the set the model is trained on, ``features_analysis`` the
wider set used for exploration.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom import schema as S
from fareloom.functions.exprs import clip, flag, minutes_between, ratio

DURATION = "trip_duration_minutes"


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def with_duration(t: DataFrame, pickup: str = S.PICKUP, dropoff: str = S.DROPOFF) -> DataFrame:
    return t.withColumn(DURATION, minutes_between(pickup, dropoff))


def time_of_day(hour: Column) -> Column:
    return (
        F.when(hour.between(6, 11), "morning")
        .when(hour.between(12, 16), "afternoon")
        .when(hour.between(17, 21), "evening")
        .otherwise("late_night")
    )


def features_temporal(
    t: DataFrame, pickup: str = S.PICKUP, dropoff: str = S.DROPOFF
) -> DataFrame:
    """Duration, calendar parts (Monday = 0) and time-of-day flags."""
    hour, dow = F.hour(pickup), F.weekday(pickup)
    return t.withColumns(
        {
            DURATION: minutes_between(pickup, dropoff),
            "pickup_hour": hour,
            "pickup_day": F.dayofmonth(pickup),
            "pickup_dayofweek": dow,
            "pickup_month": F.month(pickup),
            "is_weekend": flag(dow.isin(5, 6)),
            "is_rush_hour": flag(hour.between(7, 9) | hour.between(17, 19)),
            "is_night": flag((hour >= 22) | (hour <= 5)),
            "time_of_day": time_of_day(hour),
        }
    )


def features_cyclic(t: DataFrame, parts: dict[str, tuple[Column, int]] | None = None) -> DataFrame:
    """Sine and cosine of calendar parts, so that hour 23 lies next to hour 0."""
    parts = parts or {
        "hour": (F.hour(S.PICKUP), 24),
        "dayofweek": (F.weekday(S.PICKUP), 7),
        "day": (F.dayofmonth(S.PICKUP), 31),
    }
    out: dict[str, Column] = {}
    for name, (part, period) in parts.items():
        angle = part * F.lit(2 * math.pi / period)
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.cos(angle)
    return t.withColumns(out)


def tip_share(basis: str) -> Column:
    """Tip over ``fare`` or ``total`` as a plain ratio; null where undefined."""
    return ratio("tip_amount", {"fare": "fare_amount", "total": S.TARGET}[basis])


def features_financial(t: DataFrame) -> DataFrame:
    """Money ratios of the analysis set: per cent tip capped at 100, ratios zero-filled."""
    tip_pct = ratio(F.col("tip_amount"), F.col("fare_amount")) * 100.0
    charges = (
        F.col("fare_amount")
        + F.col("extra")
        + F.col("mta_tax")
        + F.col("improvement_surcharge")
        + _zero(F.col("congestion_surcharge"))
        + _zero(F.col("Airport_fee"))
        + _zero(F.col("cbd_congestion_fee"))
    )
    return t.withColumns(
        {
            "tip_percentage": clip(_zero(tip_pct), 0.0, 100.0),
            "fare_per_mile": _zero(ratio("fare_amount", "trip_distance")),
            "revenue_per_mile": _zero(ratio("total_amount", "trip_distance")),
            "total_charges": charges,
            "tip_ratio": clip(_zero(ratio("tip_amount", "total_amount")), 0.0, 1.0),
        }
    )


def speed_mph(distance: str = "trip_distance", minutes: str | Column = DURATION) -> Column:
    m = F.col(minutes) if isinstance(minutes, str) else minutes
    return ratio(F.col(distance), m / 60)


def features_efficiency(t: DataFrame, top_speed: float = 80.0) -> DataFrame:
    """Speed (null where no time passed, else limited), distance per minute, riders per mile."""
    if DURATION not in t.columns:
        t = with_duration(t)
    return t.withColumns(
        {
            "speed_mph": clip(speed_mph(), 0.0, top_speed),
            "distance_per_minute": _zero(ratio("trip_distance", DURATION)),
            "passengers_per_mile": _zero(ratio("passenger_count", "trip_distance")),
        }
    )


def features_location(t: DataFrame, pickup: str = "PULocationID", dropoff: str = "DOLocationID") -> DataFrame:
    return t.withColumn("same_pickup_dropoff", flag(F.col(pickup) == F.col(dropoff)))


def code_text(c: str) -> Column:
    """A numeric code as text, without the ``.0`` that a nullable column would show."""
    return F.coalesce(F.col(c).cast("bigint").cast("string"), F.lit("nan"))


def features_interaction(t: DataFrame, left: str = "VendorID", right: str = "payment_type") -> DataFrame:
    return t.withColumn(
        "vendor_payment_interaction", F.concat_ws("_", code_text(left), code_text(right))
    )


def negative_fare_category() -> Column:
    fare = F.col("fare_amount")
    return (
        F.when(fare >= 0, "normal")
        .when(F.col("trip_distance") == 0, "cancelled")
        .when(F.col("total_amount") < 0, "full_refund")
        .when(fare < -50, "large_refund")
        .when(fare > -10, "small_adjustment")
        .when(F.col("payment_type") == 0, "voided")
        .otherwise("partial_adjustment")
    )


def refund_amount() -> Column:
    fare = F.col("fare_amount")
    return F.when(fare < 0, -fare).otherwise(0.0)


def negative_fare_flags(t: DataFrame) -> DataFrame:
    """Refund, cancellation and adjustment indicators of negative fares."""
    fare = F.col("fare_amount")
    negative = fare < 0
    other = F.lit(False)
    for c in S.OTHER_CHARGES:
        other = other | F.coalesce(F.col(c) < 0, F.lit(False))
    return t.withColumns(
        {
            "has_negative_fare": flag(negative),
            "is_cancelled_ride": flag(negative & (F.col("trip_distance") == 0)),
            "is_full_refund": flag(negative & (F.col("total_amount") < 0)),
            "is_partial_adjustment": flag(negative & (F.col("total_amount") >= 0)),
            "is_large_refund": flag(fare < -50),
            "is_small_adjustment": flag(negative & (fare > -10)),
            "is_voided_trip": flag(negative & (F.col("payment_type") == 0)),
            "has_multiple_negative_charges": flag(negative & other),
            "negative_fare_category": negative_fare_category(),
            "abs_negative_fare": refund_amount(),
            "refund_amount": refund_amount(),
        }
    )


def fill_missing(t: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Zero for missing numbers, ``'0'`` for missing text; timestamps are left alone."""
    out = {}
    for f in t.schema.fields:
        if f.name in keep:
            continue
        if isinstance(f.dataType, T.StringType):
            out[f.name] = F.coalesce(F.col(f.name), F.lit("0"))
        elif isinstance(f.dataType, T.NumericType):
            out[f.name] = F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType))
    return t.withColumns(out)


def features_v1(t: DataFrame, basis: str = "fare", keep: tuple[str, ...] = (S.TARGET,)) -> DataFrame:
    """The feature set of the trained model.

    ``basis='fare'`` never looks at the target and is the same at training and scoring
    time. ``basis='total'`` reproduces the older training form, which leaks the target
    through ``tip_percentage``, ``revenue_per_mile`` and ``has_negative_fare``.
    The rush-hour, night and refund columns of this set are constants by definition.
    """
    money = {"fare": "fare_amount", "total": S.TARGET}[basis]
    hour, dow = F.hour(S.PICKUP), F.weekday(S.PICKUP)
    out = t.withColumns(
        {
            DURATION: minutes_between(S.PICKUP, S.DROPOFF),
            "pickup_hour": hour,
            "pickup_dayofweek": dow,
            "pickup_month": F.month(S.PICKUP),
            "is_weekend": flag(dow.isin(5, 6)),
            "fare_per_mile": ratio("fare_amount", "trip_distance"),
            "revenue_per_mile": ratio(money, "trip_distance"),
            "tip_percentage": tip_share(basis),
            "is_rush_hour": F.lit(0),
            "is_night": F.lit(0),
            "refund_amount": F.lit(0),
            "has_negative_fare": flag(F.col(money) < 0),
            "is_full_refund": F.lit(0),
            "time_of_day": F.lit("unknown"),
            "negative_fare_category": F.lit("none"),
        }
    )
    out = out.withColumn("speed_mph", speed_mph())
    out = features_cyclic(out, {"hour": (hour, 24), "dayofweek": (dow, 7)})
    out = features_interaction(out)
    return fill_missing(out, keep=keep)


def features_analysis(t: DataFrame) -> DataFrame:
    """The full exploration set: every derived column, missing values left in place.

    Frequency columns need a fit over the table; see ``operators.encode``.
    """
    for step in (
        features_temporal,
        features_cyclic,
        features_location,
        features_financial,
        features_efficiency,
        features_interaction,
        negative_fare_flags,
    ):
        t = step(t)
    return t


def zero_flags(t: DataFrame, cols: tuple[str, ...] = tuple(S.ZERO_CHECKED)) -> DataFrame:
    """``{c}_is_zero`` = 1 where a quantity that should be positive is not."""
    return t.withColumns({f"{c}_is_zero": flag(F.col(c) <= 0) for c in cols if c in t.columns})


def log_target(t: DataFrame, target: str = S.TARGET, name: str = "log_target") -> DataFrame:
    """``log1p`` of a non-negative target and its inverse, null where undefined."""
    y = F.col(target)
    logged = F.when(y > -1, F.log1p(y))
    return t.withColumns({name: logged, f"{name}_back": F.expm1(logged)})


def tip_suggestions(
    t: DataFrame, fare: str, rates: tuple[int, ...] = (15, 20, 25), ids: tuple[str, ...] = ()
) -> DataFrame:
    """One row per trip and tip rate: tip, total, and the per-mile price of the fare."""
    options = F.array(*[F.lit(r) for r in rates])
    amount = F.col(fare)
    return t.select(
        *ids,
        amount.alias("predicted_fare"),
        F.when(F.col("trip_distance") > 0, ratio(amount, "trip_distance"))
        .otherwise(0.0)
        .alias("fare_per_mile"),
        speed_mph(minutes=minutes_between(S.PICKUP, S.DROPOFF)).alias("average_speed"),
        F.explode(options).alias("tip_rate"),
    ).withColumns(
        {
            "tip": F.col("predicted_fare") * (F.col("tip_rate") / 100.0),
            "total_with_tip": F.col("predicted_fare") * (1 + F.col("tip_rate") / 100.0),
        }
    )
