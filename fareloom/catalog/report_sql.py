"""Independent SQL for the report queries, run by another engine to check values."""

from __future__ import annotations

from fareloom import schema as S
from fareloom.sources.tables import TRIP_VIEW

TRIPS = "WITH trips AS (" + TRIP_VIEW.format(lineitem="lineitem", orders="orders") + ")"
COLS = S.TRIP_SCHEMA.fieldNames()
DUR = "((epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime)) / 6e7)"
SPEED = f"(trip_distance / nullif({DUR} / 60, 0))"
MISSING = "(" + " OR ".join(f"{c} IS NULL" for c in S.MISSING_TOGETHER) + ")"
ALL_MISSING = "(" + " AND ".join(f"{c} IS NULL" for c in S.MISSING_TOGETHER) + ")"
HOUR = "CAST(hour(tpep_pickup_datetime) AS INT)"
DOW = "CAST(isodow(tpep_pickup_datetime) - 1 AS INT)"
DAY = "CAST(day(tpep_pickup_datetime) AS INT)"


def pct(cond: str, of: str = "count(*)", digits: int = 6) -> str:
    return f"round(100.0 * count(*) FILTER (WHERE {cond}) / nullif({of}, 0), {digits})"


def n_if(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def union(parts) -> str:
    return " UNION ALL ".join(parts)


# Every analysis column, written once for the feature reports.
NEG = "fare_amount < 0"
ANY_OTHER = " OR ".join(f"coalesce({c} < 0, false)" for c in S.OTHER_CHARGES)
ANALYSIS_CTE = f"""
, filled AS (
  SELECT * REPLACE (coalesce(passenger_count, (
      SELECT passenger_count FROM (
        SELECT passenger_count, count(*) AS n FROM trips WHERE passenger_count IS NOT NULL GROUP BY 1
      ) ORDER BY n DESC, passenger_count LIMIT 1)) AS passenger_count)
  FROM trips
), analysis AS (
  SELECT f.*,
    {DUR} AS trip_duration_minutes, {HOUR} AS pickup_hour, {DOW} AS pickup_dayofweek,
    CAST(month(tpep_pickup_datetime) AS INT) AS pickup_month, {DAY} AS pickup_day,
    CASE WHEN {DOW} >= 5 THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN {HOUR} IN (7, 8, 9, 17, 18, 19) THEN 1 ELSE 0 END AS is_rush_hour,
    CASE WHEN {HOUR} >= 22 OR {HOUR} <= 5 THEN 1 ELSE 0 END AS is_night,
    CASE WHEN {HOUR} < 6 OR {HOUR} > 21 THEN 'late_night' WHEN {HOUR} < 12 THEN 'morning'
         WHEN {HOUR} < 17 THEN 'afternoon' ELSE 'evening' END AS time_of_day,
    sin({HOUR} * (2 * pi() / 24)) AS hour_sin, cos({HOUR} * (2 * pi() / 24)) AS hour_cos,
    sin({DOW} * (2 * pi() / 7)) AS dayofweek_sin, cos({DOW} * (2 * pi() / 7)) AS dayofweek_cos,
    sin({DAY} * (2 * pi() / 31)) AS day_sin, cos({DAY} * (2 * pi() / 31)) AS day_cos,
    CASE WHEN PULocationID = DOLocationID THEN 1 ELSE 0 END AS same_pickup_dropoff,
    least(greatest(coalesce(tip_amount / nullif(fare_amount, 0) * 100, 0), 0), 100) AS tip_percentage,
    coalesce(fare_amount / nullif(trip_distance, 0), 0) AS fare_per_mile,
    coalesce(total_amount / nullif(trip_distance, 0), 0) AS revenue_per_mile,
    fare_amount + extra + mta_tax + improvement_surcharge + coalesce(congestion_surcharge, 0)
      + coalesce(Airport_fee, 0) + coalesce(cbd_congestion_fee, 0) AS total_charges,
    least(greatest(coalesce(tip_amount / nullif(total_amount, 0), 0), 0), 1) AS tip_ratio,
    CASE WHEN {SPEED} IS NOT NULL THEN greatest(least({SPEED}, 80), 0) END AS speed_mph,
    coalesce(trip_distance / nullif({DUR}, 0), 0) AS distance_per_minute,
    coalesce(passenger_count / nullif(trip_distance, 0), 0) AS passengers_per_mile,
    concat(VendorID, '_', payment_type) AS vendor_payment_interaction,
    CAST({NEG} AS INT) AS has_negative_fare,
    CAST({NEG} AND trip_distance = 0 AS INT) AS is_cancelled_ride,
    CAST({NEG} AND total_amount < 0 AS INT) AS is_full_refund,
    CAST({NEG} AND total_amount >= 0 AS INT) AS is_partial_adjustment,
    CAST(fare_amount < -50 AS INT) AS is_large_refund,
    CAST({NEG} AND fare_amount > -10 AS INT) AS is_small_adjustment,
    CAST({NEG} AND payment_type = 0 AS INT) AS is_voided_trip,
    CAST({NEG} AND ({ANY_OTHER}) AS INT) AS has_multiple_negative_charges,
    CASE WHEN fare_amount >= 0 THEN 'normal' WHEN trip_distance = 0 THEN 'cancelled'
         WHEN total_amount < 0 THEN 'full_refund' WHEN fare_amount < -50 THEN 'large_refund'
         WHEN fare_amount > -10 THEN 'small_adjustment' WHEN payment_type = 0 THEN 'voided'
         ELSE 'partial_adjustment' END AS negative_fare_category,
    CASE WHEN {NEG} THEN abs(fare_amount) ELSE 0 END AS refund_amount,
    CASE WHEN {NEG} THEN abs(fare_amount) ELSE 0 END AS abs_negative_fare,
    pu.n AS PULocationID_freq, do_.n AS DOLocationID_freq
  FROM filled f
  LEFT JOIN (SELECT PULocationID AS k, count(*) AS n FROM trips GROUP BY 1) pu ON pu.k = f.PULocationID
  LEFT JOIN (SELECT DOLocationID AS k, count(*) AS n FROM trips GROUP BY 1) do_ ON do_.k = f.DOLocationID
)
"""
ANALYSIS = TRIPS + ANALYSIS_CTE
FLAGS = [
    "has_negative_fare",
    "is_cancelled_ride",
    "is_full_refund",
    "is_partial_adjustment",
    "is_large_refund",
    "is_small_adjustment",
    "is_voided_trip",
    "has_multiple_negative_charges",
]

SQL: dict[str, str] = {}

# -- sources --------------------------------------------------------------------------

SQL["scan_trips"] = f"{TRIPS} SELECT * FROM trips"

SQL["scan_trips_where"] = f"{TRIPS} SELECT * FROM trips WHERE trip_distance > 0"

SQL["scan_csv"] = f"""{TRIPS}
SELECT VendorID, payment_type, store_and_fwd_flag, count(*) AS trips,
  min(tpep_pickup_datetime) AS first_pickup, max(tpep_dropoff_datetime) AS last_dropoff,
  count(passenger_count) AS with_passengers, round(sum(total_amount), 6) AS revenue
FROM trips GROUP BY 1, 2, 3"""

SQL["coerce_ts"] = f"""{TRIPS}
SELECT trip_id, tpep_pickup_datetime,
  CASE WHEN payment_type <> 0 THEN tpep_dropoff_datetime END AS tpep_dropoff_datetime
FROM trips"""

SQL["sample_n"] = f"""{TRIPS}
SELECT trip_id, fare_amount FROM trips ORDER BY md5(concat('42|', trip_id)), trip_id LIMIT 2500"""

SQL["shuffle_order"] = f"""{TRIPS}
SELECT trip_id, row_number() OVER (ORDER BY md5(concat('47|', trip_id)), trip_id) AS position FROM trips"""

SQL["narrow_types"] = f"""{TRIPS}
, wide AS (
  SELECT payment_type,
    day(tpep_pickup_datetime) * 1440 + hour(tpep_pickup_datetime) * 60 + minute(tpep_pickup_datetime)
      AS minute_of_month,
    CAST(split_part(trip_id, '-', 1) AS BIGINT) * 1000000000 AS big_key,
    CAST(split_part(trip_id, '-', 1) AS BIGINT) + 40000 AS order_part
  FROM trips)
SELECT CAST(sum(payment_type) AS BIGINT) AS payment_type,
  CAST(sum(minute_of_month) AS BIGINT) AS minute_of_month,
  CAST(sum(big_key) AS BIGINT) AS big_key, CAST(sum(order_part) AS BIGINT) AS order_part,
""" + ", ".join(
    f"""CASE WHEN min({c}) > -32768 AND max({c}) < 32767 THEN 'smallint'
        WHEN min({c}) > -2147483648 AND max({c}) < 2147483647 THEN 'int' ELSE 'bigint' END AS {c}_type"""
    for c in ("payment_type", "minute_of_month", "big_key", "order_part")
) + " FROM wide"

SQL["two_period_union"] = f"""{TRIPS}
SELECT CASE WHEN year(tpep_pickup_datetime) < 1998 THEN 'early' ELSE 'late' END AS period,
  count(*) AS trips, min(tpep_pickup_datetime) AS first_pickup, max(tpep_pickup_datetime) AS last_pickup,
  round(avg(total_amount), 6) AS mean_total
FROM trips GROUP BY 1"""

SQL["request_parse"] = f"""{TRIPS}
SELECT CASE WHEN payment_type = 0 THEN 1 ELSE CAST(coalesce(passenger_count, 1) AS INT) END AS passenger_count,
  coalesce(store_and_fwd_flag, 'N') AS store_and_fwd_flag, VendorID,
  CAST(coalesce(RatecodeID, 1) AS INT) AS RatecodeID, count(*) AS requests,
  strftime(min(tpep_pickup_datetime), '%Y-%m-%d %H:%M:%S') AS first_pickup,
  round(sum(trip_distance), 6) AS miles, round(sum(fare_amount), 6) AS fares, CAST(0 AS BIGINT) AS corrupt
FROM trips GROUP BY 1, 2, 3, 4"""

SQL["literal_rows"] = f"""{TRIPS}
SELECT payment_type, CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge'
    WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided' ELSE 'not listed' END AS label,
  count(*) AS trips, round(sum(total_amount), 6) AS revenue
FROM trips GROUP BY 1, 2"""

# -- missing values and quality -------------------------------------------------------

SPARK_TYPES = {f.name: f.dataType.simpleString() for f in S.TRIP_SCHEMA.fields}
SQL["missing_profile"] = f"{TRIPS} SELECT * FROM (" + union(
    f"""SELECT '{c}' AS "column", '{SPARK_TYPES[c]}' AS type, count({c}) AS present,
        {n_if(c + " IS NULL")} AS missing, {pct(c + " IS NULL")} AS missing_pct FROM trips"""
    for c in COLS
) + ") WHERE missing > 0"

SQL["missing_totals"] = (
    f"{TRIPS} SELECT count(*) AS rows, "
    + " + ".join(n_if(f"{c} IS NULL") for c in COLS)
    + " AS missing_cells, "
    + pct(" OR ".join(f"{c} IS NULL" for c in COLS))
    + " AS rows_with_gaps_pct FROM trips"
)

SQL["missing_rows"] = f"""{TRIPS}
SELECT count(*) AS rows, {n_if(MISSING)} AS any_missing, {n_if(ALL_MISSING)} AS all_missing,
  {n_if(MISSING)} = {n_if(ALL_MISSING)} AS systematic, {pct(ALL_MISSING, n_if(MISSING))} AS all_of_any_pct
FROM trips"""

CODED_MISSING = f"payment_type = 0 AND {MISSING}"
SQL["missing_overlap"] = f"""{TRIPS}
SELECT count(*) AS rows, {n_if("payment_type = 0")} AS coded, {n_if(CODED_MISSING)} AS coded_missing,
  {pct("payment_type = 0")} AS coded_pct, {pct(CODED_MISSING, n_if("payment_type = 0"))} AS coded_missing_pct,
  CASE WHEN {n_if("payment_type = 0")} = {n_if(CODED_MISSING)} THEN 'all'
       WHEN {pct(CODED_MISSING, n_if("payment_type = 0"))} > 95 THEN 'almost all' ELSE 'some' END AS overlap
FROM trips"""

SQL["missing_verdict"] = f"""{TRIPS}
SELECT count(*) AS rows, {n_if(MISSING)} AS missing, {n_if("payment_type = 0")} AS coded,
  {pct(MISSING)} AS missing_pct, {pct("payment_type = 0")} AS coded_pct,
  CASE WHEN {n_if(MISSING)} = {n_if("payment_type = 0")} THEN 'MNAR' ELSE 'undecided' END AS mechanism
FROM trips"""

SQL["missing_by_hour"] = f"""{TRIPS}
SELECT {HOUR} AS pickup_hour, {n_if(MISSING)} AS missing_count, count(*) AS total_count,
  {pct(MISSING, digits=2)} AS pct_missing
FROM trips GROUP BY 1"""

DAY_NAME = "['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday']"
SQL["missing_by_dow"] = f"""{TRIPS}
SELECT {DOW} AS pickup_dayofweek, {n_if(MISSING)} AS missing_count, count(*) AS total_count,
  {pct(MISSING, digits=2)} AS pct_missing, {DAY_NAME}[{DOW} + 1] AS day
FROM trips GROUP BY {DOW}"""

SQL["crosstab_margins"] = f"""{TRIPS}
, keyed AS (SELECT CAST(payment_type AS VARCHAR) AS payment_type,
    CASE WHEN {MISSING} THEN 'true' ELSE 'false' END AS has_missing FROM trips)
, cells AS (
  SELECT payment_type, has_missing, count(*) AS n, false AS all_payment_type, false AS all_has_missing FROM keyed GROUP BY 1, 2
  UNION ALL SELECT payment_type, 'All', count(*), false, true FROM keyed GROUP BY 1
  UNION ALL SELECT 'All', has_missing, count(*), true, false FROM keyed GROUP BY 2
  UNION ALL SELECT 'All', 'All', count(*), true, true FROM keyed)
, totals AS (SELECT payment_type, n AS row_n, all_payment_type FROM cells WHERE all_has_missing)
SELECT payment_type, has_missing, n, all_payment_type, all_has_missing, round(100.0 * n / row_n, 6) AS row_pct
FROM cells JOIN totals USING (payment_type, all_payment_type)"""

SQL["negative_counts"] = f"{TRIPS} SELECT * FROM (" + union(
    f"""SELECT '{c}' AS "column", {n_if(c + " < 0")} AS negative, {pct(c + " < 0")} AS negative_pct FROM trips"""
    for c in S.NON_NEGATIVE
) + ") WHERE negative > 0"


def checks(label: str, conds: dict[str, str], source: str = "trips") -> str:
    return union(
        f"SELECT '{name}' AS {label}, {n_if(cond)} AS trips, {pct(cond)} AS pct FROM {source}"
        for name, cond in conds.items()
    )


SQL["anomaly_counts"] = f"{TRIPS} " + checks(
    "anomaly",
    {
        "zero_distance": "trip_distance = 0",
        "zero_passengers": "passenger_count = 0",
        "dropoff_before_pickup": "tpep_dropoff_datetime < tpep_pickup_datetime",
    },
)

SQL["quality_issues"] = f"{TRIPS} SELECT * FROM (" + checks(
    "issue",
    {
        "distance_not_positive": "trip_distance <= 0",
        "negative_fare": "fare_amount < 0",
        "negative_duration": f"{DUR} < 0",
        "very_long_trip": f"{DUR} > 300",
        "unrealistic_speed": f"{SPEED} > 80",
    },
) + ") WHERE trips > 0"

CELLS = f"{len(COLS)} * count(*)"
GAPS = " + ".join(n_if(f"{c} IS NULL") for c in COLS)
SQL["completeness"] = f"""{TRIPS}
SELECT {CELLS} AS total_cells, {GAPS} AS missing_cells, round(100.0 * ({GAPS}) / ({CELLS}), 6) AS missing_pct,
  {CELLS} - ({GAPS}) AS complete_cells, round(100.0 * ({CELLS} - ({GAPS})) / ({CELLS}), 6) AS complete_pct
FROM trips"""

SQL["target_filter"] = f"""{TRIPS}
SELECT count(*) AS rows, {n_if("total_amount >= 0")} AS kept, {n_if("total_amount < 0")} AS dropped,
  {pct("total_amount < 0")} AS dropped_pct FROM trips"""

NOTHING = "CAST(NULL AS DOUBLE)"
SQL["neg_fare_profile"] = f"{TRIPS}, sub AS (SELECT * FROM trips WHERE fare_amount < 0) " + union(
    [
        f"""SELECT 'payment_type' AS section, CAST(payment_type AS VARCHAR) AS item, count(*) AS n,
        round(100.0 * count(*) / (SELECT count(*) FROM sub), 6) AS pct, {NOTHING} AS amount
        FROM sub GROUP BY payment_type""",
        f"SELECT 'zero_distance', 'trip_distance', {n_if('trip_distance = 0')}, {pct('trip_distance = 0')}, {NOTHING} FROM sub",
        f"SELECT 'negative_total', 'total_amount', {n_if('total_amount < 0')}, {pct('total_amount < 0')}, {NOTHING} FROM sub",
    ]
    + [
        f"SELECT 'negative_charge', '{c}', {n_if(c + ' < 0')}, {pct(c + ' < 0')}, {NOTHING} FROM sub HAVING {n_if(c + ' < 0')} > 0"
        for c in S.OTHER_CHARGES
    ]
    + [
        f"SELECT 'magnitude', '{name}', CAST(NULL AS BIGINT), {NOTHING}, round({e}, 6) FROM sub"
        for name, e in (
            ("mean", "avg(fare_amount)"),
            ("median", "median(fare_amount)"),
            ("largest", "min(fare_amount)"),
            ("smallest", "max(fare_amount)"),
        )
    ]
)

SQL["neg_flag_summary"] = f"{ANALYSIS} " + checks(
    "flag", {"all_trips": "true", **{f: f"{f} = 1" for f in FLAGS}}, "analysis"
)

SQL["neg_category_breakdown"] = f"""{ANALYSIS}
SELECT negative_fare_category, count(*) AS n,
  round(100.0 * count(*) / (SELECT count(*) FROM trips WHERE fare_amount < 0), 6) AS pct
FROM analysis WHERE fare_amount < 0 GROUP BY 1"""

SQL["refund_stats"] = f"""{TRIPS}
SELECT count(*) AS refunds, round(avg(-fare_amount), 6) AS mean, round(median(-fare_amount), 6) AS median,
  round(min(-fare_amount), 6) AS min, round(max(-fare_amount), 6) AS max, round(sum(-fare_amount), 6) AS total
FROM trips WHERE fare_amount < 0"""

# -- profiling ------------------------------------------------------------------------

SQL["describe_numeric"] = f"{TRIPS} " + union(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25,
        round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75,
        round(max({c}), 6) AS max FROM trips"""
    for c in S.KEY_NUMERIC
)

SQL["describe_categorical"] = f"{TRIPS} " + union(
    f"""(SELECT '{c}' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
        arg_min(v, (-n, v)) AS top, max(n) AS freq
        FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM trips WHERE {c} IS NOT NULL GROUP BY 1))"""
    for c in ("store_and_fwd_flag", "VendorID", "payment_type", "RatecodeID")
)

SQL["shape_stats"] = f"{TRIPS} " + union(
    f"""SELECT '{c}' AS "column", round(median({c}), 5) AS median,
        round((SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM trips WHERE {c} IS NOT NULL GROUP BY 1)
          ORDER BY n DESC, v LIMIT 1), 5) AS mode,
        round(skewness({c}), 5) AS skewness, round(kurtosis({c}), 5) AS kurtosis FROM trips"""
    for c in S.KEY_NUMERIC
)

SQL["iqr_outliers"] = f"{TRIPS} " + union(
    f"""SELECT '{c}' AS "column", round(any_value(lo), 6) AS lower_bound, round(any_value(hi), 6) AS upper_bound,
        {n_if(f"{c} < lo OR {c} > hi")} AS outliers, {pct(f"{c} < lo OR {c} > hi")} AS outlier_pct,
        round(min({c}) FILTER (WHERE {c} < lo OR {c} > hi), 6) AS min_outlier,
        round(max({c}) FILTER (WHERE {c} < lo OR {c} > hi), 6) AS max_outlier
        FROM trips, (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
          (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM trips))"""
    for c in S.OUTLIER_COLUMNS
)

SQL["value_dist"] = f"{TRIPS} " + union(
    f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n,
        round(100.0 * count(*) / (SELECT count(*) FROM trips), 6) AS pct
        FROM trips WHERE {c} IS NOT NULL GROUP BY {c}"""
    for c in ("VendorID", "payment_type", "RatecodeID", "store_and_fwd_flag")
)

SQL["group_dist"] = f"""{TRIPS}
SELECT {MISSING} AS has_missing, {", ".join(f"{pct(f'payment_type = {v}')} AS pct_{v}" for v in range(5))},
  {pct("payment_type NOT IN (0, 1, 2, 3, 4)")} AS pct_other
FROM trips GROUP BY 1"""

SQL["group_means"] = f"""{TRIPS}
SELECT {MISSING} AS has_missing, round(avg(trip_distance), 6) AS mean_trip_distance,
  round(avg(fare_amount), 6) AS mean_fare_amount, round(avg(total_amount), 6) AS mean_total_amount,
  round(avg({DUR}), 6) AS mean_trip_duration_minutes
FROM trips GROUP BY 1"""

SQL["target_dist"] = f"""{TRIPS}
SELECT count(total_amount) AS n, round(min(total_amount), 6) AS min, round(max(total_amount), 6) AS max,
  round(avg(total_amount), 6) AS mean, round(median(total_amount), 6) AS median,
  round(stddev_samp(total_amount), 6) AS std, {n_if("total_amount < 0")} AS negative,
  {pct("total_amount < 0", "count(total_amount)")} AS negative_pct, {n_if("total_amount < -1")} AS below_minus_one,
  {n_if("total_amount >= -1 AND total_amount < 0")} AS minus_one_to_zero,
  {n_if("total_amount = 0")} AS zero, {n_if("total_amount > 0")} AS positive
FROM trips"""

SQL["input_stats"] = f"{TRIPS} " + union(
    f"""SELECT '{c}' AS "column", count(*) AS rows, round(min({c}), 6) AS min, round(max({c}), 6) AS max,
        round(avg({c}), 6) AS mean FROM trips"""
    for c in ("trip_distance", "fare_amount", "passenger_count")
)

SQL["date_range"] = f"""{TRIPS}
SELECT min(tpep_pickup_datetime) AS first_pickup, max(tpep_pickup_datetime) AS last_pickup,
  min(tpep_dropoff_datetime) AS first_dropoff, max(tpep_dropoff_datetime) AS last_dropoff FROM trips"""

SQL["duration_stats"] = f"""{TRIPS}
SELECT round(avg({DUR}), 6) AS mean, round(median({DUR}), 6) AS median, round(min({DUR}), 6) AS min,
  round(max({DUR}), 6) AS max, round(stddev_samp({DUR}), 6) AS std,
  {n_if(DUR + " < 1")} AS very_short, {pct(DUR + " < 1")} AS very_short_pct,
  {n_if(DUR + " > 120")} AS very_long, {pct(DUR + " > 120")} AS very_long_pct
FROM trips"""

SQL["hourly_dist"] = f"{TRIPS} SELECT {HOUR} AS pickup_hour, count(*) AS trips FROM trips GROUP BY 1"

SQL["peak_hours"] = f"""{TRIPS}, c AS (SELECT {HOUR} AS h, count(*) AS n FROM trips GROUP BY 1)
SELECT a.h AS peak_hour, a.n AS peak_hour_trips, b.h AS lowest_hour, b.n AS lowest_hour_trips
FROM (SELECT * FROM c ORDER BY n DESC, h LIMIT 1) a, (SELECT * FROM c ORDER BY n, h LIMIT 1) b"""

SQL["dow_dist"] = f"""{TRIPS}
SELECT {DOW} AS pickup_dayofweek, count(*) AS trips,
  round(100.0 * count(*) / (SELECT count(*) FROM trips), 6) AS pct, {DAY_NAME}[{DOW} + 1] AS day
FROM trips GROUP BY {DOW}"""

SQL["daily_dist"] = f"""{TRIPS}, c AS (SELECT {DAY} AS k, count(*) AS n FROM trips GROUP BY 1)
SELECT s.days, s.mean_trips, a.k AS busiest_day, a.n AS most_trips, b.k AS quietest_day, b.n AS least_trips
FROM (SELECT count(*) AS days, round(avg(n), 6) AS mean_trips FROM c) s,
  (SELECT * FROM c ORDER BY n DESC, k LIMIT 1) a, (SELECT * FROM c ORDER BY n, k LIMIT 1) b"""

SQL["hourly_means"] = f"""{TRIPS}
SELECT {HOUR} AS pickup_hour, round(avg(trip_distance), 6) AS mean_trip_distance,
  round(avg(fare_amount), 6) AS mean_fare_amount, round(avg(total_amount), 6) AS mean_total_amount,
  round(avg({DUR}), 6) AS mean_trip_duration_minutes
FROM trips GROUP BY 1"""

SQL["location_report"] = f"""{TRIPS}
SELECT count(*) AS trips, count(DISTINCT PULocationID) AS pickup_zones, min(PULocationID) AS pickup_min,
  max(PULocationID) AS pickup_max, count(DISTINCT DOLocationID) AS dropoff_zones,
  min(DOLocationID) AS dropoff_min, max(DOLocationID) AS dropoff_max,
  {n_if("PULocationID = DOLocationID")} AS same_zone, {pct("PULocationID = DOLocationID")} AS same_zone_pct
FROM trips"""

SQL["top_locations"] = f"{TRIPS} " + union(
    f"""(SELECT '{c}' AS "column", {c} AS zone, count(*) AS trips,
        round(100.0 * count(*) / (SELECT count(*) FROM trips), 6) AS pct
        FROM trips GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 10)"""
    for c in ("PULocationID", "DOLocationID")
)

SQL["money_stats"] = f"{TRIPS} " + union(
    f"""SELECT '{c}' AS "column", round(avg({c}), 6) AS mean, round(median({c}), 6) AS median,
        round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(stddev_samp({c}), 6) AS std FROM trips"""
    for c in ("fare_amount", "total_amount")
)

TIP_PCT = "(tip_amount / nullif(fare_amount, 0) * 100)"
SQL["tip_report"] = f"""{TRIPS}
SELECT {n_if("tip_amount = 0")} AS no_tip, {pct("tip_amount = 0")} AS no_tip_pct,
  {n_if("tip_amount > 0")} AS with_tip, {pct("tip_amount > 0")} AS with_tip_pct,
  round(avg(tip_amount) FILTER (WHERE tip_amount > 0), 6) AS mean_tip,
  round(median(tip_amount) FILTER (WHERE tip_amount > 0), 6) AS median_tip,
  round(avg({TIP_PCT}), 6) AS mean_tip_percentage, round(median({TIP_PCT}), 6) AS median_tip_percentage,
  {n_if("tolls_amount > 0")} AS with_tolls, {pct("tolls_amount > 0")} AS with_tolls_pct,
  round(avg(tolls_amount) FILTER (WHERE tolls_amount > 0), 6) AS mean_toll
FROM trips"""

SQL["tip_by_payment"] = f"""{TRIPS}
SELECT payment_type, round(avg(tip_amount), 6) AS mean, round(median(tip_amount), 6) AS median,
  count(tip_amount) AS count FROM trips GROUP BY 1"""

REV = "(total_amount / nullif(trip_distance, 0))"
SQL["speed_report"] = f"""{TRIPS}
SELECT round(avg({SPEED}), 6) AS mean_speed, round(median({SPEED}), 6) AS median_speed,
  round(max({SPEED}), 6) AS max_speed, {n_if(SPEED + " <= 30")} AS slow_trips,
  round(avg({SPEED}) FILTER (WHERE {SPEED} <= 30), 6) AS slow_mean,
  {n_if(SPEED + " <= 80")} AS plausible_trips,
  round(avg({SPEED}) FILTER (WHERE {SPEED} <= 80), 6) AS plausible_mean,
  round(avg({REV}), 6) AS mean_revenue_per_mile, round(median({REV}), 6) AS median_revenue_per_mile
FROM trips"""

SQL["trip_summary"] = f"""{TRIPS}
SELECT count(*) AS trips, round(sum(total_amount), 4) AS revenue, round(avg(trip_distance), 4) AS mean_distance,
  round(avg({DUR}), 4) AS mean_duration, round(avg(fare_amount), 4) AS mean_fare,
  round(avg(total_amount), 4) AS mean_total FROM trips"""

SQL["feature_profile"] = f"{ANALYSIS} " + union(
    f"""SELECT '{g}' AS feature_group, '{c}' AS feature, {n_if(c + " IS NULL")} AS missing,
        {pct(c + " IS NULL")} AS missing_pct, count(DISTINCT {c}) AS "distinct" FROM analysis"""
    for g, cols in S.FEATURE_GROUPS.items()
    for c in cols
)

SQL["feature_variance"] = f"{ANALYSIS} " + union(
    f"""SELECT '{c}' AS feature, round(var_pop(coalesce({c}, 0)), 6) AS variance,
        round(stddev_pop(coalesce({c}, 0)) / nullif(abs(avg(coalesce({c}, 0))), 0), 6) AS variation
        FROM analysis"""
    for c in S.ANALYSIS_COLUMNS
)

SQL["near_constant"] = f"{ANALYSIS} SELECT * FROM (" + union(
    f"""SELECT '{c}' AS feature, CAST(count(*) AS INT) AS "distinct", round(max(n) / sum(n), 6) AS top_share
        FROM (SELECT {c}, count(*) AS n FROM analysis WHERE {c} IS NOT NULL GROUP BY 1)"""
    for c in S.ANALYSIS_COLUMNS
) + """) WHERE "distinct" <= 1 OR ("distinct" = 2 AND top_share > 0.99)"""

# -- statistics -----------------------------------------------------------------------

TIMED = f"{TRIPS}, timed AS (SELECT *, {DUR} AS trip_duration_minutes FROM trips)"
SQL["corr_matrix"] = f"{TIMED} " + union(
    f"""SELECT '{a}' AS "left", '{b}' AS "right", round(corr({a}, {b}), 6) AS correlation FROM timed"""
    for a in S.CORRELATION_COLUMNS
    for b in S.CORRELATION_COLUMNS
)

SQL["target_correlations"] = f"{ANALYSIS}, c AS (" + union(
    f"""SELECT '{y}' AS target, '{x}' AS feature,
        CASE WHEN min({x}) < max({x}) THEN corr({y}, {x}) END AS correlation FROM analysis"""
    for y in ("total_amount", "fare_amount", "tip_amount")
    for x in S.ANALYSIS_COLUMNS
    if x != y
) + """), r AS (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY correlation DESC NULLS LAST, feature) AS hi,
    row_number() OVER (PARTITION BY target ORDER BY correlation ASC NULLS LAST, feature) AS lo FROM c)
SELECT target, feature, round(correlation, 6) AS correlation FROM r
WHERE (hi <= 15 AND correlation > 0) OR (lo <= 10 AND correlation < 0)"""

SQL["chi2_hour_missing"] = f"""{TRIPS}
, o AS (SELECT {HOUR} AS a, {MISSING} AS b, count(*) AS n FROM trips GROUP BY 1, 2)
, g AS (SELECT a, b FROM (SELECT DISTINCT a FROM o), (SELECT DISTINCT b FROM o))
, e AS (SELECT g.a, g.b, coalesce(o.n, 0) AS n,
    (SELECT sum(n) FROM o x WHERE x.a = g.a) * (SELECT sum(n) FROM o x WHERE x.b = g.b)
      / CAST((SELECT sum(n) FROM o) AS DOUBLE) AS expected
  FROM g LEFT JOIN o ON o.a = g.a AND o.b = g.b)
SELECT round(sum((n - expected) * (n - expected) / expected), 4) AS statistic,
  (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS dof FROM e"""

SQL["welch_t"] = f"{TIMED} " + union(
    f"""SELECT '{c}' AS "column", round(m1, 5) AS mean_in, round(m0, 5) AS mean_out,
        round((m1 - m0) / sqrt(v1 / n1 + v0 / n0), 5) AS t,
        round(power(v1 / n1 + v0 / n0, 2)
          / (power(v1 / n1, 2) / (n1 - 1) + power(v0 / n0, 2) / (n0 - 1)), 5) AS dof
        FROM (SELECT count({c}) FILTER (WHERE {MISSING}) AS n1, avg({c}) FILTER (WHERE {MISSING}) AS m1,
          var_samp({c}) FILTER (WHERE {MISSING}) AS v1, count({c}) FILTER (WHERE NOT {MISSING}) AS n0,
          avg({c}) FILTER (WHERE NOT {MISSING}) AS m0, var_samp({c}) FILTER (WHERE NOT {MISSING}) AS v0
          FROM timed)"""
    for c in S.COMPARED_COLUMNS
)


# The tails by other means than the expressions under test: sums of logarithms below the mean, a fraction above it.
SQL["chi2_test"] = f"""WITH found AS ({SQL["chi2_hour_missing"].replace("round(sum((n - expected) * (n - expected) / expected), 4)", "sum((n - expected) * (n - expected) / expected)")})
, half AS (SELECT *, dof / 2.0 AS a, statistic / 2.0 AS x FROM found)
, tail AS (SELECT *, CASE
    WHEN x < a + 1 THEN 1 - exp(a * ln(x) - x) * list_sum(list_transform(range(0, 1000), lambda n: exp(n * ln(x) - lgamma(a + n + 1))))
    ELSE exp(a * ln(x) - x - lgamma(a)) / (x + 1 - a - list_reduce(range(1500, 0, -1), lambda s, n: n * (n - a) / (x + 2 * n + 1 - a - s), 0e0))
  END AS p FROM half)
SELECT round(statistic, 4) AS statistic, dof, round(p, 4) AS p_value, p < 0.05 AS significant FROM tail"""

# The same columns before rounding.
_WELCH = f"{TIMED} " + union(
    f"""SELECT '{c}' AS "column", m1 AS mean_in, m0 AS mean_out, (m1 - m0) / sqrt(v1 / n1 + v0 / n0) AS t,
        power(v1 / n1 + v0 / n0, 2) / (power(v1 / n1, 2) / (n1 - 1) + power(v0 / n0, 2) / (n0 - 1)) AS dof
        FROM (SELECT count({c}) FILTER (WHERE {MISSING}) AS n1, avg({c}) FILTER (WHERE {MISSING}) AS m1,
          var_samp({c}) FILTER (WHERE {MISSING}) AS v1, count({c}) FILTER (WHERE NOT {MISSING}) AS n0,
          avg({c}) FILTER (WHERE NOT {MISSING}) AS m0, var_samp({c}) FILTER (WHERE NOT {MISSING}) AS v0
          FROM timed)"""
    for c in S.COMPARED_COLUMNS
)
SQL["welch_test"] = f"""SELECT "column", round(mean_in, 5) AS mean_in, round(mean_out, 5) AS mean_out, round(t, 5) AS t, round(dof, 5) AS dof,
  round(p, 5) AS p_value, p < 0.05 AS significant
FROM (
  SELECT *,
    -- Twice the density's integral beyond |t|, by Simpson's rule over 20,000 steps of u with t = |t| + u / (1 - u).
    2 * exp(lgamma((dof + 1) / 2) - lgamma(dof / 2)) / sqrt(dof * pi()) * list_sum(list_transform(range(0, 20000),
      lambda k: (CASE WHEN k = 0 THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) / 60000.0
        * power(1 + power(abs(t) + (k / 20000.0) / (1 - k / 20000.0), 2) / dof, -(dof + 1) / 2) / power(1 - k / 20000.0, 2))) AS p
  FROM ({_WELCH}))"""


SQL["incremental_summary"] = f"{TIMED} " + union(
    f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        round(min({c})::DOUBLE, 4) AS "min", round(max({c})::DOUBLE, 4) AS "max" FROM timed"""
    for c in S.KEY_NUMERIC
)
SQL["approx_distinct"] = f"{TIMED} " + union(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS exact, true AS within FROM timed""" for c in [*S.KEY_NUMERIC, "trip_id", "payment_type"]
)

SQL["shuffled_rows"] = SQL["shuffle_order"]
SQL["read_two_periods"] = f"""{TRIPS}
SELECT CASE WHEN year(tpep_pickup_datetime) < 1998 THEN 'early' ELSE 'late' END AS period,
  count(*) AS trips, min(tpep_pickup_datetime) AS first_pickup, max(tpep_pickup_datetime) AS last_pickup,
  round(avg(total_amount), 6) AS mean_total, count(Airport_fee) FILTER (year(tpep_pickup_datetime) < 1998) AS fees
FROM trips GROUP BY 1"""
