"""Independent SQL for the feature, encoder, split, baseline and request queries."""

from __future__ import annotations

from fareloom import schema as S
from fareloom.catalog.report_sql import ANALYSIS, DOW, DUR, FLAGS, HOUR, SPEED, TIMED, TRIPS, union

SQL: dict[str, str] = {}


def analysis(columns: list[str]) -> str:
    return f"{ANALYSIS} SELECT trip_id, {', '.join(columns)} FROM analysis"


SQL["features_temporal"] = analysis(
    ["trip_duration_minutes", "pickup_hour", "pickup_day", "pickup_dayofweek", "pickup_month",
     "is_weekend", "is_rush_hour", "is_night", "time_of_day"]
)
SQL["features_cyclic"] = analysis(
    ["hour_sin", "hour_cos", "dayofweek_sin", "dayofweek_cos", "day_sin", "day_cos"]
)
SQL["features_financial"] = analysis(
    ["tip_percentage", "fare_per_mile", "revenue_per_mile", "total_charges", "tip_ratio"]
)
SQL["features_location"] = analysis(["same_pickup_dropoff"])
SQL["features_interaction"] = analysis(["vendor_payment_interaction"])
SQL["neg_fare_flags"] = analysis(
    [*FLAGS, "negative_fare_category", "abs_negative_fare", "refund_amount"]
)
SQL["features_efficiency"] = f"""{TRIPS}
SELECT trip_id, CASE WHEN {SPEED} IS NOT NULL THEN least(greatest({SPEED}, 0), 80) END AS speed_mph,
  coalesce(trip_distance / nullif({DUR}, 0), 0) AS distance_per_minute,
  coalesce(passenger_count / nullif(trip_distance, 0), 0) AS passengers_per_mile
FROM trips"""
SQL["neg_fare_category"] = f"""{ANALYSIS}
SELECT negative_fare_category AS category, count(*) AS trips, round(avg(fare_amount), 6) AS mean_fare
FROM analysis GROUP BY 1"""

V1 = f"""
  trip_distance, {DUR} AS trip_duration_minutes, coalesce(passenger_count, 0) AS passenger_count,
  fare_amount, tip_amount, tolls_amount, coalesce(fare_amount / nullif(trip_distance, 0), 0) AS fare_per_mile,
  coalesce(tip_amount / nullif(fare_amount, 0), 0) AS tip_percentage, coalesce({SPEED}, 0) AS speed_mph,
  {HOUR} AS pickup_hour, {DOW} AS pickup_dayofweek, CAST(month(tpep_pickup_datetime) AS INT) AS pickup_month,
  CASE WHEN {DOW} >= 5 THEN 1 ELSE 0 END AS is_weekend, 0 AS is_rush_hour, 0 AS is_night,
  sin({HOUR} * (2 * pi() / 24)) AS hour_sin, cos({HOUR} * (2 * pi() / 24)) AS hour_cos,
  sin({DOW} * (2 * pi() / 7)) AS dayofweek_sin, cos({DOW} * (2 * pi() / 7)) AS dayofweek_cos,
  0 AS refund_amount, CASE WHEN fare_amount < 0 THEN 1 ELSE 0 END AS has_negative_fare, 0 AS is_full_refund,
  coalesce(fare_amount / nullif(trip_distance, 0), 0) AS revenue_per_mile,
  VendorID, payment_type, coalesce(RatecodeID, 0) AS RatecodeID,
  coalesce(store_and_fwd_flag, '0') AS store_and_fwd_flag, 'unknown' AS time_of_day,
  'none' AS negative_fare_category, concat(VendorID, '_', payment_type) AS vendor_payment_interaction
"""
SQL["features_v1"] = f"{TRIPS} SELECT trip_id, {V1} FROM trips"
SQL["features_v1_total_basis"] = f"""{TRIPS}
SELECT trip_id, coalesce(tip_amount / nullif(total_amount, 0), 0) AS tip_percentage,
  coalesce(total_amount / nullif(trip_distance, 0), 0) AS revenue_per_mile,
  CASE WHEN total_amount < 0 THEN 1 ELSE 0 END AS has_negative_fare FROM trips"""

SQL["zero_flags"] = f"""{TRIPS}
SELECT trip_id, CASE WHEN trip_distance <= 0 THEN 1 ELSE 0 END AS trip_distance_is_zero,
  CASE WHEN {DUR} <= 0 THEN 1 ELSE 0 END AS trip_duration_minutes_is_zero,
  CASE WHEN fare_amount <= 0 THEN 1 ELSE 0 END AS fare_amount_is_zero FROM trips"""

SQL["log_target"] = f"""{TRIPS}
SELECT trip_id, CASE WHEN total_amount > -1 THEN round(ln(1 + total_amount), 6) END AS log_target,
  CASE WHEN total_amount > -1 THEN round(total_amount, 6) END AS log_target_back FROM trips"""

SQL["tip_suggestions"] = f"""{TRIPS}
SELECT trip_id, round(total_amount, 6) AS predicted_fare,
  round(CASE WHEN trip_distance > 0 THEN total_amount / trip_distance ELSE 0 END, 6) AS fare_per_mile,
  round({SPEED}, 6) AS average_speed, rate AS tip_rate, round(total_amount * (rate / 100.0), 6) AS tip,
  round(total_amount * (1 + rate / 100.0), 6) AS total_with_tip
FROM trips, (SELECT unnest([15, 20, 25]) AS rate)"""

# -- fitted encoders ------------------------------------------------------------------

SQL["freq_encode"] = f"""{TRIPS}
SELECT trip_id, PULocationID, DOLocationID, count(*) OVER (PARTITION BY PULocationID) AS PULocationID_freq,
  count(*) OVER (PARTITION BY DOLocationID) AS DOLocationID_freq FROM trips"""

IS_TEST = "(substr(md5(concat('42|', trip_id)), 1, 8) < '33333333')"
SQL["freq_encode_fitted"] = f"""{TRIPS}
, marked AS (SELECT trip_id, PULocationID, RatecodeID, {IS_TEST} AS is_test FROM trips)
SELECT m.*, coalesce(p.n, 0) AS PULocationID_freq, coalesce(r.n, 0) AS RatecodeID_freq
FROM marked m
LEFT JOIN (SELECT PULocationID AS k, count(*) AS n FROM marked WHERE NOT is_test GROUP BY 1) p
  ON p.k IS NOT DISTINCT FROM m.PULocationID
LEFT JOIN (SELECT RatecodeID AS k, count(*) AS n FROM marked WHERE NOT is_test GROUP BY 1) r
  ON r.k IS NOT DISTINCT FROM m.RatecodeID"""

SQL["mode_fill"] = f"""{TRIPS}
SELECT trip_id, coalesce(passenger_count, (SELECT passenger_count FROM trips WHERE passenger_count IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS passenger_count FROM trips"""

SCALED = ["trip_distance", "fare_amount", "passenger_count", "trip_duration_minutes"]
SQL["standardize"] = f"""{TIMED}
, med AS (SELECT {", ".join(f"median({c}) AS {c}_m" for c in SCALED)} FROM timed)
, filled AS (SELECT trip_id, {", ".join(f"coalesce({c}, {c}_m) AS {c}" for c in SCALED)} FROM timed, med)
, fit AS (SELECT {", ".join(f"avg({c}) AS {c}_a, stddev_pop({c}) AS {c}_s" for c in SCALED)} FROM filled)
SELECT trip_id, {", ".join(f"round(({c} - {c}_a) / {c}_s, 6) AS {c}" for c in SCALED)} FROM filled, fit"""

SQL["robust_scale"] = f"""{TIMED}
, fit AS (SELECT {", ".join(f"median({c}) AS {c}_m, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS {c}_r" for c in SCALED)}
  FROM timed)
SELECT trip_id, {", ".join(f"round(({c} - {c}_m) / {c}_r, 6) AS {c}" for c in SCALED)} FROM timed, fit"""

SQL["cap_outliers"] = f"""{TIMED}
, fit AS (SELECT {", ".join(f"quantile_cont({c}, 0.01) AS {c}_l, quantile_cont({c}, 0.99) AS {c}_h" for c in SCALED)}
  FROM timed)
SELECT trip_id, {", ".join(
    f"round(CASE WHEN {c} < {c}_l THEN {c}_l WHEN {c} > {c}_h THEN {c}_h ELSE {c} END, 6) AS {c}" for c in SCALED
)} FROM timed, fit"""

GAP = ["passenger_count", "congestion_surcharge"]
SQL["mnar_handle"] = f"""{TRIPS}
SELECT trip_id, coalesce(store_and_fwd_flag, 'MISSING') AS store_and_fwd_flag, {", ".join(
    f"round(coalesce({c}, (SELECT median({c}) FROM trips)), 6) AS {c}, CAST({c} IS NULL AS INT) AS {c}_is_missing"
    for c in GAP
)} FROM trips"""

CATEGORICAL = list(S.MODEL_CATEGORICAL)


def mode_of(c: str, table: str) -> str:
    return (
        f"(SELECT CAST({c} AS VARCHAR) FROM {table} WHERE {c} IS NOT NULL "
        f"GROUP BY {c} ORDER BY count(*) DESC, CAST({c} AS VARCHAR) LIMIT 1)"
    )


SQL["onehot_long"] = f"{ANALYSIS} " + union(
    f"""SELECT trip_id, '{c}' AS "column",
        coalesce(CAST({c} AS VARCHAR), {mode_of(c, "analysis")}) AS category, 1 AS value FROM analysis"""
    for c in CATEGORICAL
)
SQL["onehot_drop_first"] = f"{ANALYSIS} SELECT * FROM (" + union(
    f"""SELECT trip_id, '{c}' AS "column", coalesce(CAST({c} AS VARCHAR), 'MISSING') AS category, 1 AS value
        FROM analysis
        WHERE coalesce(CAST({c} AS VARCHAR), 'MISSING') >
          (SELECT min(coalesce(CAST({c} AS VARCHAR), 'MISSING')) FROM analysis)"""
    for c in CATEGORICAL
) + ")"

NUMERIC = list(S.MODEL_NUMERIC)
SQL["assemble_features"] = f"""{TRIPS}
, v1 AS (SELECT trip_id, {IS_TEST} AS is_test, {V1} FROM trips)
, fit AS (SELECT {", ".join(f"avg({c}) AS {c}_a, stddev_pop({c}) AS {c}_s" for c in NUMERIC)} FROM v1 WHERE NOT is_test)
, x AS (SELECT v1.*, {", ".join(f"({c} - {c}_a) / (CASE WHEN {c}_s = 0 THEN 1 ELSE {c}_s END) AS x_{c}" for c in NUMERIC)}
  FROM v1, fit)
""" + union(
    [
        f"SELECT 'scaled_{c}' AS feature, count(*) FILTER (WHERE x_{c} <> 0) AS rows, round(sum(x_{c}), 4) AS total FROM x"
        for c in NUMERIC
    ]
    + [
        f"""SELECT 'is_{c}_' || k AS feature, count(*) FILTER (WHERE CAST({c} AS VARCHAR) = k) AS rows,
            CAST(count(*) FILTER (WHERE CAST({c} AS VARCHAR) = k) AS DOUBLE) AS total
            FROM x, (SELECT DISTINCT CAST({c} AS VARCHAR) AS k FROM x WHERE NOT is_test) GROUP BY k"""
        for c in CATEGORICAL
    ]
)

PREPARED = [*S.ANALYSIS_MODEL_NUMERIC, *[f"{c}_is_zero" for c in S.ZERO_CHECKED]]
SQL["prepare_training"] = f"""{ANALYSIS}
, ready AS (
  SELECT a.* REPLACE (t.passenger_count AS passenger_count), {IS_TEST.replace("trip_id", "a.trip_id")} AS is_test,
    {", ".join(f"CASE WHEN a.{c} <= 0 THEN 1 ELSE 0 END AS {c}_is_zero" for c in S.ZERO_CHECKED)}
  FROM analysis a JOIN trips t ON t.trip_id = a.trip_id WHERE a.total_amount >= 0)
, caps AS (SELECT {", ".join(f"quantile_cont({c}, 0.01) AS {c}_l, quantile_cont({c}, 0.99) AS {c}_h" for c in PREPARED)}
  FROM ready WHERE NOT is_test)
, capped AS (SELECT ready.* REPLACE ({", ".join(
    f"CAST(CASE WHEN {c} < {c}_l THEN {c}_l WHEN {c} > {c}_h THEN {c}_h ELSE {c} END AS DOUBLE) AS {c}" for c in PREPARED
)}), {", ".join(f"CAST({c} IS NULL AS INT) AS {c}_gap" for c in PREPARED)} FROM ready, caps)
, med AS (SELECT {", ".join(f"median({c}) AS {c}_m" for c in PREPARED)} FROM capped WHERE NOT is_test)
, gapless AS (SELECT capped.* REPLACE ({", ".join(f"coalesce({c}, {c}_m) AS {c}" for c in PREPARED)}) FROM capped, med)
, fit AS (SELECT {", ".join(
    f"median({c}) AS {c}_q2, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS {c}_r" for c in PREPARED
)} FROM gapless WHERE NOT is_test)
, x AS (SELECT gapless.*, CASE WHEN is_test THEN 'test' ELSE 'train' END AS part, {", ".join(
    f"({c} - {c}_q2) / (CASE WHEN {c}_r = 0 THEN 1 ELSE {c}_r END) AS x_{c}" for c in PREPARED
)} FROM gapless, fit)
""" + union(
    [
        f"""SELECT part, 'scaled_{c}' AS feature, count(*) FILTER (WHERE x_{c} <> 0) AS rows,
            round(sum(x_{c}), 4) AS total FROM x GROUP BY part"""
        for c in PREPARED
    ]
    + [
        f"""SELECT part, 'missing_{c}' AS feature, count(*) FILTER (WHERE {c}_gap = 1) AS rows,
            CAST(sum({c}_gap) AS DOUBLE) AS total FROM x GROUP BY part"""
        for c in PREPARED
    ]
    + [
        f"""SELECT part, 'is_{c}_' || k AS feature, count(*) FILTER (WHERE v = k) AS rows,
            CAST(count(*) FILTER (WHERE v = k) AS DOUBLE) AS total
            FROM (SELECT part, coalesce(CAST({c} AS VARCHAR), 'MISSING') AS v FROM x),
              (SELECT DISTINCT coalesce(CAST({c} AS VARCHAR), 'MISSING') AS k FROM x WHERE NOT is_test)
            WHERE k > (SELECT min(coalesce(CAST({c} AS VARCHAR), 'MISSING')) FROM x WHERE NOT is_test)
            GROUP BY part, k"""
        for c in CATEGORICAL
    ]
)

# -- splits ---------------------------------------------------------------------------

SQL["train_test_split"] = f"{TRIPS} SELECT trip_id, {IS_TEST} AS is_test FROM trips"
SQL["three_way_split"] = f"""{TRIPS}
SELECT trip_id, CASE WHEN {IS_TEST} THEN 'test'
  WHEN substr(md5(concat('42/validation|', trip_id)), 1, 8) < '33333333' THEN 'validation'
  ELSE 'train' END AS split FROM trips"""
FOLD = "CAST(CAST(concat('0x', substr(md5(concat('42|', trip_id)), 1, 8)) AS BIGINT) % 5 AS INT)"
SQL["kfold"] = f"{TRIPS} SELECT trip_id, {FOLD} AS fold FROM trips"

EDGES = "(SELECT quantile_cont(total_amount, [" + ", ".join(str(i / 10) for i in range(11)) + "]) AS q FROM trips)"
BINNED = f"""
, edge AS (SELECT DISTINCT unnest(q) AS e FROM {EDGES})
, inner_edge AS (SELECT e FROM edge WHERE e > (SELECT min(e) FROM edge) AND e < (SELECT max(e) FROM edge))
, binned AS (SELECT trip_id, total_amount,
    CAST((SELECT count(*) FROM inner_edge WHERE e <= total_amount) AS INT) AS bin FROM trips)
"""
SQL["quantile_bins"] = f"{TRIPS} {BINNED} SELECT * FROM binned"
SQL["stratified_folds"] = f"""{TRIPS} {BINNED}
SELECT *, CAST((row_number() OVER (PARTITION BY bin ORDER BY md5(concat('42|', trip_id)), trip_id) - 1) % 5 AS INT)
  AS fold FROM binned"""

# -- baseline model -------------------------------------------------------------------

BASELINE = f"""{TRIPS}
, marked AS (SELECT *, {IS_TEST} AS is_test FROM trips)
, line AS (SELECT regr_slope(total_amount, fare_amount) AS b, regr_intercept(total_amount, fare_amount) AS a
  FROM marked WHERE NOT is_test)
, scored AS (SELECT marked.*, a + b * fare_amount AS predicted_total_amount FROM marked, line)
"""


def metrics(y: str = "total_amount", p: str = "predicted_total_amount") -> str:
    return f"""count(*) AS n, round(avg(power({y} - {p}, 2)), 6) AS mse,
      round(sqrt(avg(power({y} - {p}, 2))), 6) AS rmse, round(avg(abs({y} - {p})), 6) AS mae,
      round(1 - sum(power({y} - {p}, 2)) / (count(*) * var_pop({y})), 6) AS r2"""


SQL["linear_baseline"] = f"""{BASELINE}
SELECT trip_id, is_test, round(total_amount, 6) AS total_amount,
  round(predicted_total_amount, 6) AS predicted_total_amount FROM scored"""
SQL["regression_metrics"] = f"{BASELINE} SELECT is_test, {metrics()} FROM scored GROUP BY 1"

FOLDS = f"""{TRIPS}
, folded AS (SELECT fare_amount, total_amount, {FOLD} AS fold FROM trips)
, lines AS (SELECT f.fold, regr_slope(t.total_amount, t.fare_amount) AS b,
    regr_intercept(t.total_amount, t.fare_amount) AS a
  FROM (SELECT DISTINCT fold FROM folded) f JOIN folded t ON t.fold <> f.fold GROUP BY 1)
, scored AS (SELECT folded.*, a + b * fare_amount AS predicted_total_amount FROM folded JOIN lines USING (fold))
"""
SQL["fold_metrics"] = f"{FOLDS} SELECT fold, {metrics()} FROM scored GROUP BY 1"
SQL["cv_summary"] = f"""{FOLDS}
SELECT count(*) AS folds, round(avg(mse), 6) AS avg_mse, round(stddev_pop(mse), 6) AS std_mse,
  round(avg(r2), 6) AS avg_r2, round(stddev_pop(r2), 6) AS std_r2
FROM (SELECT avg(power(total_amount - predicted_total_amount, 2)) AS mse,
    1 - sum(power(total_amount - predicted_total_amount, 2)) / (count(*) * var_pop(total_amount)) AS r2
  FROM scored GROUP BY fold)"""
SQL["residuals"] = f"""{BASELINE}
SELECT trip_id, round(total_amount, 6) AS total_amount, round(predicted_total_amount, 6) AS predicted_total_amount,
  round(total_amount - predicted_total_amount, 6) AS residual
FROM scored WHERE is_test ORDER BY md5(concat('42|', trip_id)), trip_id LIMIT 1000"""
SQL["prediction_stats"] = f"""{BASELINE}
SELECT round(avg(predicted_total_amount), 6) AS prediction_mean,
  round(stddev_pop(predicted_total_amount), 6) AS prediction_std,
  round(min(predicted_total_amount), 6) AS prediction_min, round(max(predicted_total_amount), 6) AS prediction_max,
  round(median(predicted_total_amount), 6) AS prediction_median, count(*) AS n_predictions FROM scored"""

SQL["resolve_version"] = f"""{TRIPS}
, by_year AS (SELECT CAST(year(tpep_pickup_datetime) AS INT) AS year, count(*) AS trips,
    round(regr_slope(total_amount, fare_amount), 6) AS slope, round(regr_r2(total_amount, fare_amount), 6) AS r2
  FROM trips WHERE total_amount >= 0 GROUP BY 1)
, v AS (SELECT *, year - (SELECT min(year) FROM by_year) + 1 AS number FROM by_year)
, staged AS (SELECT 'fare_line' AS model, CAST(number AS VARCHAR) AS version,
    CASE number % 3 WHEN 0 THEN 'Production' WHEN 1 THEN 'Staging' ELSE 'Archived' END AS stage,
    year, trips, slope, r2, number FROM v)
SELECT * EXCLUDE (number) FROM (
  (SELECT *, 'latest' AS wanted FROM staged ORDER BY number DESC LIMIT 1)
  UNION ALL (SELECT *, 'production' FROM staged WHERE stage = 'Production' ORDER BY number DESC LIMIT 1)
  UNION ALL (SELECT *, 'staging' FROM staged WHERE stage = 'Staging' ORDER BY number DESC LIMIT 1)
  UNION ALL (SELECT *, '2' FROM staged WHERE number = 2))"""

# -- requests -------------------------------------------------------------------------

TS = "'%Y-%m-%d %H:%M:%S'"
REQUESTS = f"""{TRIPS}
, sent AS (
  SELECT trip_id, trip_distance, fare_amount, tip_amount, tolls_amount, CAST(payment_type AS INT) AS payment_type,
    CASE WHEN PULocationID % 11 = 0 THEN replace(strftime(tpep_pickup_datetime, {TS}), ' ', 'T')
         WHEN PULocationID % 13 = 0 THEN replace(strftime(tpep_pickup_datetime, {TS}), '-0', '-')
         ELSE strftime(tpep_pickup_datetime, {TS}) END AS pickup_datetime,
    CASE WHEN PULocationID % 17 = 0 THEN strftime(tpep_dropoff_datetime, '%Y') || '-13-41 00:00:00'
         WHEN PULocationID % 19 = 0 THEN NULL ELSE strftime(tpep_dropoff_datetime, {TS}) END AS dropoff_datetime,
    CAST(coalesce(passenger_count, 1) AS INT) + CASE WHEN DOLocationID % 7 = 0 THEN 3 ELSE 0 END AS passenger_count,
    CASE WHEN DOLocationID % 23 = 0 THEN 3 ELSE VendorID END AS VendorID,
    CAST(coalesce(RatecodeID, 1) AS INT) AS RatecodeID,
    CASE WHEN DOLocationID % 29 = 0 THEN 'X' ELSE coalesce(store_and_fwd_flag, 'N') END AS store_and_fwd_flag
  FROM trips)
, timed_requests AS (
  SELECT *, CASE WHEN position('T' IN pickup_datetime) = 0 THEN try_strptime(pickup_datetime, {TS}) END AS picked,
    try_strptime(dropoff_datetime, {TS}) AS dropped FROM sent)
"""
RULES = {
    "pickup_datetime": "picked IS NOT NULL",
    "dropoff_datetime": "dropped IS NOT NULL",
    "trip_distance": "trip_distance IS NOT NULL",
    "passenger_count": "passenger_count BETWEEN 0 AND 4",
    "VendorID": "VendorID IN (1, 2)",
    "RatecodeID": "RatecodeID BETWEEN 1 AND 6",
    "store_and_fwd_flag": "store_and_fwd_flag IN ('Y', 'N')",
    "payment_type": "payment_type BETWEEN 1 AND 6",
    "fare_amount": "fare_amount IS NOT NULL",
    "tip_amount": "tip_amount >= 0",
    "tolls_amount": "tolls_amount >= 0",
}
STRICT = {
    **RULES,
    "passenger_count": "passenger_count BETWEEN 1 AND 4",
    "trip_distance": "trip_distance BETWEEN 0.1 AND 100",
    "trip_order": "dropped > picked",
}


def violations(rules: dict[str, str]) -> str:
    parts = ", ".join(f"CASE WHEN coalesce({ok}, false) THEN NULL ELSE '{r}' END" for r, ok in rules.items())
    return f"concat_ws(',', {parts})"


SQL["validate_requests"] = f"""{REQUESTS}
SELECT trip_id, store_and_fwd_flag, {violations(RULES)} AS violations, {violations(RULES)} = '' AS is_valid
FROM timed_requests"""
SQL["validate_json_requests"] = f"""{TRIPS}
, sent AS (
  SELECT trip_id, DOLocationID % 5 = 0 AS nulled, DOLocationID % 5 <> 0 AND DOLocationID % 3 = 0 AS left_out,
    DOLocationID % 5 <> 0 AND DOLocationID % 3 <> 0 AND DOLocationID % 13 = 0 AS unread,
    DOLocationID % 5 <> 0 AND DOLocationID % 3 <> 0 AND DOLocationID % 13 <> 0 AND DOLocationID % 17 = 0 AS corrupt, * EXCLUDE (trip_id)
  FROM trips)
, read AS (
  SELECT trip_id, corrupt,
    CASE WHEN corrupt OR nulled THEN NULL WHEN left_out THEN 1 ELSE CAST(coalesce(passenger_count, 1) AS INT) END AS passenger_count,
    CASE WHEN corrupt THEN NULL WHEN left_out THEN 0 ELSE tolls_amount END AS tolls_amount,
    CASE WHEN NOT corrupt AND NOT unread THEN fare_amount END AS fare_amount,
    CASE WHEN NOT corrupt THEN tpep_pickup_datetime END AS picked, CASE WHEN NOT corrupt THEN tpep_dropoff_datetime END AS dropped,
    CASE WHEN NOT corrupt THEN trip_distance END AS trip_distance, CASE WHEN NOT corrupt THEN VendorID END AS VendorID,
    CASE WHEN NOT corrupt THEN CAST(coalesce(RatecodeID, 1) AS INT) END AS RatecodeID,
    CASE WHEN NOT corrupt THEN coalesce(store_and_fwd_flag, 'N') END AS store_and_fwd_flag,
    CASE WHEN NOT corrupt THEN payment_type END AS payment_type, CASE WHEN NOT corrupt THEN tip_amount END AS tip_amount
  FROM sent)
SELECT trip_id, passenger_count, tolls_amount, concat_ws(',', {violations(RULES).removeprefix("concat_ws(',', ").removesuffix(")")}, CASE WHEN corrupt THEN 'json' END) AS violations,
  {violations(RULES)} = '' AND NOT corrupt AS is_valid
FROM read"""
SQL["validate_requests_strict"] = f"""{REQUESTS}
SELECT trip_id, {violations(STRICT)} AS violations, {violations(STRICT)} = '' AS is_valid FROM timed_requests"""
SQL["rejected_requests"] = f"{REQUESTS} SELECT * FROM (" + union(
    f"""SELECT '{r}' AS rule, count(*) AS requests, min(trip_id) AS first_request
        FROM timed_requests WHERE NOT coalesce({ok}, false)"""
    for r, ok in RULES.items()
) + ") WHERE requests > 0"

RDUR = "((epoch_us(dropped) - epoch_us(picked)) / 6e7)"
RHOUR = "CAST(hour(picked) AS INT)"
RDOW = "CAST(isodow(picked) - 1 AS INT)"
SQL["request_features"] = f"""{REQUESTS}
, unknown_fare AS (SELECT * REPLACE (CASE WHEN VendorID = 2 THEN 0 ELSE fare_amount END AS fare_amount) FROM timed_requests)
, good AS (SELECT * REPLACE (
    CASE WHEN fare_amount = 0 AND tip_amount > 0 THEN 25e-1 * (trip_distance * 25e-1) ELSE fare_amount END AS fare_amount)
  FROM unknown_fare WHERE {violations(RULES)} = '')
SELECT trip_id, trip_distance, passenger_count, VendorID, RatecodeID, store_and_fwd_flag, payment_type, fare_amount,
  tip_amount, tolls_amount, 0e0 AS extra, 5e-1 AS mta_tax, 3e-1 AS improvement_surcharge,
  25e-1 AS congestion_surcharge, 0e0 AS Airport_fee, {RDUR} AS trip_duration_minutes,
  {RHOUR} AS pickup_hour, {RDOW} AS pickup_dayofweek, CAST(month(picked) AS INT) AS pickup_month,
  CASE WHEN {RDOW} >= 5 THEN 1 ELSE 0 END AS is_weekend,
  sin({RHOUR} * (2 * pi() / 24)) AS hour_sin, cos({RHOUR} * (2 * pi() / 24)) AS hour_cos,
  sin({RDOW} * (2 * pi() / 7)) AS dayofweek_sin, cos({RDOW} * (2 * pi() / 7)) AS dayofweek_cos,
  coalesce(fare_amount / nullif(trip_distance, 0), 0) AS fare_per_mile, 0e0 AS revenue_per_mile,
  coalesce(tip_amount / nullif(fare_amount, 0), 0) AS tip_percentage,
  coalesce(trip_distance / nullif({RDUR} / 60, 0), 0) AS speed_mph,
  0 AS is_rush_hour, 0 AS is_night, 0 AS refund_amount,
  CASE WHEN fare_amount < 0 THEN 1 ELSE 0 END AS has_negative_fare, 0 AS is_full_refund,
  'unknown' AS time_of_day, 'none' AS negative_fare_category,
  concat(VendorID, '_', payment_type) AS vendor_payment_interaction
FROM good"""



# -- boosting: the root's sums and its split --------------------------------------------

EDGES = {
    "trip_distance": [0.0, 1.0, 2.5, 5.0, 7.5, 10.0, 15.0],
    "tip_amount": [-1.0, 0.0, 0.5, 1.0, 2.0, 3.0],
    "tolls_amount": [-1.0, 0.0, 5.0],
    "passenger_count": [0.0, 1.0, 2.0, 3.0],
}
CELLS = f"""{TRIPS}, cells AS (
  SELECT feature, bin, sum(-total_amount) AS g, count(*)::DOUBLE AS h FROM ({union(
      f"SELECT {n}::BIGINT AS feature, len(list_filter({edges}::DOUBLE[], lambda e: e < coalesce({c}, 0)))::BIGINT AS bin, total_amount FROM trips"
      for n, (c, edges) in enumerate(EDGES.items()))}) WHERE total_amount IS NOT NULL GROUP BY ALL)"""
SQL["boost_histogram"] = f"{CELLS} SELECT feature, bin, round(g, 4) AS gradient, h::BIGINT AS rows FROM cells"
SQL["boost_first_split"] = f"""{CELLS}, upto AS (
  SELECT *, sum(g) OVER (PARTITION BY feature ORDER BY bin) AS lg, sum(h) OVER (PARTITION BY feature ORDER BY bin) AS lh,
    sum(g) OVER (PARTITION BY feature) AS ag, sum(h) OVER (PARTITION BY feature) AS ah FROM cells),
scored AS (SELECT *, lg * lg / (lh + 1) + (ag - lg) ^ 2 / (ah - lh + 1) - ag * ag / (ah + 1) AS gain FROM upto WHERE ah - lh >= 1)
SELECT feature, bin, round(gain, 4) AS gain, lh::BIGINT AS left_rows, round(-lg / (lh + 1), 4) AS left_value,
  round(-(ag - lg) / (ah - lh + 1), 4) AS right_value
FROM scored ORDER BY scored.gain DESC, feature, bin LIMIT 1"""

SQL["onehot_table"] = f"{TRIPS} SELECT * FROM (" + union(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS categories, count(*) AS cells, true AS dense FROM trips"""
    for c in ("trip_id", "payment_type", "passenger_count")
) + ")"
