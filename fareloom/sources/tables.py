"""A trip-shaped view over order lines.

The bundled data sets hold order lines and orders but no trips. ``TRIP_VIEW`` maps each
order line to one trip with planted gaps, refunds, zero distances and reversed times.
The text is plain SQL that both Spark and an independent SQL engine accept, so results
over it can be compared value for value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fareloom.session import settle, spread

TRIP_VIEW = """
SELECT
  trip_id, VendorID,
  picked AS tpep_pickup_datetime,
  picked + dur_s * INTERVAL '1' SECOND AS tpep_dropoff_datetime,
  CASE WHEN pay = 0 THEN NULL ELSE CAST(line % 5 AS DOUBLE) END AS passenger_count,
  dist AS trip_distance,
  CASE WHEN pay = 0 THEN NULL ELSE CAST(part % 6 + 1 AS DOUBLE) END AS RatecodeID,
  CASE WHEN pay = 0 THEN NULL WHEN h % 100 = 1 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
  CAST(part % 263 + 1 AS INT) AS PULocationID,
  CAST(ord % 263 + 1 AS INT) AS DOLocationID,
  CAST(pay AS BIGINT) AS payment_type,
  fare AS fare_amount,
  sgn * CAST(line % 3 AS DOUBLE) AS extra,
  sgn * 5e-1 AS mta_tax,
  tip AS tip_amount,
  tolls AS tolls_amount,
  sgn * 1e0 AS improvement_surcharge,
  fare + tip + tolls + sgn * (CAST(line % 3 AS DOUBLE) + 15e-1) AS total_amount,
  CASE WHEN pay = 0 THEN NULL ELSE sgn * 25e-1 END AS congestion_surcharge,
  CASE WHEN pay = 0 THEN NULL ELSE 0e0 END AS Airport_fee,
  sgn * 75e-2 AS cbd_congestion_fee
FROM (
  SELECT *,
    CASE WHEN h % 503 = 0 THEN 0e0 ELSE sgn * (3e0 + dist * 25e-1 + disc * 1e2) END AS fare,
    CASE WHEN sgn < 0 AND line = 7 THEN 2e2
         WHEN pay = 1 THEN sgn * (tax * 5e1) ELSE 0e0 END AS tip,
    CASE WHEN h % 13 = 0 THEN sgn * 694e-2 ELSE 0e0 END AS tolls
  FROM (
    SELECT *,
      CASE WHEN part % 50 = 0 THEN 0e0 ELSE qty * 4e-1 + (part % 10) * 1e-1 END AS dist,
      CASE WHEN h % 211 = 0 THEN -60 WHEN h % 97 = 0 THEN 0 WHEN h % 307 = 0 THEN 20000
           ELSE 120 + CAST(qty AS BIGINT) * 60 + h % 600 END AS dur_s,
      CASE WHEN h % 4 = 0 THEN 0 ELSE 1 + line % 4 END AS pay,
      CASE WHEN flagged = 'R' AND h % 9 = 0 THEN -1e0 ELSE 1e0 END AS sgn
    FROM (
      SELECT
        concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS trip_id,
        CAST(l_suppkey % 2 + 1 AS INT) AS VendorID,
        o_orderdate + ((l_orderkey * 37 + l_partkey * 11) % 1440) * INTERVAL '1' MINUTE AS picked,
        l_orderkey * 7 + l_linenumber * 13 + l_partkey * 31 + l_suppkey * 17 AS h,
        l_orderkey AS ord, l_linenumber AS line, l_partkey AS part,
        l_quantity AS qty, l_discount AS disc, l_tax AS tax, l_returnflag AS flagged
      FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
    ) AS keys
  ) AS parts
) AS money
"""


def trip_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view over the order tables in ``sf_dir``; a lazy plan, nothing is read yet."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return spark.sql(TRIP_VIEW, lineitem=spread(lines), orders=orders)


_stored: dict[tuple[str, str], DataFrame] = {}


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trips as a stored table, written to the shared folder once per application.

    Fits and reports pass over their input several times. From a stored table each pass
    reads only its columns and pushes its filters down, instead of joining again.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        _stored[key] = settle(trip_view(spark, sf_dir), "trips")
    return _stored[key]
