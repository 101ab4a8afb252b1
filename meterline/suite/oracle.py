"""SQL of the trip layers over the supplied tables, for comparison in DuckDB."""

from __future__ import annotations

from meterline.functions.clock import DAY_NAMES, NIGHT_HOURS, PEAK_HOURS
from meterline.schema import BRONZE_COLUMNS, GOLD_COLUMNS, SILVER_COLUMNS

START = "l_shipdate + to_seconds((l_partkey * 7919 + l_orderkey * 104729) % 86400)"
FARE = "CASE WHEN l_partkey % 53 = 0 THEN -(l_extendedprice / 200e0) ELSE l_extendedprice / 200e0 END"

BRONZE = f"""
bronze_parts AS (
  SELECT l_orderkey, l_linenumber,
    CAST(CASE WHEN l_linenumber = 7 THEN 6 ELSE l_linenumber % 2 + 1 END AS INT) AS VendorID,
    {START} AS tpep_pickup_datetime,
    {START} + to_seconds((l_orderkey * 31 + l_partkey * 17) % 12000 - 600) AS tpep_dropoff_datetime,
    CASE WHEN CAST(l_quantity AS BIGINT) % 11 = 0 THEN NULL ELSE CAST(l_quantity AS BIGINT) % 10 END AS passenger_count,
    (l_quantity - 1e0) * (1 + l_linenumber) / 5e0 AS trip_distance,
    CASE WHEN round(l_tax * 100e0) = 8 THEN NULL ELSE CAST(round(l_discount * 100e0) AS BIGINT) END AS RatecodeID,
    CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'N' THEN 'N' ELSE NULL END AS store_and_fwd_flag,
    CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE CAST(l_suppkey % 265 + 1 AS VARCHAR) END AS PULocationID,
    CAST(l_partkey % 265 + 1 AS VARCHAR) AS DOLocationID,
    CAST(l_linenumber AS BIGINT) AS payment_type,
    {FARE} AS fare_amount,
    l_discount * 10e0 AS extra,
    5e-1 AS mta_tax,
    (l_discount * 100e0 - 1e0) * 3e-1 * ({FARE}) AS tip_amount,
    CASE WHEN l_linestatus = 'O' THEN 655e-2 ELSE 0e0 END AS tolls_amount,
    1e0 AS improvement_surcharge,
    CASE l_returnflag WHEN 'A' THEN 25e-1 WHEN 'N' THEN 0e0 ELSE NULL END AS congestion_surcharge,
    CASE l_suppkey % 10 WHEN 0 THEN 175e-2 WHEN 1 THEN NULL ELSE 0e0 END AS Airport_fee,
    CASE WHEN l_partkey % 3 = 0 THEN 75e-2 ELSE NULL END AS cbd_congestion_fee
  FROM lineitem
), bronze AS MATERIALIZED (
  SELECT *,
    CASE WHEN PULocationID = '7' THEN 0e0
         ELSE fare_amount + extra + mta_tax + tip_amount + tolls_amount + improvement_surcharge END AS total_amount,
    (epoch(date_trunc('second', tpep_dropoff_datetime)) - epoch(date_trunc('second', tpep_pickup_datetime))) / 60e0
      AS trip_duration_min,
    CAST(year(tpep_pickup_datetime) AS INT) AS year,
    CAST(month(tpep_pickup_datetime) AS INT) AS month
  FROM bronze_parts
)"""

# conditions of the cleaning filters
DURATION_OK = "trip_duration_min > 0 AND trip_duration_min < 180"
DISTANCE_OK = "trip_distance > 0 AND trip_distance < 60"
MONEY_OK = "fare_amount > 0 AND fare_amount < 500 AND total_amount >= 0"
COMPLETE = (
    "tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL"
    " AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL"
)

FILLED = """* REPLACE (
    coalesce(passenger_count, 1) AS passenger_count,
    coalesce(RatecodeID, 1) AS RatecodeID,
    coalesce(congestion_surcharge, 0e0) AS congestion_surcharge,
    coalesce(Airport_fee, 0e0) AS Airport_fee,
    coalesce(store_and_fwd_flag, 'N') AS store_and_fwd_flag)"""


def clipped(multiplier: str = "2e0") -> str:
    return f"""* REPLACE (
    CASE WHEN RatecodeID < 1 THEN 1 WHEN RatecodeID > 6 THEN 6 ELSE RatecodeID END AS RatecodeID,
    CASE WHEN tip_amount < 0 THEN 0e0 WHEN tip_amount > fare_amount * {multiplier} THEN fare_amount * {multiplier}
         ELSE tip_amount END AS tip_amount)"""


SILVER = f"""
filled AS (
  SELECT {FILLED} FROM bronze WHERE {DURATION_OK} AND {DISTANCE_OK} AND {MONEY_OK} AND {COMPLETE}
), silver AS MATERIALIZED (
  SELECT {clipped()} FROM filled
)"""

GOLD_BASE = f"""
timed AS (
  SELECT *,
    CAST(hour(tpep_pickup_datetime) AS INT) AS pickup_hour,
    CAST(isodow(tpep_pickup_datetime) - 1 AS INT) AS pickup_day_of_week,
    CAST(day(tpep_pickup_datetime) AS INT) AS pickup_day_of_month,
    CAST(week(tpep_pickup_datetime) AS INT) AS pickup_week_of_year,
    CAST(month(tpep_pickup_datetime) AS INT) AS pickup_month,
    CAST(year(tpep_pickup_datetime) AS INT) AS pickup_year
  FROM silver
), gold_base AS MATERIALIZED (
  SELECT *,
    pickup_day_of_week IN (5, 6) AS is_weekend,
    pickup_hour IN {PEAK_HOURS} AS is_peak_hour,
    pickup_hour IN {NIGHT_HOURS} AS is_night,
    pickup_hour IN {PEAK_HOURS} AS is_rush_hour,
    round(sin(2 * pi() * pickup_hour / 24), 9) + 0e0 AS sin_hour,
    round(cos(2 * pi() * pickup_hour / 24), 9) + 0e0 AS cos_hour,
    round(sin(2 * pi() * pickup_day_of_week / 7), 9) + 0e0 AS sin_day_of_week,
    round(cos(2 * pi() * pickup_day_of_week / 7), 9) + 0e0 AS cos_day_of_week,
    trip_distance < 1 AS is_short_trip,
    trip_distance > 10 AS is_long_trip,
    round(ln(1 + trip_distance), 9) AS log_trip_distance,
    sqrt(trip_distance) AS sqrt_trip_distance,
    CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance END AS fare_per_mile,
    CASE WHEN total_amount <> 0 THEN (coalesce(extra, 0e0) + coalesce(congestion_surcharge, 0e0)
      + coalesce(Airport_fee, 0e0) + coalesce(cbd_congestion_fee, 0e0)) / total_amount END AS surcharge_ratio,
    CASE WHEN total_amount <> 0 THEN tolls_amount / total_amount END AS toll_ratio,
    CAST(coalesce(tolls_amount, 0e0) > 0 AS INT) AS has_tolls,
    CAST(coalesce(Airport_fee, 0e0) > 0 AS INT) AS has_airport_fee,
    CAST(coalesce(congestion_surcharge, 0e0) > 0 AS INT) AS has_congestion_fee,
    total_amount - fare_amount AS non_fare_amount,
    PULocationID || '_' || DOLocationID AS route_id,
    PULocationID = DOLocationID AS is_same_zone
  FROM timed
)"""


def counted(scope: str = "year, month, ") -> str:
    """Gold with frequencies; ``scope`` is a key prefix, empty for the whole input."""
    return f"""
gold_wide AS MATERIALIZED (
  SELECT g.*, p.pickup_zone_trip_count, d.dropoff_zone_trip_count, r.route_trip_count
  FROM gold_base g
  LEFT JOIN (SELECT {scope}PULocationID, count(*) AS pickup_zone_trip_count FROM gold_base
             GROUP BY {scope}PULocationID) p USING ({scope}PULocationID)
  LEFT JOIN (SELECT {scope}DOLocationID, count(*) AS dropoff_zone_trip_count FROM gold_base
             GROUP BY {scope}DOLocationID) d USING ({scope}DOLocationID)
  LEFT JOIN (SELECT {scope}route_id, count(*) AS route_trip_count FROM gold_base
             GROUP BY {scope}route_id) r USING ({scope}route_id)
)"""


def over_bronze(select: str) -> str:
    return f"WITH {BRONZE}\n{select}"


def over_silver(select: str) -> str:
    return f"WITH {BRONZE}, {SILVER}\n{select}"


def over_features(select: str, more: str = "") -> str:
    """Over ``gold_base``: gold without frequencies, still with the total amount."""
    return f"WITH {BRONZE}, {SILVER}, {GOLD_BASE}{', ' + more if more else ''}\n{select}"


def over_gold(select: str, scope: str = "year, month, ", more: str = "") -> str:
    """Over ``gold_wide``: gold with frequencies."""
    return over_features(select, counted(scope) + (", " + more if more else ""))


def listed(names) -> str:
    return ", ".join(names)


BRONZE_LIST = listed(BRONZE_COLUMNS)
SILVER_LIST = listed(SILVER_COLUMNS)
GOLD_LIST = listed(GOLD_COLUMNS)

# --- marts -------------------------------------------------------------------------------------

DAILY = """
daily AS (
  SELECT pickup_year, pickup_month, pickup_day_of_month, count(*) AS trip_count,
    avg(trip_duration_min) AS avg_duration_min, avg(trip_distance) AS avg_distance,
    avg(fare_amount) AS avg_fare, sum(fare_amount) AS total_revenue
  FROM gold_base GROUP BY 1, 2, 3
)"""
HOURLY = """
hourly AS (
  SELECT pickup_hour, is_weekend, is_rush_hour, count(*) AS trip_count,
    avg(trip_duration_min) AS avg_duration_min, avg(fare_per_mile) AS avg_fare_per_mile
  FROM gold_base GROUP BY 1, 2, 3
)"""
PICKUP = """
pickup AS (
  SELECT PULocationID, count(*) AS pickup_count,
    avg(trip_distance) AS avg_distance_from_zone, avg(fare_amount) AS avg_fare_from_zone
  FROM gold_base GROUP BY 1
)"""

DAY_CASE = "CASE pickup_day_of_week " + " ".join(f"WHEN {i} THEN '{day}'" for i, day in enumerate(DAY_NAMES)) + " END"


def rounded(*names: str, digits: int = 6) -> str:
    return ", ".join(f"round({name}, {digits}) AS {name}" for name in names)


def single(*names: str) -> str:
    """Means in single precision, see ``frames.single``."""
    return ", ".join(f"CAST(CAST({name} AS FLOAT) AS DOUBLE) AS {name}" for name in names)
