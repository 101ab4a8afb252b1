"""Aggregate marts over gold trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.schema import MONTH_KEYS

# --- fixed values: mart keys, columns and table names ---------------------------------------------
DAY_KEYS = ("pickup_year", "pickup_month", "pickup_day_of_month")
HOUR_KEYS = ("pickup_hour", "is_weekend", "is_rush_hour")
RECENT_COLUMNS = (
    "tpep_pickup_datetime",
    "trip_duration_min",
    "trip_distance",
    "fare_amount",
    "PULocationID",
    "DOLocationID",
    "is_weekend",
    "is_rush_hour",
    "passenger_count",
)
MART_TABLES = {
    "daily": "gold_daily_trip_summary",
    "hourly": "gold_hourly_patterns",
    "pickup": "gold_pickup_location_stats",
    "recent": "gold_recent_trips",
}
# --- end of fixed values ---------------------------------------------------------------------------


def daily_summary(gold: DataFrame) -> DataFrame:
    return gold.groupBy(*DAY_KEYS).agg(
        F.count("*").alias("trip_count"),
        F.avg("trip_duration_min").alias("avg_duration_min"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("fare_amount").alias("avg_fare"),
        F.sum("fare_amount").alias("total_revenue"),
    )


def hourly_patterns(gold: DataFrame) -> DataFrame:
    return gold.groupBy(*HOUR_KEYS).agg(
        F.count("*").alias("trip_count"),
        F.avg("trip_duration_min").alias("avg_duration_min"),
        F.avg("fare_per_mile").alias("avg_fare_per_mile"),
    )


def pickup_stats(gold: DataFrame) -> DataFrame:
    return gold.groupBy("PULocationID").agg(
        F.count("*").alias("pickup_count"),
        F.avg("trip_distance").alias("avg_distance_from_zone"),
        F.avg("fare_amount").alias("avg_fare_from_zone"),
    )


def recent_trips(gold: DataFrame, n: int = 1000) -> DataFrame:
    """The ``n`` newest trips; ties are settled by the other columns, so the result is stable."""
    return gold.select(*RECENT_COLUMNS).orderBy(*_newest_first()).limit(n)


def _newest_first() -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in RECENT_COLUMNS]


def daily_totals(silver: DataFrame) -> DataFrame:
    """Daily means with revenue as the sum of the total amount, which gold no longer has.

    A trip counts where its vendor is known.
    """
    return silver.groupBy(*DAY_KEYS).agg(
        F.avg("trip_duration_min").alias("trip_duration_min"),
        F.avg("trip_distance").alias("trip_distance"),
        F.avg("fare_amount").alias("fare_amount"),
        F.sum("total_amount").alias("total_amount"),
        F.count("VendorID").alias("trip_count"),
    )


def hourly_means(gold: DataFrame) -> DataFrame:
    return gold.groupBy(*HOUR_KEYS).agg(
        F.avg("trip_duration_min").alias("trip_duration_min"),
        F.avg("fare_per_mile").alias("fare_per_mile"),
        F.count("VendorID").alias("trip_count"),
    )


def pickup_means(gold: DataFrame) -> DataFrame:
    return gold.groupBy("PULocationID").agg(
        F.avg("trip_distance").alias("trip_distance"),
        F.avg("fare_amount").alias("fare_amount"),
        F.count("VendorID").alias("pickup_count"),
    )


def largest_pickups(gold: DataFrame, n: int = 1000) -> DataFrame:
    """The ``n`` rows with the largest pickup time among those that have one."""
    return recent_trips(gold.where(F.col("tpep_pickup_datetime").isNotNull()), n)


def recent_by_month(gold: DataFrame, n: int = 1000) -> DataFrame:
    """The trips of each month among which :func:`recent_trips` finds its own, whatever other months hold."""
    newest = Window.partitionBy(*MONTH_KEYS).orderBy(*_newest_first())
    rows = gold.select(*dict.fromkeys([*RECENT_COLUMNS, *MONTH_KEYS])).withColumn("_place", F.row_number().over(newest))
    return rows.where(F.col("_place") <= n).drop("_place")


def trip_grain(gold: DataFrame, also_by: Sequence[str] = ()) -> DataFrame:
    """Sums and counts per day, hour and pickup zone, and per ``also_by``.

    The grain holds days x 24 x zones rows whatever the number of trips, and the three grouped
    marts follow from it, so exporting them reads gold once.
    """
    grain = gold.groupBy(*DAY_KEYS, *HOUR_KEYS, "PULocationID", *also_by)
    measures = ("trip_duration_min", "trip_distance", "fare_amount", "fare_per_mile")
    sums = [F.sum(name).alias(f"sum_{name}") for name in measures]
    counts = [F.count(name).alias(f"n_{name}") for name in measures]
    return grain.agg(F.count("*").alias("trips"), *sums, *counts)


def marts_from_grain(grain: DataFrame) -> dict[str, DataFrame]:
    """Daily, hourly and pickup marts from :func:`trip_grain`."""

    def mean(name: str):
        return F.try_divide(F.sum(f"sum_{name}"), F.sum(f"n_{name}"))

    trips = F.sum("trips")
    return {
        "daily": grain.groupBy(*DAY_KEYS).agg(
            trips.alias("trip_count"),
            mean("trip_duration_min").alias("avg_duration_min"),
            mean("trip_distance").alias("avg_distance"),
            mean("fare_amount").alias("avg_fare"),
            F.sum("sum_fare_amount").alias("total_revenue"),
        ),
        "hourly": grain.groupBy(*HOUR_KEYS).agg(
            trips.alias("trip_count"),
            mean("trip_duration_min").alias("avg_duration_min"),
            mean("fare_per_mile").alias("avg_fare_per_mile"),
        ),
        "pickup": grain.groupBy("PULocationID").agg(
            trips.alias("pickup_count"),
            mean("trip_distance").alias("avg_distance_from_zone"),
            mean("fare_amount").alias("avg_fare_from_zone"),
        ),
    }
