"""BI queries over the layers and marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.clock import day_name
from meterline.functions.fares import distance_bucket
from meterline.operators.marts import DAY_KEYS


def _only(year: int | None, month: int | None = None) -> Column:
    """Condition on the partition columns, which prunes the scan."""
    condition = F.lit(True)
    if year is not None:
        condition = condition & (F.col("year") == year)
    if month is not None:
        condition = condition & (F.col("month") == month)
    return condition


def days_of_month(daily: DataFrame, year: int, month: int, limit: int = 10) -> DataFrame:
    """First days of a month in the daily mart, rounded."""
    return (
        daily.where((F.col("pickup_year") == year) & (F.col("pickup_month") == month))
        .select(
            F.col("pickup_day_of_month").alias("day"),
            "trip_count",
            F.round("avg_duration_min", 2).alias("avg_duration"),
            F.round("avg_distance", 2).alias("avg_distance"),
            F.round("total_revenue", 2).alias("revenue"),
        )
        .orderBy("day")
        .limit(limit)
    )


def rush_hour_contrast(hourly: DataFrame) -> DataFrame:
    """Rush hours against other hours on weekdays; averages are means of the mart's means."""
    return (
        hourly.where(~F.col("is_weekend"))
        .groupBy("is_rush_hour")
        .agg(
            F.sum("trip_count").alias("total_trips"),
            F.round(F.avg("avg_duration_min"), 2).alias("avg_duration"),
            F.round(F.avg("avg_fare_per_mile"), 3).alias("avg_fare_per_mile"),
        )
    )


def busiest_pickups(stats: DataFrame, limit: int = 10) -> DataFrame:
    return (
        stats.orderBy(F.desc("pickup_count"), "PULocationID")
        .limit(limit)
        .select(
            F.col("PULocationID").alias("location_id"),
            "pickup_count",
            F.round("avg_distance_from_zone", 2).alias("avg_distance"),
            F.round("avg_fare_from_zone", 2).alias("avg_fare"),
        )
    )


def weekend_contrast(hourly: DataFrame) -> DataFrame:
    return (
        hourly.groupBy("is_weekend")
        .agg(
            F.sum("trip_count").alias("total_trips"),
            F.round(F.avg("avg_duration_min"), 2).alias("avg_duration"),
        )
        .orderBy("is_weekend")
        .select(
            F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type"),
            "total_trips",
            "avg_duration",
        )
    )


def volume_by_hour(gold: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    return (
        gold.where(_only(year, month))
        .groupBy("pickup_hour")
        .agg(F.count("*").alias("trip_count"))
        .orderBy("pickup_hour")
    )


def duration_by_weekday(gold: DataFrame, year: int | None = None) -> DataFrame:
    return (
        gold.where(_only(year))
        .groupBy("pickup_day_of_week")
        .agg(F.avg("trip_duration_min").alias("avg_duration_min"), F.count("*").alias("trip_count"))
        .orderBy("pickup_day_of_week")
    )


def revenue_by_month(silver: DataFrame, year: int | None = None) -> DataFrame:
    """Revenue on the total amount; needs silver rows with ``pickup_month``."""
    return (
        silver.where(_only(year))
        .groupBy("pickup_month")
        .agg(
            F.sum("total_amount").alias("total_revenue"),
            F.avg("total_amount").alias("avg_fare"),
            F.count("*").alias("trip_count"),
        )
        .orderBy("pickup_month")
    )


def distance_buckets(gold: DataFrame, year: int | None = None) -> DataFrame:
    return (
        gold.where(_only(year))
        .groupBy(distance_bucket(F.col("trip_distance")).alias("distance_category"))
        .agg(
            F.avg("trip_duration_min").alias("avg_duration"),
            F.avg("trip_distance").alias("avg_distance"),
            F.count("*").alias("trip_count"),
        )
    )


def popular_pickups(gold: DataFrame, year: int | None = None, limit: int = 20) -> DataFrame:
    return (
        gold.where(_only(year))
        .groupBy("PULocationID")
        .agg(F.count("*").alias("pickup_count"), F.avg("trip_duration_min").alias("avg_duration"))
        .orderBy(F.desc("pickup_count"), "PULocationID")
        .limit(limit)
    )


def duration_by_day_name(gold: DataFrame, year: int | None = None) -> DataFrame:
    return (
        gold.where(_only(year))
        .groupBy("pickup_day_of_week")
        .agg(F.avg("trip_duration_min").alias("avg_duration"))
        .orderBy("pickup_day_of_week")
        .select(day_name(F.col("pickup_day_of_week")).alias("day_name"), "avg_duration")
    )


def daily_view(silver: DataFrame, name: str = "daily_trip_summary") -> DataFrame:
    """Register the daily summary view over silver rows with time features, and read it."""
    (
        silver.groupBy(*DAY_KEYS)
        .agg(
            F.count("*").alias("trip_count"),
            F.avg("trip_duration_min").alias("avg_duration"),
            F.sum("total_amount").alias("total_revenue"),
        )
        .createOrReplaceTempView(name)
    )
    return silver.sparkSession.table(name)


def month_sample(
    gold: DataFrame, year: int, month: int | None = None, limit: int = 100, ordered: bool = False
) -> DataFrame:
    """``limit`` trips of a year or month. Unordered, it stops at the first rows read."""
    rows = gold.where(_only(year, month))
    if ordered:
        rows = rows.orderBy(*[F.col(name).asc_nulls_last() for name in rows.columns])
    return rows.limit(limit)


def layer_month_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per layer and month."""
    counted = [
        df.groupBy("year", "month")
        .agg(F.count("*").alias("trip_count"))
        .select(F.lit(name).alias("layer"), "year", "month", "trip_count")
        for name, df in layers.items()
    ]
    result = counted[0]
    for part in counted[1:]:
        result = result.union(part)
    return result
