"""Bronze to silver: duration, filters, imputation, clipping. All steps are narrow."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.clock import duration_minutes
from meterline.schema import CRITICAL, FILL_VALUES, MONTH_KEYS, SILVER_COLUMNS
from meterline.settings import CleaningLimits


def add_duration(trips: DataFrame) -> DataFrame:
    minutes = duration_minutes(F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime"))
    return trips.withColumn("trip_duration_min", minutes)


def keep_known_columns(trips: DataFrame, keep: tuple[str, ...] = MONTH_KEYS) -> DataFrame:
    """The silver columns that exist, in silver order, then the ``keep`` columns that exist."""
    return trips.select(*[name for name in (*SILVER_COLUMNS, *keep) if name in trips.columns])


def _strictly_between(name: str, low: float, high: float):
    # a NULL fails both comparisons, and NaN is above every bound
    return (F.col(name) > low) & (F.col(name) < high)


def keep_valid_durations(trips: DataFrame, limits: CleaningLimits = CleaningLimits()) -> DataFrame:
    return trips.where(
        _strictly_between("trip_duration_min", limits.min_trip_duration_min, limits.max_trip_duration_min)
    )


def keep_valid_distances(trips: DataFrame, limits: CleaningLimits = CleaningLimits()) -> DataFrame:
    return trips.where(_strictly_between("trip_distance", limits.min_trip_distance, limits.max_trip_distance))


def keep_valid_money(trips: DataFrame, limits: CleaningLimits = CleaningLimits()) -> DataFrame:
    """Fare strictly inside its bounds; total at or above its own."""
    return trips.where(
        _strictly_between("fare_amount", limits.min_fare_amount, limits.max_fare_amount)
        & (F.col("total_amount") >= limits.min_total_amount)
    )


def keep_complete(trips: DataFrame) -> DataFrame:
    return trips.where(reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in CRITICAL]))


def fill_missing(trips: DataFrame) -> DataFrame:
    return trips.fillna(FILL_VALUES)


def clip_rate_code(trips: DataFrame) -> DataFrame:
    code = F.col("RatecodeID")
    return trips.withColumn("RatecodeID", F.when(code < 1, 1).when(code > 6, 6).otherwise(code))


def clip_tip(trips: DataFrame, limits: CleaningLimits = CleaningLimits()) -> DataFrame:
    tip, most = F.col("tip_amount"), F.col("fare_amount") * limits.max_tip_multiplier
    return trips.withColumn("tip_amount", F.when(tip < 0, 0.0).when(tip > most, most).otherwise(tip))


def clean(
    trips: DataFrame,
    limits: CleaningLimits = CleaningLimits(),
    keep: tuple[str, ...] = MONTH_KEYS,
) -> DataFrame:
    """All cleaning steps in order; imputation comes before the clips that rely on it."""
    return (
        trips.transform(add_duration)
        .transform(keep_known_columns, keep)
        .transform(keep_valid_durations, limits)
        .transform(keep_valid_distances, limits)
        .transform(keep_valid_money, limits)
        .transform(keep_complete)
        .transform(fill_missing)
        .transform(clip_rate_code)
        .transform(clip_tip, limits)
    )
