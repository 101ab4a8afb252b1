"""Time features of the pickup timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: hour and weekday sets, day names, Monday = 0 -------------------------------
WEEKEND_DAYS = (5, 6)
PEAK_HOURS = (7, 8, 9, 10, 16, 17, 18, 19)
NIGHT_HOURS = (22, 23, 0, 1, 2, 3, 4, 5)
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
TWO_PI = 2 * 3.141592653589793
# --- end of fixed values ----------------------------------------------------------------------


def duration_minutes(pickup: Column, dropoff: Column) -> Column:
    """Minutes between two timestamps, counted in whole seconds."""
    return (F.unix_timestamp(dropoff) - F.unix_timestamp(pickup)) / F.lit(60.0)


def calendar_columns(pickup: Column) -> dict[str, Column]:
    return {
        "pickup_hour": F.hour(pickup),
        "pickup_day_of_week": F.weekday(pickup),
        "pickup_day_of_month": F.dayofmonth(pickup),
        "pickup_week_of_year": F.weekofyear(pickup),
        "pickup_month": F.month(pickup),
        "pickup_year": F.year(pickup),
    }


def period_flags(hour: Column, weekday: Column) -> dict[str, Column]:
    peak = hour.isin(*PEAK_HOURS)
    return {
        "is_weekend": weekday.isin(*WEEKEND_DAYS),
        "is_peak_hour": peak,
        "is_night": hour.isin(*NIGHT_HOURS),
        "is_rush_hour": peak,
    }


def cyclic_columns(hour: Column, weekday: Column) -> dict[str, Column]:
    on_day = F.lit(TWO_PI) * hour / 24
    on_week = F.lit(TWO_PI) * weekday / 7
    return {
        "sin_hour": F.sin(on_day),
        "cos_hour": F.cos(on_day),
        "sin_day_of_week": F.sin(on_week),
        "cos_day_of_week": F.cos(on_week),
    }


def day_name(weekday: Column) -> Column:
    return F.get(F.array(*map(F.lit, DAY_NAMES)), weekday)
