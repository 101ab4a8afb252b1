"""Distance, ratio and flag features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: trip lengths, charge columns, bucket names -----------------------------------
SHORT_MILES = 1
LONG_MILES = 10
CHARGES = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "Airport_fee",
    "cbd_congestion_fee",
)
SURCHARGES = ("extra", "congestion_surcharge", "Airport_fee", "cbd_congestion_fee")
BUCKETS = (
    (1, "Short (<1mi)"),
    (5, "Medium (1-5mi)"),
    (10, "Long (5-10mi)"),
)
LAST_BUCKET = "Very Long (>10mi)"
# --- end of fixed values -------------------------------------------------------------------------


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def share_of(part: Column, whole: Column) -> Column:
    """``part / whole``; NULL where the whole is zero or NULL."""
    return F.when(whole != 0, part / whole)


def distance_columns(miles: Column) -> dict[str, Column]:
    return {
        "is_short_trip": miles < SHORT_MILES,
        "is_long_trip": miles > LONG_MILES,
        "log_trip_distance": F.log1p(miles),
        "sqrt_trip_distance": F.sqrt(miles),
    }


def ratio_columns() -> dict[str, Column]:
    miles, total = F.col("trip_distance"), F.col("total_amount")
    surcharges = or_zero(F.col(SURCHARGES[0]))
    for name in SURCHARGES[1:]:
        surcharges = surcharges + or_zero(F.col(name))
    return {
        "fare_per_mile": F.when(miles > 0, F.col("fare_amount") / miles),
        "surcharge_ratio": share_of(surcharges, total),
        "toll_ratio": share_of(F.col("tolls_amount"), total),
    }


def flag_columns() -> dict[str, Column]:
    def paid(name: str) -> Column:
        return (or_zero(F.col(name)) > 0).cast("int")

    return {
        "has_tolls": paid("tolls_amount"),
        "has_airport_fee": paid("Airport_fee"),
        "has_congestion_fee": paid("congestion_surcharge"),
        "non_fare_amount": F.col("total_amount") - F.col("fare_amount"),
    }


def distance_bucket(miles: Column) -> Column:
    """Name of the first bucket whose upper bound is above ``miles``."""
    names = F.lit(LAST_BUCKET)
    for below, name in reversed(BUCKETS):
        names = F.when(miles < below, name).otherwise(names)
    return names
