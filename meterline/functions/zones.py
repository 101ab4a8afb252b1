"""Zone ids and routes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zone_number_sql(name: str) -> str:
    """Zone id as an int: ``"007"`` and ``"7.0"`` give 7, other text gives NULL.

    The decimal form is tried only where the plain cast fails, so clean ids pay one cast.
    """
    text = f"CAST(`{name}` AS STRING)"
    whole_part = rf"regexp_extract({text}, r'^\s*([+-]?\d+)\.\d*\s*$', 1)"
    return f"coalesce(try_cast({text} AS INT), try_cast({whole_part} AS INT))"


def zone_number(name: str) -> Column:
    return F.expr(zone_number_sql(name))


def route_of(pickup: Column, dropoff: Column) -> Column:
    """``PU_DO``; a NULL side is left out together with its separator."""
    return F.concat_ws("_", pickup, dropoff)
