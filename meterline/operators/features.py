"""Silver to gold: feature columns and zone frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.clock import calendar_columns, cyclic_columns, period_flags
from meterline.functions.fares import distance_columns, flag_columns, ratio_columns
from meterline.functions.zones import route_of, zone_number
from meterline.operators.lookup import attach_counts
from meterline.schema import GOLD_COLUMNS, MONTH_KEYS
from meterline.settings import FeatureGroups, JoinBounds
from meterline.sources.scratch import checkpointed

FREQUENCIES = {
    "pickup_zone_trip_count": "PULocationID",
    "dropoff_zone_trip_count": "DOLocationID",
    "route_trip_count": "route_id",
}


def add_calendar(trips: DataFrame) -> DataFrame:
    return trips.withColumns(calendar_columns(F.col("tpep_pickup_datetime")))


def add_period_flags(trips: DataFrame) -> DataFrame:
    return trips.withColumns(period_flags(F.col("pickup_hour"), F.col("pickup_day_of_week")))


def add_cyclic(trips: DataFrame) -> DataFrame:
    return trips.withColumns(cyclic_columns(F.col("pickup_hour"), F.col("pickup_day_of_week")))


def add_time_features(trips: DataFrame, cyclic: bool = True) -> DataFrame:
    trips = trips.transform(add_calendar).transform(add_period_flags)
    return trips.transform(add_cyclic) if cyclic else trips


def add_distance_features(trips: DataFrame) -> DataFrame:
    return trips.withColumns(distance_columns(F.col("trip_distance")))


def add_ratio_features(trips: DataFrame) -> DataFrame:
    return trips.withColumns(ratio_columns())


def add_flag_features(trips: DataFrame) -> DataFrame:
    return trips.withColumns(flag_columns())


def normalise_zones(trips: DataFrame) -> DataFrame:
    """Zone ids as the text of an int."""
    return trips.withColumns(
        {name: zone_number(name).cast("string") for name in ("PULocationID", "DOLocationID")}
    )


def add_route(trips: DataFrame) -> DataFrame:
    """Route and same-zone flag, from normalised zones: equal text is then equal number."""
    pickup, dropoff = F.col("PULocationID"), F.col("DOLocationID")
    return trips.withColumns({"route_id": route_of(pickup, dropoff), "is_same_zone": pickup == dropoff})


def count_routes(trips: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Trips per ``(scope, pickup zone, dropoff zone)``: the grain of all three frequencies.

    Map-side combine leaves one row per key and task, so a heavy route costs no more than a
    light one.
    """
    return trips.groupBy(*scope, "PULocationID", "DOLocationID").agg(F.count("*").alias("trips"))


def frequencies_from(grain: DataFrame, scope: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The three frequency tables, summed from the route grain."""
    grain = grain.withColumn("route_id", route_of(F.col("PULocationID"), F.col("DOLocationID")))
    return {
        name: grain.groupBy(*scope, key).agg(F.sum("trips").alias(name)) for name, key in FREQUENCIES.items()
    }


def add_frequencies(
    trips: DataFrame,
    scope: Sequence[str] = (),
    bounds: JoinBounds = JoinBounds(),
    only: Sequence[str] = tuple(FREQUENCIES),
    grain: DataFrame | None = None,
) -> DataFrame:
    """Trip counts of the pickup zone, the dropoff zone and the route, as columns.

    ``scope`` limits the counts, e.g. to ``("year", "month")``; empty counts over all of
    ``trips``. One aggregate over the key columns is computed once into the shared folder; the
    three tables come from it, and its counted size decides how they are joined. The trips
    themselves are read once more and, as long as the tables are small, never shuffled. A
    ``grain`` that was counted before, over exactly these trips, is used instead.
    """
    scope = list(scope)
    if grain is None:
        grain = checkpointed(count_routes(trips, scope))
    rows, total = grain.agg(F.count("*"), F.coalesce(F.sum("trips"), F.lit(0))).first()
    for name, table in frequencies_from(grain, scope).items():
        if name in only:
            size = rows
            if rows > bounds.broadcast_rows:
                # summed from many rows, and needed to be counted and again by every pass that joins it
                table = checkpointed(table)
                size = table.count()
            trips = attach_counts(trips, table, [*scope, FREQUENCIES[name]], name, size, total, bounds)
    return trips


def add_location_features(
    trips: DataFrame,
    frequency: bool = True,
    scope: Sequence[str] = (),
    bounds: JoinBounds = JoinBounds(),
    grain: DataFrame | None = None,
) -> DataFrame:
    trips = trips.transform(normalise_zones).transform(add_route)
    return add_frequencies(trips, scope, bounds, grain=grain) if frequency else trips


def gold_projection(trips: DataFrame, keep: Sequence[str] = MONTH_KEYS) -> DataFrame:
    """Drop dropoff time and total amount; gold column order, ``keep`` columns last."""
    return trips.select(*[name for name in (*GOLD_COLUMNS, *keep) if name in trips.columns])


def add_features(
    silver: DataFrame,
    groups: FeatureGroups = FeatureGroups(),
    scope: Sequence[str] | None = None,
    bounds: JoinBounds = JoinBounds(),
    keep: Sequence[str] = MONTH_KEYS,
    grain: DataFrame | None = None,
) -> DataFrame:
    """Gold trips. Ratios and flags need the total amount, so the projection comes last.

    ``scope`` defaults to year and month where silver has them, as a monthly run would count.
    """
    if scope is None:
        scope = [key for key in MONTH_KEYS if key in silver.columns]
    gold = silver
    # first, so that the joins copy rows without the other features
    if groups.location:
        gold = add_location_features(gold, groups.frequency, scope, bounds, grain)
    if groups.time:
        gold = add_time_features(gold, groups.cyclic)
    if groups.distance:
        gold = add_distance_features(gold)
    if groups.ratio:
        gold = add_ratio_features(gold)
    if groups.flags:
        gold = add_flag_features(gold)
    return gold_projection(gold, keep)
