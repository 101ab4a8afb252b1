"""Latest feature row per entity, and lookups into it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.zones import route_of
from meterline.operators.lookup import attach_rows
from meterline.settings import JoinBounds
from meterline.sources.scratch import checkpointed

# --- fixed values: the feature view -------------------------------------------------------------
ENTITY_KEYS = ("trip_id", "location_pair")
EVENT_TIME = "tpep_pickup_datetime"
CREATED = "created_at"
TTL_DAYS = 365
FIRST_EVENT = "2025-01-01 00:00:00"
FEATURES = (
    ("trip_duration_min", "float"),
    ("trip_distance", "float"),
    ("passenger_count", "bigint"),
    ("fare_amount", "float"),
    ("tip_amount", "float"),
    ("total_amount", "float"),
    ("hour_of_day", "bigint"),
    ("day_of_week", "bigint"),
    ("month", "bigint"),
    ("sin_hour", "float"),
    ("cos_hour", "float"),
    ("sin_day_of_week", "float"),
    ("cos_day_of_week", "float"),
    ("distance_per_minute", "float"),
    ("fare_per_mile", "float"),
)
# --- end of fixed values --------------------------------------------------------------------------

FEATURE_NAMES = tuple(name for name, _ in FEATURES)

def _derived() -> dict[str, Column]:
    """Features whose column in the trip frame has another name, or that need computing."""
    return {
        "hour_of_day": F.col("pickup_hour"),
        "day_of_week": F.col("pickup_day_of_week"),
        "month": F.col("pickup_month"),
        "distance_per_minute": F.try_divide("trip_distance", "trip_duration_min"),
    }


def prepare_entities(
    trips: DataFrame, created_at: datetime | None = None, id_columns: Sequence[str] | None = None
) -> DataFrame:
    """Add entity keys and timestamps where they are absent.

    The trip id is a hash of ``id_columns`` (all columns by default), so a task that runs again
    gives the same id. Name the columns that identify a trip where the source has them.
    """
    added = {}
    if "trip_id" not in trips.columns:
        added["trip_id"] = F.xxhash64(*(id_columns or trips.columns))
    if "location_pair" not in trips.columns and {"PULocationID", "DOLocationID"} <= set(trips.columns):
        added["location_pair"] = route_of(F.col("PULocationID"), F.col("DOLocationID"))
    now = F.current_timestamp() if created_at is None else F.lit(created_at)
    now = now.cast("timestamp_ntz")
    if EVENT_TIME not in trips.columns:
        added[EVENT_TIME] = now
    if CREATED not in trips.columns:
        added[CREATED] = now
    return trips.withColumns(added) if added else trips


def feature_view(entities: DataFrame) -> DataFrame:
    """Keys, timestamps and the 15 typed features.

    Features of another name are derived; the total amount must come with the trips, so feed
    silver rows with time features rather than gold.
    """
    derived = _derived()
    columns = [derived.get(name, F.col(name)).cast(kind).alias(name) for name, kind in FEATURES]
    return entities.select(*ENTITY_KEYS, EVENT_TIME, CREATED, *columns)


def _inside(start: str | datetime | None, end: str | datetime | None) -> Column:
    inside = F.lit(True)
    if start is not None:
        inside = inside & (F.col(EVENT_TIME) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        inside = inside & (F.col(EVENT_TIME) <= F.lit(end).cast("timestamp_ntz"))
    return inside


def _complete(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(key).isNotNull() for key in keys])


def _row(columns: Sequence[str], keys: Sequence[str]) -> Column:
    """A row without its keys, in the order that says which is newer."""
    return F.struct(EVENT_TIME, CREATED, *[name for name in columns if name not in (*keys, EVENT_TIME, CREATED)])


def latest_rows(view: DataFrame, keys: Sequence[str] = ENTITY_KEYS, bounds: JoinBounds = JoinBounds()) -> DataFrame:
    """The newest row per entity, by event time, then created time, then the row itself.

    The newest event time per entity is a hash aggregate over keys and time alone, which combines in each task,
    so an entity with a third of all rows is as cheap as any. It is written down and counted. Up to the
    bound it is broadcast, and the view is filtered where it lies: no row but an entity's newest moves. With
    more entities a hash join on keys and time keeps those rows. Only they, one per entity and its
    ties, are then ordered as whole rows. The view is computed twice, the first time in a few columns.
    """
    keys = list(keys)
    newest = view.groupBy(*keys).agg(F.max(EVENT_TIME).alias("_newest"))
    newest = checkpointed(newest.withColumnsRenamed({key: f"_{key}" for key in keys}))
    same = F.col(EVENT_TIME).eqNullSafe(F.col("_newest"))
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    held = F.broadcast(newest) if newest.count() <= bounds.broadcast_rows else newest.hint("shuffle_hash")
    last = view.join(held, same, "left_semi")
    return last.groupBy(*keys).agg(F.max(_row(view.columns, keys)).alias("_row")).select(*keys, "_row.*").select(*view.columns)


def materialise(
    view: DataFrame,
    start: str | datetime | None = FIRST_EVENT,
    end: str | datetime | None = None,
    keys: Sequence[str] = ENTITY_KEYS,
    bounds: JoinBounds = JoinBounds(),
) -> DataFrame:
    """Newest row per entity among events in ``[start, end]``, both inclusive."""
    return latest_rows(view.where(_inside(start, end)), keys, bounds)


def store_state(latest: DataFrame, table: str, path: str, keys: Sequence[str] = ENTITY_KEYS, buckets: int = 200) -> DataFrame:
    """Write one row per entity as a table in buckets of its keys, and read it.

    Rows that already lie by bucket, as those of :func:`materialise_increment` over such a table do, are
    not shuffled: every task writes the buckets it holds.
    """
    latest.write.bucketBy(buckets, *keys).option("path", path).saveAsTable(table)
    return latest.sparkSession.table(table)


def materialise_increment(
    state: DataFrame,
    view: DataFrame,
    start: str | datetime,
    end: str | datetime,
    keys: Sequence[str] = ENTITY_KEYS,
    bounds: JoinBounds = JoinBounds(),
) -> DataFrame:
    """Earlier state, which has one row per entity, brought forward by the events in ``[start, end]``.

    The increment is brought to one row per entity, and those to the state. A state in buckets of its keys
    (:func:`store_state`) is read, joined and written where it lies, so only the increment is shuffled.
    Entities with a NULL in their keys are brought forward apart, as no join on equality meets them.
    """
    keys, columns = list(keys), view.columns
    state = state.select(*columns)
    fresh = checkpointed(materialise(view, start, end, keys, bounds))
    old = state.where(_complete(keys)).select(*keys, _row(columns, keys).alias("_old"))
    new = fresh.where(_complete(keys)).select(*keys, _row(columns, keys).alias("_new"))
    kept = old.join(new.hint("shuffle_hash"), keys, "left").select(*keys, F.greatest("_old", "_new").alias("_row"))
    added = fresh.where(_complete(keys)).join(old.select(*keys), keys, "left_anti")
    apart = state.where(~_complete(keys)).unionByName(fresh.where(~_complete(keys)))
    of_null = apart.groupBy(*keys).agg(F.max(_row(columns, keys)).alias("_row"))
    merged = kept.unionByName(of_null).select(*keys, "_row.*").select(*columns)
    return merged.unionByName(added.select(*columns))


def lookup_features(
    wanted: DataFrame,
    latest: DataFrame,
    features: Sequence[str] = FEATURE_NAMES,
    keys: Sequence[str] = ENTITY_KEYS,
    now: str | datetime | None = None,
    ttl_days: int = TTL_DAYS,
    bounds: JoinBounds = JoinBounds(),
) -> DataFrame:
    """Feature values of each wanted key; an unknown or expired key, or one with a NULL, gives NULLs.

    Each key is looked up once, however often it is wanted: ``wanted`` is counted by key, which combines in each
    task, and the counts find the keys in ``latest``. What is found is written down and counted: up to
    the bound it is broadcast to the wanted rows. Beyond it the keys wanted most often, of which there is a
    bounded number, are broadcast, and the others are joined by shuffle; see :func:`lookup.attach_rows`.
    It is an error if ``latest`` has two rows of a key that is wanted.
    """
    keys = list(keys)
    current = F.current_timestamp() if now is None else F.lit(now)
    oldest = current.cast("timestamp_ntz") - F.expr(f"INTERVAL {ttl_days} DAYS")
    alive = latest.where(F.col(EVENT_TIME) >= oldest).select(*keys, *features)
    times = wanted.groupBy(*keys).agg(F.count(F.lit(1)).alias("times"))
    asked = times.dropna(subset=keys).select(*keys)
    found = checkpointed(alive.join(asked, keys, "left_semi"))
    rows, distinct = found.count(), found.select(*keys).distinct().count()
    if rows > distinct:
        raise ValueError(f"{rows - distinct} more rows than keys; take the newest row of each key first")
    if rows <= bounds.broadcast_rows:
        return wanted.join(F.broadcast(found), keys, "left")
    return attach_rows(wanted, found, keys, checkpointed(times), bounds)
