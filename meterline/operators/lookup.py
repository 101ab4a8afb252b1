"""Left join of trips to a small keyed table, with a checked broadcast and a way beyond it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.settings import JoinBounds
from meterline.sources.scratch import checkpointed

#: keys in a bucket of a packed table, on average
PACKED = 16


def broadcast_if_small(table: DataFrame, rows: int, bounds: JoinBounds = JoinBounds()) -> DataFrame:
    """Broadcast hint for a table whose counted ``rows`` stay inside the bound."""
    return F.broadcast(table) if rows <= bounds.broadcast_rows else table


def _zero(value: Column) -> Column:
    """A zero that depends on the row: a literal would be folded out of the join keys."""
    return F.pmod(F.hash(value), F.lit(1)).cast("int")


def attach_rows(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    times: DataFrame,
    bounds: JoinBounds = JoinBounds(),
) -> DataFrame:
    """Left join of ``rows`` to ``table``, which has one row per key, without gathering a heavy key in one task.

    ``times`` has the key columns and ``times``, how many of ``rows`` ask for the key (one row per key).
    Keys that more than ``total / hot_keys`` rows ask for are heavy hitters; there can be no more than
    ``hot_keys`` of them. They and what the table has for them are broadcast. Rows of a heavy key, and rows with
    a NULL in their key, get a salt that matches nothing and spreads them over the shuffle that joins the others.
    """
    keys = list(keys)
    values = [name for name in table.columns if name not in keys]
    total = times.agg(F.sum("times")).first()[0] or 0
    complete = times.dropna(subset=keys)
    hot = complete.where(F.col("times") > total / bounds.hot_keys).select(*keys)
    held = table.select(*keys, F.struct(F.lit(True).alias("there"), *values).alias("_row"))
    found_hot = hot.join(held.join(F.broadcast(hot), keys, "left_semi"), keys, "left")
    found_hot = found_hot.select(*keys, F.struct(F.lit(True).alias("asked"), F.col("_row")).alias("_hot"))
    cold = held.withColumnRenamed("_row", "_cold").withColumn("_salt", _zero(F.col(keys[0])))
    settled = F.col("_hot").isNotNull()
    for key in keys:
        settled = settled | F.col(key).isNull()
    spread = F.lit(1) + F.pmod(F.monotonically_increasing_id(), F.lit(bounds.salts)).cast("int")
    joined = (
        rows.join(F.broadcast(found_hot), keys, "left")
        .withColumn("_salt", F.when(settled, spread).otherwise(0))
        .join(cold, [*keys, "_salt"], "left")
    )
    found = F.coalesce("_hot._row", "_cold")
    return joined.select(*rows.columns, *[found[name].alias(name) for name in values])


def _packed(
    counts: DataFrame, keys: Sequence[str], value: str, buckets: int, hash_of: Callable[..., Column] = F.xxhash64
) -> DataFrame | None:
    """``counts`` as arrays of key hashes and values, a row per bucket; None where two keys share a hash."""
    held = counts.select(hash_of(*keys).alias("_hash"), value)
    packed = checkpointed(
        held.groupBy(F.pmod("_hash", F.lit(buckets)).alias("_bucket"))
        .agg(F.collect_list(F.struct("_hash", value)).alias("_held"))
        .select("_bucket", F.col("_held._hash").alias("_hashes"), F.col(f"_held.{value}").alias("_values"))
    )
    shared = packed.where(F.size(F.array_distinct("_hashes")) < F.size("_hashes"))
    return packed if shared.isEmpty() else None


def _attach_packed(trips: DataFrame, packed: DataFrame, keys: Sequence[str], value: str, buckets: int) -> DataFrame:
    """The value of each trip's key from a broadcast of :func:`_packed`.

    Every key of a trip is in the table, which was counted from the trips, and no two keys in it share a hash, so
    the hash found is that of the key.
    """
    whole = reduce(and_, [F.col(key).isNotNull() for key in keys])
    place = F.array_position("_hashes", F.col("_hash")).cast("int")
    return (
        trips.withColumn("_hash", F.when(whole, F.xxhash64(*keys)))
        .withColumn("_bucket", F.pmod("_hash", F.lit(buckets)))
        .join(F.broadcast(packed), "_bucket", "left")
        .select(*trips.columns, F.get("_values", place - 1).alias(value))
    )


def attach_counts(
    trips: DataFrame,
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    rows: int,
    total: int,
    bounds: JoinBounds = JoinBounds(),
) -> DataFrame:
    """Add ``value`` of the trip's key to every trip; no key, or a NULL in it, gives NULL.

    ``counts`` has one row per key, ``value`` being the number of trips with that key, ``rows``
    its size and ``total`` the sum of ``value``. A small table is broadcast and the trips stay
    where they are, and so they do for one that is small when packed (see :func:`_packed`).

    A larger table is joined by shuffle without gathering a heavy key in one task: keys above
    ``total / hot_keys`` trips, of which there can be no more than ``hot_keys``, are broadcast;
    trips that they answer, and trips without a key, get a salt that matches nothing and
    spreads them. Every other key is light, so the shuffle is even.
    """
    keys = list(keys)
    counts = counts.select(*keys, value).dropna(subset=keys)
    if rows <= bounds.broadcast_rows:
        return trips.join(F.broadcast(counts), keys, "left")
    if rows <= bounds.broadcast_rows * bounds.packing:
        buckets = rows // PACKED + 1
        packed = _packed(counts, keys, value, buckets)
        if packed is not None:
            return _attach_packed(trips, packed, keys, value, buckets)

    heavy = F.col(value) > total / bounds.hot_keys
    hot = counts.where(heavy).withColumnRenamed(value, "_hot")
    # a zero that depends on the row: a literal would be folded out of the join keys
    zero = F.pmod(F.col("_cold"), F.lit(1)).cast("int")
    cold = counts.where(~heavy).withColumnRenamed(value, "_cold").withColumn("_salt", zero)
    settled = F.col("_hot").isNotNull()
    for key in keys:
        settled = settled | F.col(key).isNull()
    spread = F.lit(1) + F.pmod(F.monotonically_increasing_id(), F.lit(bounds.salts)).cast("int")
    return (
        trips.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", F.when(settled, spread).otherwise(0))
        .join(cold, [*keys, "_salt"], "left")
        .withColumn(value, F.coalesce("_hot", "_cold"))
        .drop("_hot", "_cold", "_salt")
    )
