"""Notes beside a layer of what is being done to it, so that the next writer finishes what one that died began.

A note is a row of its own file, which is there as a whole or not at all. There is one writer per layer
at a time; an entry without its end therefore belongs to a writer that is gone.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NOTES = "entry string, kind string, state string, months array<struct<year:int,month:int>>, staged string"
BEGUN, DONE, VOID = "begun", "done", "void"
Month = tuple[int | None, int | None]


@dataclass(frozen=True)
class Entry:
    """Something begun: which months of the layer it replaces, and where their new rows lie, if they do."""

    name: str
    kind: str
    months: tuple[Month, ...]
    staged: str | None


def _path(root: str) -> str:
    return f"{root.rstrip('/')}-journal"


def _note(spark: SparkSession, root: str, name: str, kind: str, state: str, months: Sequence[Month] = (), staged: str | None = None) -> None:
    row = (name, kind, state, [tuple(month) for month in months], staged)
    spark.createDataFrame([row], NOTES).coalesce(1).write.mode("append").parquet(_path(root))


def begin(spark: SparkSession, root: str, kind: str, months: Sequence[Month] = (), staged: str | None = None, name: str | None = None) -> str:
    """Note that something begins; returns the entry's name."""
    name = name or uuid.uuid4().hex
    _note(spark, root, name, kind, BEGUN, months, staged)
    return name


def end(spark: SparkSession, root: str, name: str, kind: str, state: str = DONE) -> None:
    _note(spark, root, name, kind, state)


def notes(spark: SparkSession, root: str) -> DataFrame:
    """All notes of a layer."""
    try:
        return spark.read.schema(NOTES).parquet(_path(root))
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], NOTES)


def names(spark: SparkSession, root: str, kind: str, state: str) -> DataFrame:
    """Names of the entries (column ``entry``) that reached a state."""
    return notes(spark, root).where((F.col("kind") == kind) & (F.col("state") == state)).select("entry").distinct()


def unfinished(spark: SparkSession, root: str, kind: str) -> list[Entry]:
    """Entries that were begun and neither done nor made void. Only those of writers that died are collected."""
    held = notes(spark, root).where(F.col("kind") == kind)
    ended = held.where(F.col("state") != BEGUN).select("entry")
    rows = held.where(F.col("state") == BEGUN).join(ended, "entry", "left_anti").collect()
    return [Entry(row.entry, kind, tuple((m.year, m.month) for m in row.months), row.staged) for row in rows]
