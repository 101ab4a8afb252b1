"""Tunable thresholds, passed as arguments; every field has its default here."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

# --- fixed values: default thresholds --------------------------------------------------------


@dataclass(frozen=True)
class CleaningLimits:
    min_trip_duration_min: float = 0.0
    max_trip_duration_min: float = 180.0
    min_trip_distance: float = 0.0
    max_trip_distance: float = 60.0
    min_fare_amount: float = 0.0
    max_fare_amount: float = 500.0
    min_total_amount: float = 0.0
    max_tip_multiplier: float = 2.0


@dataclass(frozen=True)
class FeatureGroups:
    """Which feature groups to add. Cyclic needs time; frequency needs location."""

    time: bool = True
    cyclic: bool = True
    distance: bool = True
    ratio: bool = True
    flags: bool = True
    location: bool = True
    frequency: bool = True


@dataclass(frozen=True)
class QualityLimits:
    # which groups of checks to run
    schema: bool = True
    completeness: bool = True
    consistency: bool = True
    business: bool = True
    duplicates: bool = True
    # schema matching
    strict: bool = True
    allow_extra_columns: bool = False
    allow_missing_columns: bool = False
    column_order: bool = False
    # data thresholds
    min_rows: int = 1000
    min_duration_seconds: int = 10
    max_duration_hours: int = 3
    cyclic_tolerance: float = 0.01
    max_tip_multiplier: float = 2.0
    min_speed_mph: float = 5.0
    max_speed_mph: float = 60.0
    critical_null_percent: float = 0.0
    important_null_percent: float = 5.0
    optional_null_percent: float = 50.0
    max_duplicate_percent: float = 1.0
    # declared tolerances of the optional checks
    iqr_multiplier: float = 1.5
    zscore_threshold: float = 3.0
    max_null_percent: float = 10.0
    ratio_tolerance: float = 0.05
    fare_tolerance: float = 0.10
    # outcome
    nulls_decide: bool = False
    fail_on_error: bool = False


# --- end of fixed values ----------------------------------------------------------------------


@dataclass(frozen=True)
class JoinBounds:
    """Proven size limits for joining a lookup table to the trips.

    A table with at most ``broadcast_rows`` rows is broadcast. A table of counts up to ``packing`` times as large is
    broadcast as a hash and a count a row, 16 bytes, which takes no more room. Beyond that the join shuffles:
    at most ``hot_keys`` heavy keys are split off and broadcast, the rest is spread over ``salts``.
    """

    broadcast_rows: int = 1_000_000
    packing: int = 8
    hot_keys: int = 10_000
    salts: int = 1024


@dataclass(frozen=True)
class WriteOptions:
    """Parquet settings of the layer writer."""

    mode: str = "overwrite"
    compression: str = "snappy"
    block_bytes: int = 128 * 1024 * 1024
    page_bytes: int = 1024 * 1024
    files: int | None = None


# Generated methods above 8000 bytes of bytecode are never compiled by the JVM and run many times
# slower. Spark's own limit is far higher; with this one it runs such a stage operator by operator,
# in methods small enough to compile. Wide aggregates, such as a full validation, need it.
RUNTIME_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


# A task that writes into partition folders first sorts all its rows by them, wide as they are, and spills what does not
# fit. With this setting it keeps a file open for each folder instead; only a task that meets more folders sorts the rest.
# Rows are brought together by month before they are written, so a large task holds few months.
WRITE_SETTINGS = {"spark.sql.maxConcurrentOutputFileWriters": "32"}


def tune(spark, settings: Mapping[str, str] = RUNTIME_SETTINGS) -> None:
    """Apply the runtime settings to a session."""
    for key, value in settings.items():
        spark.conf.set(key, value)


@contextmanager
def tuned(spark, settings: Mapping[str, str] = RUNTIME_SETTINGS) -> Iterator[None]:
    """The settings for one stage; the caller's settings hold again after it."""
    before = {key: spark.conf.get(key, None) for key in settings}
    tune(spark, settings)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
