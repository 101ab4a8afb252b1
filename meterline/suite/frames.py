"""Frames and stored lakes the queries start from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators.clean import clean
from meterline.operators.features import add_features
from meterline.plans.stages import Lake, build_gold, build_silver
from meterline.settings import FeatureGroups, tune
from meterline.sources.layers import land_bronze
from meterline.sources.scratch import scratch_path
from meterline.sources.trips import trips_view, with_months

Query = Callable[[SparkSession, str], DataFrame]

# the supplied trips lie in 1995 to 2001, so year-bound queries ask for one of those
YEAR = 1998
MONTH = 1

PLAIN = FeatureGroups(frequency=False)


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None = None


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips over the supplied table; queries stack the layers on it, which makes wide stages."""
    tune(spark)
    return with_months(trips_view(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(bronze(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold without frequencies, for queries that do not read them."""
    return add_features(silver(spark, sf_dir), PLAIN)


def full_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_features(silver(spark, sf_dir))


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def single(df: DataFrame, *names: str) -> DataFrame:
    """Means in single precision.

    A mean of money can lie exactly between two decimals, where engines that add in another
    order round to different sides; no mean lies exactly between two binary fractions like that.
    """
    return df.withColumns({name: F.col(name).cast("float").cast("double") for name in names})


_STORED: dict[tuple[str, str], tuple[Lake, set[str]]] = {}


def stored_lake(spark: SparkSession, sf_dir: str, layer: str = "gold") -> Lake:
    """The layers of the supplied trips on disk up to ``layer``, each written once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    lake, held = _STORED.setdefault(key, (Lake(scratch_path(spark, "lake")), set()))
    steps = {
        "bronze": lambda: land_bronze(spark, trips_view(spark, sf_dir), lake.layer("bronze")),
        "silver": lambda: build_silver(spark, lake),
        "gold": lambda: build_gold(spark, lake),
    }
    for name, step in steps.items():
        if name not in held:
            step()
            held.add(name)
        if name == layer:
            break
    return lake


def empty_lake(spark: SparkSession) -> Lake:
    return Lake(scratch_path(spark, "lake"))
