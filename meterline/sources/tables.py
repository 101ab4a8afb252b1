"""Layer tables in the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.schema import LAYERS, stored_ddl


def create_tables(spark: SparkSession, roots: dict[str, str], database: str = "trips") -> list[str]:
    """Drop and recreate one external table per layer; returns their names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for layer, root in roots.items():
        name = f"{database}.{layer}_trips"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(
            f"CREATE TABLE {name} ({stored_ddl(layer)}) USING parquet"
            f" PARTITIONED BY (year, month) LOCATION '{root}'"
        )
        names.append(name)
    return names


def refresh_partitions(spark: SparkSession, names: list[str]) -> DataFrame:
    """Register the month folders found on disk; returns the partitions now known per table."""
    for name in names:
        spark.catalog.recoverPartitions(name)
    parts = [
        spark.sql(f"SHOW PARTITIONS {name}").select(F.lit(name).alias("table_name"), "partition") for name in names
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result


def table_summary(spark: SparkSession, database: str = "trips") -> DataFrame:
    """One row per layer table: columns declared and rows held."""
    rows = None
    for layer in LAYERS:
        name = f"{database}.{layer}_trips"
        if not spark.catalog.tableExists(name):
            continue
        columns = len(spark.catalog.listColumns(name))
        row = spark.table(name).agg(F.count("*").alias("trip_count"))
        row = row.select(
            F.lit(f"{layer}_trips").alias("table_name"), F.lit(columns).alias("column_count"), "trip_count"
        )
        rows = row if rows is None else rows.union(row)
    if rows is None:
        raise ValueError(f"database {database} holds no layer table")
    return rows
