"""Sinks for marts, query results and reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame


def write_mart(df: DataFrame, name: str, target: str, properties: dict[str, str] | None = None) -> str:
    """Overwrite one mart: a table where ``target`` is a JDBC url, else a parquet folder under it."""
    if target.startswith("jdbc:"):
        df.write.jdbc(url=target, table=name, mode="overwrite", properties=properties or {})
        return name
    path = f"{target.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """One CSV file with a header. Meant for report-sized results."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_as(df: DataFrame, path: str, file_format: str = "parquet", mode: str = "overwrite") -> str:
    df.write.mode(mode).format(file_format).save(path)
    return path


def write_report(report: DataFrame, folder: str, at: datetime | None = None) -> str:
    """Validation report as JSON lines in a folder named after its time."""
    stamp = (at or datetime.now()).strftime("%Y%m%d_%H%M%S")
    path = f"{folder.rstrip('/')}/validation_report_{stamp}"
    report.coalesce(1).write.mode("overwrite").json(path)
    return path
