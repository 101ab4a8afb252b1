"""Hand-made trips: a good one, and changes to it."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from meterline.schema import BRONZE_DDL

START = datetime(2024, 1, 1, 12, 0, 0)
GOOD = {
    "VendorID": 1,
    "tpep_pickup_datetime": START,
    "tpep_dropoff_datetime": START + timedelta(minutes=10),
    "passenger_count": 2,
    "trip_distance": 3.0,
    "RatecodeID": 1,
    "store_and_fwd_flag": "Y",
    "PULocationID": "10",
    "DOLocationID": "20",
    "payment_type": 1,
    "fare_amount": 15.0,
    "extra": 1.0,
    "mta_tax": 0.5,
    "tip_amount": 3.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 20.5,
    "congestion_surcharge": 2.5,
    "Airport_fee": 0.0,
    "cbd_congestion_fee": None,
}


def after(minutes: float) -> datetime:
    return START + timedelta(minutes=minutes)


def trips(spark: SparkSession, *changes: dict) -> DataFrame:
    """One trip per change; payment_type is left free to number them."""
    rows = [tuple({**GOOD, "payment_type": number, **change}.values()) for number, change in enumerate(changes)]
    return spark.createDataFrame(rows, BRONZE_DDL.replace("\n", " "))


def kept(df: DataFrame) -> list[int]:
    return sorted(row.payment_type for row in df.collect())


def column(df: DataFrame, name: str) -> list:
    return [row[name] for row in df.orderBy("payment_type").collect()]
