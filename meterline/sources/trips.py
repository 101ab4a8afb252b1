"""The trip table: as a view over the supplied ``lineitem`` table, and conformed from raw files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.schema import BRONZE_DDL, CRITICAL, ddl_columns

# --- fixed values: the trip columns as formulas over lineitem, each over those before it -------
LINE_FORMULAS = (
    (
        "tpep_pickup_datetime",
        "timestampadd(SECOND, (l_partkey * 7919 + l_orderkey * 104729) % 86400, l_shipdate)",
    ),
    ("fare_amount", "l_extendedprice / 200.0D * CASE WHEN l_partkey % 53 = 0 THEN -1.0D ELSE 1.0D END"),
    ("PULocationID", "CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE CAST(l_suppkey % 265 + 1 AS STRING) END"),
)
TRIP_FORMULAS = (
    ("VendorID", "CAST(CASE WHEN l_linenumber = 7 THEN 6 ELSE l_linenumber % 2 + 1 END AS INT)"),
    (
        "tpep_dropoff_datetime",
        "timestampadd(SECOND, (l_orderkey * 31 + l_partkey * 17) % 12000 - 600, tpep_pickup_datetime)",
    ),
    (
        "passenger_count",
        "CASE WHEN CAST(l_quantity AS BIGINT) % 11 = 0 THEN NULL ELSE CAST(l_quantity AS BIGINT) % 10 END",
    ),
    ("trip_distance", "(l_quantity - 1.0D) * (1 + l_linenumber) / 5.0D"),
    (
        "RatecodeID",
        "CASE WHEN round(l_tax * 100.0D) = 8 THEN NULL ELSE CAST(round(l_discount * 100.0D) AS BIGINT) END",
    ),
    ("store_and_fwd_flag", "CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'N' THEN 'N' ELSE NULL END"),
    ("DOLocationID", "CAST(l_partkey % 265 + 1 AS STRING)"),
    ("payment_type", "CAST(l_linenumber AS BIGINT)"),
    ("extra", "l_discount * 10.0D"),
    ("mta_tax", "0.5D"),
    ("tip_amount", "(l_discount * 100.0D - 1.0D) * 0.3D * fare_amount"),
    ("tolls_amount", "CASE WHEN l_linestatus = 'O' THEN 6.55D ELSE 0.0D END"),
    ("improvement_surcharge", "1.0D"),
    ("congestion_surcharge", "CASE l_returnflag WHEN 'A' THEN 2.5D WHEN 'N' THEN 0.0D ELSE NULL END"),
    ("Airport_fee", "CASE l_suppkey % 10 WHEN 0 THEN 1.75D WHEN 1 THEN NULL ELSE 0.0D END"),
    ("cbd_congestion_fee", "CASE WHEN l_partkey % 3 = 0 THEN 0.75D ELSE NULL END"),
)
TOTAL_FORMULA = (
    "CASE WHEN PULocationID = '7' THEN 0.0D ELSE fare_amount + extra + mta_tax + tip_amount"
    " + tolls_amount + improvement_surcharge END"
)
# --- end of fixed values ----------------------------------------------------------------------


def trips_view(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bronze trips over ``lineitem``; ``keep`` names source columns to carry along.

    Columns that others are built on come first, so that they are computed once.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lines = lines.withColumns({name: F.expr(formula) for name, formula in LINE_FORMULAS})
    trips = lines.withColumns({name: F.expr(formula) for name, formula in TRIP_FORMULAS})
    trips = trips.withColumn("total_amount", F.expr(TOTAL_FORMULA))
    return trips.select(*keep, *(name for name, _ in ddl_columns(BRONZE_DDL)))


def with_months(trips: DataFrame, pickup: str = "tpep_pickup_datetime") -> DataFrame:
    """Add the partition columns ``year`` and ``month`` of the pickup time."""
    return trips.withColumns({"year": F.year(pickup), "month": F.month(pickup)})


def _present(raw: DataFrame) -> dict[str, str]:
    present = {name.lower(): name for name in raw.columns}
    absent = [name for name in CRITICAL if name.lower() not in present]
    if absent:
        raise ValueError(f"raw trips lack the columns {absent}")
    return present


def conform(raw: DataFrame) -> DataFrame:
    """Bronze schema of a raw trip frame.

    Columns are matched without regard to case and cast to their bronze type, values that do not fit it to
    NULL; absent optional columns become typed NULLs; columns of other names are kept behind them.
    """
    present, wanted = _present(raw), ddl_columns(BRONZE_DDL)
    known = {name.lower() for name, _ in wanted}
    columns = [
        (raw[present[name.lower()]].try_cast(kind) if name.lower() in present else F.lit(None).cast(kind)).alias(name)
        for name, kind in wanted
    ]
    return raw.select(*columns, *(name for name in raw.columns if name.lower() not in known))


def lost_in_conforming(raw: DataFrame) -> dict[str, Column]:
    """For each text column that :func:`conform` casts, whether a row's value becomes NULL in that."""
    present, kinds = _present(raw), dict(raw.dtypes)
    out = {}
    for name, kind in ddl_columns(BRONZE_DDL):
        held = present.get(name.lower())
        if held is not None and kinds[held] == "string" and kind.lower() != "string":
            out[name] = raw[held].isNotNull() & raw[held].try_cast(kind).isNull()
    return out
