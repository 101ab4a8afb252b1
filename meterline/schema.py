"""Column lists, types and per-column rules of the trip layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: column names, types and value rules of the trip data model -------------

BRONZE_DDL = """
    VendorID INT,
    tpep_pickup_datetime TIMESTAMP_NTZ,
    tpep_dropoff_datetime TIMESTAMP_NTZ,
    passenger_count BIGINT,
    trip_distance DOUBLE,
    RatecodeID BIGINT,
    store_and_fwd_flag STRING,
    PULocationID STRING,
    DOLocationID STRING,
    payment_type BIGINT,
    fare_amount DOUBLE,
    extra DOUBLE,
    mta_tax DOUBLE,
    tip_amount DOUBLE,
    tolls_amount DOUBLE,
    improvement_surcharge DOUBLE,
    total_amount DOUBLE,
    congestion_surcharge DOUBLE,
    Airport_fee DOUBLE,
    cbd_congestion_fee DOUBLE
"""

SILVER_DDL = BRONZE_DDL.rstrip() + ",\n    trip_duration_min DOUBLE\n"

# name, type, may be null, inclusive range, allowed values
GOLD_RULES = (
    ("route_id", "string", False, None, None),
    ("DOLocationID", "string", True, (1, 265), None),
    ("PULocationID", "string", True, (1, 265), None),
    ("VendorID", "integer", True, None, (1, 2)),
    ("tpep_pickup_datetime", "timestamp_ntz", True, None, None),
    ("passenger_count", "long", False, (1, 9), None),
    ("trip_distance", "double", True, (0.0, 60.0), None),
    ("RatecodeID", "long", False, (1, 6), None),
    ("store_and_fwd_flag", "string", False, None, ("Y", "N")),
    ("payment_type", "long", True, (1, 6), None),
    ("fare_amount", "double", True, (0.0, 500.0), None),
    ("extra", "double", True, (0.0, 100.0), None),
    ("mta_tax", "double", True, (0.0, 10.0), None),
    ("tip_amount", "double", True, (0.0, 1000.0), None),
    ("tolls_amount", "double", True, (0.0, 100.0), None),
    ("improvement_surcharge", "double", True, (0.0, 10.0), None),
    ("congestion_surcharge", "double", False, (0.0, 10.0), None),
    ("Airport_fee", "double", False, (0.0, 10.0), None),
    ("cbd_congestion_fee", "double", True, (0.0, 10.0), None),
    ("trip_duration_min", "double", True, (0.0, 180.0), None),
    ("pickup_hour", "integer", True, (0, 23), None),
    ("pickup_day_of_week", "integer", True, (0, 6), None),
    ("pickup_day_of_month", "integer", True, (1, 31), None),
    ("pickup_week_of_year", "integer", True, (1, 53), None),
    ("pickup_month", "integer", True, (1, 12), None),
    ("pickup_year", "integer", True, (2020, 2030), None),
    ("is_weekend", "boolean", True, None, None),
    ("is_peak_hour", "boolean", True, None, None),
    ("is_night", "boolean", True, None, None),
    ("is_rush_hour", "boolean", True, None, None),
    ("sin_hour", "double", True, (-1.0, 1.0), None),
    ("cos_hour", "double", True, (-1.0, 1.0), None),
    ("sin_day_of_week", "double", True, (-1.0, 1.0), None),
    ("cos_day_of_week", "double", True, (-1.0, 1.0), None),
    ("is_short_trip", "boolean", True, None, None),
    ("is_long_trip", "boolean", True, None, None),
    ("log_trip_distance", "double", True, (0.0, 5.0), None),
    ("sqrt_trip_distance", "double", True, (0.0, 10.0), None),
    ("fare_per_mile", "double", True, (0.0, 100.0), None),
    ("surcharge_ratio", "double", True, (0.0, 1.0), None),
    ("toll_ratio", "double", True, (0.0, 1.0), None),
    ("has_tolls", "integer", False, None, (0, 1)),
    ("has_airport_fee", "integer", False, None, (0, 1)),
    ("has_congestion_fee", "integer", False, None, (0, 1)),
    ("non_fare_amount", "double", True, (-100.0, 1000.0), None),
    ("is_same_zone", "boolean", True, None, None),
    ("pickup_zone_trip_count", "long", True, (0, 1000000), None),
    ("dropoff_zone_trip_count", "long", True, (0, 1000000), None),
    ("route_trip_count", "long", True, (0, 1000000), None),
)

# columns every cleaned trip must have, and the fill value of each optional one
CRITICAL = ("tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID")
FILL_VALUES = {
    "passenger_count": 1,
    "RatecodeID": 1,
    "congestion_surcharge": 0,
    "Airport_fee": 0,
    "store_and_fwd_flag": "N",
}

# --- end of fixed values -------------------------------------------------------------------

SPARK_TYPES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}

# types a column of a declared type may have
ACCEPTED_TYPES = {
    "string": (T.StringType,),
    "integer": (T.IntegerType,),
    "long": (T.LongType,),
    "double": (T.DoubleType, T.FloatType),
    "boolean": (T.BooleanType,),
    "timestamp_ntz": (T.TimestampNTZType, T.TimestampType),
    "timestamp": (T.TimestampType, T.TimestampNTZType),
}

MONTH_KEYS = ("year", "month")
LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class ColumnRule:
    """What one column of a layer must look like."""

    name: str
    type: str
    nullable: bool = True
    valid_range: tuple[float, float] | None = None
    valid_values: tuple | None = None


def spark_type(name: str) -> T.DataType:
    """Spark type of a declared type name; an unknown name is a string."""
    return SPARK_TYPES.get(name.lower(), T.StringType())


def ddl_columns(ddl: str) -> list[tuple[str, str]]:
    """``[(column, SQL type), …]`` of a layer DDL."""
    return [tuple(part.split()) for part in ddl.split(",")]


BRONZE_COLUMNS = [name for name, _ in ddl_columns(BRONZE_DDL)]
SILVER_COLUMNS = [name for name, _ in ddl_columns(SILVER_DDL)]
GOLD_COLUMNS = [rule[0] for rule in GOLD_RULES]


def gold_ddl() -> str:
    return ", ".join(f"{name} {spark_type(kind).simpleString()}" for name, kind, *_ in GOLD_RULES)


def layer_ddl(layer: str) -> str:
    """Declared columns of a layer, without its partition columns."""
    return {"bronze": BRONZE_DDL, "silver": SILVER_DDL, "gold": gold_ddl()}[layer]


def stored_ddl(layer: str) -> str:
    """Declared columns of a layer as it is stored, partition columns last."""
    return f"{layer_ddl(layer)}, {MONTH_KEYS[0]} INT, {MONTH_KEYS[1]} INT"


def rules_for(layer: str) -> tuple[ColumnRule, ...]:
    """Column rules of a layer.

    Gold carries the full dictionary. Bronze and silver reuse the rules of the columns they
    share with it, plus the two columns gold drops; bronze may hold nulls that cleaning fills.
    """
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
    gold = {name: ColumnRule(name, *rest) for name, *rest in GOLD_RULES}
    if layer == "gold":
        return tuple(gold.values())
    extra = {
        "tpep_dropoff_datetime": ColumnRule("tpep_dropoff_datetime", "timestamp_ntz"),
        "total_amount": ColumnRule("total_amount", "double"),
    }
    names = BRONZE_COLUMNS if layer == "bronze" else SILVER_COLUMNS
    rules = [gold.get(name) or extra[name] for name in names]
    if layer == "bronze":
        rules = [ColumnRule(r.name, r.type, True, r.valid_range, r.valid_values) for r in rules]
    return tuple(rules)
