"""Queries for sources, cleaning and feature operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators import clean as c
from meterline.operators import features as f
from meterline.operators import marts
from meterline.operators.lookup import broadcast_if_small
from meterline.plans.reports import busiest_pickups
from meterline.plans.stages import build_gold, build_layers, build_silver
from meterline.schema import BRONZE_COLUMNS, GOLD_COLUMNS
from meterline.settings import WRITE_SETTINGS, CleaningLimits, FeatureGroups, JoinBounds, WriteOptions, tuned
from meterline.sources import sinks
from meterline.sources.layers import (
    land_bronze,
    land_files,
    landed,
    listed_files,
    layer_exists,
    read_layer,
    read_parquet,
    require_rows,
    scan_counts,
    write_layer,
)
from meterline.sources.scratch import scratch_path
from meterline.sources.tables import create_tables, refresh_partitions, table_summary
from meterline.sources.trips import trips_view
from meterline.suite import oracle as o
from meterline.suite.frames import (
    MONTH,
    YEAR,
    Entry,
    bronze,
    empty_lake,
    full_gold,
    gold,
    rounded,
    silver,
    single,
    stored_lake,
)

ENTRIES: dict[str, Entry] = {}


def entry(name: str, sql: str | None = None):
    def register(run):
        ENTRIES[name] = Entry(run, sql)
        return run

    return register


def month_counts(df: DataFrame, *more) -> DataFrame:
    return df.groupBy("year", "month").agg(F.count("*").alias("trip_count"), *more)


# --- sources, sinks, tables ----------------------------------------------------------------------


@entry("s00_trips_view", o.over_bronze(f"SELECT {o.BRONZE_LIST} FROM bronze"))
def s00(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_view(spark, sf_dir)


@entry(
    "s01_parquet_scan",
    o.over_bronze(
        "SELECT year, count(*) AS trip_count,"
        " count(CASE WHEN year >= 1998 THEN cbd_congestion_fee END) AS with_cbd_fee FROM bronze GROUP BY year"
    ),
)
def s01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders of different schema, read as one: the older one has no cbd_congestion_fee."""
    trips, base = bronze(spark, sf_dir), scratch_path(spark, "scan")
    older = sinks.write_as(trips.where(F.col("year") < YEAR).drop("cbd_congestion_fee"), f"{base}/older")
    newer = sinks.write_as(trips.where(F.col("year") >= YEAR), f"{base}/newer")
    merged = read_parquet(spark, [older, newer])
    return merged.groupBy("year").agg(
        F.count("*").alias("trip_count"), F.count("cbd_congestion_fee").alias("with_cbd_fee")
    )


@entry(
    "s02_month_selection",
    o.over_bronze(
        "SELECT year, month, count(*) AS trip_count, CAST(sum(passenger_count) AS BIGINT) AS passengers"
        f" FROM bronze WHERE year = {YEAR} AND month IN (1, 2) GROUP BY ALL"
    ),
)
def s02(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = read_layer(spark, stored_lake(spark, sf_dir, "bronze").layer("bronze"), YEAR, [1, 2])
    return month_counts(chosen, F.sum("passenger_count").alias("passengers"))


@entry(
    "s03_wildcard_scan",
    o.over_silver(
        f"SELECT 'month' AS scan, count(*) AS trip_count FROM silver WHERE year = {YEAR} AND month = {MONTH}"
        " UNION ALL SELECT 'all', count(*) FROM silver UNION ALL SELECT 'merged', count(*) FROM silver"
    ),
)
def s03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_counts(spark, stored_lake(spark, sf_dir).layer("gold"), YEAR, MONTH)


@entry(
    "s04_layer_write",
    o.over_silver(
        "SELECT year, month, count(*) AS trip_count, round(sum(fare_amount), 6) AS fares FROM silver GROUP BY ALL"
    ),
)
def s04(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = write_layer(silver(spark, sf_dir), scratch_path(spark, "silver"), WriteOptions(files=4))
    return month_counts(read_layer(spark, root), F.round(F.sum("fare_amount"), 6).alias("fares"))


@entry(
    "s05_month_overwrite",
    o.over_silver(
        "SELECT year, month, count(*) AS trip_count FROM silver"
        f" WHERE NOT (year = {YEAR} AND month = {MONTH}) OR trip_distance < 10 GROUP BY ALL"
    ),
)
def s05(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writing one month again replaces that month and no other."""
    trips = silver(spark, sf_dir)
    root = write_layer(trips, scratch_path(spark, "silver"), rebalance=True)
    one_month = (F.col("year") == YEAR) & (F.col("month") == MONTH)
    write_layer(trips.where(one_month & (F.col("trip_distance") < 10)), root)
    return month_counts(read_layer(spark, root))


@entry(
    "s05_month_emptied",
    o.over_silver(
        f"SELECT year, month, count(*) AS trip_count FROM silver WHERE NOT (year = {YEAR} AND month = {MONTH}) GROUP BY ALL"
    ),
)
def s05_emptied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month rebuilt under limits that no trip meets is left without rows, and no other month is touched."""
    lake = empty_lake(spark)
    land_bronze(spark, trips_view(spark, sf_dir), lake.layer("bronze"))
    build_silver(spark, lake)
    build_silver(spark, lake, YEAR, [MONTH], CleaningLimits(max_trip_distance=-1.0))
    return month_counts(read_layer(spark, lake.layer("silver")))


def registered(spark: SparkSession, sf_dir: str) -> list[str]:
    lake = stored_lake(spark, sf_dir)
    return create_tables(spark, {layer: lake.layer(layer) for layer in ("bronze", "silver", "gold")})


@entry(
    "s06_layer_tables",
    o.over_silver(
        "SELECT 'bronze' AS layer, year, count(*) AS trip_count FROM bronze GROUP BY ALL"
        " UNION ALL SELECT 'silver', year, count(*) FROM silver GROUP BY ALL"
        " UNION ALL SELECT 'gold', year, count(*) FROM silver GROUP BY ALL"
    ),
)
def s06(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the three layer tables."""
    names = registered(spark, sf_dir)
    refresh_partitions(spark, names)
    return spark.sql(
        " UNION ALL ".join(
            f"SELECT '{layer}' AS layer, year, count(*) AS trip_count FROM trips.{layer}_trips GROUP BY year"
            for layer in ("bronze", "silver", "gold")
        )
    )


@entry(
    "s07_partition_refresh",
    o.over_silver(
        "SELECT 'trips.bronze_trips' AS table_name, 'year=' || year || '/month=' || month AS partition"
        " FROM bronze GROUP BY year, month UNION ALL"
        " SELECT 'trips.silver_trips', 'year=' || year || '/month=' || month FROM silver GROUP BY year, month"
        " UNION ALL"
        " SELECT 'trips.gold_trips', 'year=' || year || '/month=' || month FROM silver GROUP BY year, month"
    ),
)
def s07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refresh_partitions(spark, registered(spark, sf_dir))


@entry(
    "s08_table_summary",
    o.over_silver(
        "SELECT 'bronze_trips' AS table_name, CAST(22 AS INT) AS column_count, count(*) AS trip_count FROM bronze"
        " UNION ALL SELECT 'silver_trips', CAST(23 AS INT), count(*) FROM silver"
        " UNION ALL SELECT 'gold_trips', CAST(51 AS INT), count(*) FROM silver"
    ),
)
def s08(spark: SparkSession, sf_dir: str) -> DataFrame:
    refresh_partitions(spark, registered(spark, sf_dir))
    return table_summary(spark)


@entry(
    "s09_mart_sink",
    o.over_features(
        f"SELECT pickup_hour, is_weekend, is_rush_hour, trip_count,"
        f" {o.single('avg_duration_min', 'avg_fare_per_mile')} FROM hourly",
        o.HOURLY,
    ),
)
def s09(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart written to its sink and read back; without a JDBC url the sink is parquet."""
    path = sinks.write_mart(
        marts.hourly_patterns(gold(spark, sf_dir)), marts.MART_TABLES["hourly"], scratch_path(spark, "marts")
    )
    return single(spark.read.parquet(path), "avg_duration_min", "avg_fare_per_mile")


BUSIEST_SQL = (
    "SELECT PULocationID AS location_id, pickup_count, round(avg_distance_from_zone, 2) AS avg_distance,"
    " round(avg_fare_from_zone, 2) AS avg_fare FROM pickup ORDER BY pickup_count DESC, PULocationID LIMIT 10"
)


@entry("s10_csv_sink", o.over_features(BUSIEST_SQL, o.PICKUP))
def s10(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = busiest_pickups(marts.pickup_stats(gold(spark, sf_dir)))
    path = sinks.write_csv(result, scratch_path(spark, "csv"))
    return spark.read.schema(result.schema).option("header", True).csv(path)


@entry(
    "s11_generic_sink",
    o.over_silver(
        "SELECT year, month, count(*) AS trip_count, round(sum(total_amount), 6) AS totals FROM silver GROUP BY ALL"
    ),
)
def s11(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.write_as(silver(spark, sf_dir), scratch_path(spark, "orc"), "orc")
    return month_counts(
        spark.read.orc(path), F.round(F.sum("total_amount"), 6).alias("totals")
    )


@entry(
    "s13_land_bronze",
    o.over_bronze(
        "SELECT year, month, count(*) AS trip_count, count(*) AS landed FROM bronze GROUP BY ALL"
    ),
)
def s13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources that share months, the first of them offered twice; beside each count what was noted."""
    root, raw = empty_lake(spark).layer("bronze"), trips_view(spark, sf_dir)
    early = (F.year("tpep_pickup_datetime") < YEAR) & (F.col("trip_distance") < 10)
    for name, part in (("first", raw.where(early)), ("first", raw.where(early)), ("second", raw.where(~early))):
        land_bronze(spark, part, root, source=name)
    notes = landed(spark, root).groupBy("year", "month").agg(F.sum("rows").alias("landed"))
    return month_counts(read_layer(spark, root)).join(notes, ["year", "month"])


def shipped(spark: SparkSession, sf_dir: str, part: int) -> DataFrame:
    """Every third nominal month of shipping; trips without one are in the first part.

    The month is told from the stored column, so that no trip is computed for a part it is not in.
    """
    nominal = F.coalesce(F.month(F.date_add("l_shipdate", 3)) % 3, F.lit(0))
    return trips_view(spark, sf_dir, keep=("l_shipdate",)).where(nominal == part).drop("l_shipdate")


@entry(
    "s13_land_stray_months",
    o.over_bronze("SELECT year, month, count(*) AS trip_count, round(sum(fare_amount), 6) AS fares FROM bronze GROUP BY ALL"),
)
def s13_stray(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by ship month, whose pickups may lie in another month, landed one after the other, and again."""
    root, raw = empty_lake(spark).layer("bronze"), scratch_path(spark, "raw")
    for part in range(3):
        sinks.write_as(shipped(spark, sf_dir, part), raw, mode="append")
        land_files(spark, raw, root)
    land_files(spark, raw, root)
    return month_counts(read_layer(spark, root), F.round(F.sum("fare_amount"), 6).alias("fares"))


MONTHS_AND_FARES = o.over_bronze("SELECT year, month, count(*) AS trip_count, round(sum(fare_amount), 6) AS fares FROM bronze GROUP BY ALL")


@entry("s13_land_nested", MONTHS_AND_FARES)
def s13_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files under plain YYYY/MM folders, in two schemas, landed in two runs."""
    root, raw = empty_lake(spark).layer("bronze"), scratch_path(spark, "raw")
    trips = trips_view(spark, sf_dir)
    for part, folder in enumerate(("1996/01", "1996/02", "1997/01")):
        some = trips.where(F.pmod(F.hash("tpep_pickup_datetime", "fare_amount"), F.lit(3)) == part)
        if part == 1:
            some = some.withColumn("passenger_count", F.col("passenger_count").cast("double")).withColumnRenamed("extra", "EXTRA")
        sinks.write_as(some, f"{raw}/{folder}", mode="append")
        if part:
            land_files(spark, raw, root)
    return month_counts(read_layer(spark, root), F.round(F.sum("fare_amount"), 6).alias("fares"))


@entry("s13_land_same_names", MONTHS_AND_FARES)
def s13_same_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the same names in partition folders: each is a source of its own."""
    root, raw = empty_lake(spark).layer("bronze"), scratch_path(spark, "raw")
    trips = trips_view(spark, sf_dir).withColumn("part", F.pmod(F.hash("tpep_pickup_datetime"), F.lit(4)))
    # a task writes its rows of every folder under one file name
    with tuned(spark, WRITE_SETTINGS):
        trips.write.partitionBy("part").parquet(raw)
    names = [row.path.rsplit("/", 1)[-1] for row in listed_files(spark, raw, recursive=True).select("path").collect()]
    assert len(names) > len(set(names))
    land_files(spark, raw, root)
    return month_counts(read_layer(spark, root), F.round(F.sum("fare_amount"), 6).alias("fares"))


@entry(
    "s03_drifting_types",
    o.over_bronze("SELECT year, count(*) AS trip_count, sum(CAST(passenger_count AS DOUBLE)) AS passengers FROM bronze GROUP BY ALL"),
)
def s03_drifting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer whose halves differ in the type of passenger_count, read with merged schemas."""
    root, trips = scratch_path(spark, "drifting"), bronze(spark, sf_dir)
    early = F.col("year") < YEAR
    write_layer(trips.where(early).withColumn("passenger_count", F.col("passenger_count").cast("int")), root, rebalance=True)
    write_layer(trips.where(~early).withColumn("passenger_count", F.col("passenger_count").cast("double")), root, rebalance=True)
    merged = read_layer(spark, root, merge=True)
    return merged.groupBy("year").agg(F.count("*").alias("trip_count"), F.sum("passenger_count").alias("passengers"))


@entry(
    "s14_empty_guard",
    o.over_silver(
        "SELECT 1998 AS year, count(*) > 0 AS has_rows FROM silver WHERE year = 1998"
        " UNION ALL SELECT 2025, count(*) > 0 FROM silver WHERE year = 2025"
    ),
)
def s14(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = stored_lake(spark, sf_dir).layer("gold")
    assert layer_exists(spark, root)
    found = [(year, require_rows(read_layer(spark, root, year)) is not None) for year in (YEAR, 2025)]
    return spark.createDataFrame(found, "year int, has_rows boolean")


# --- cleaning ------------------------------------------------------------------------------------


def timed_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.add_duration(bronze(spark, sf_dir))


@entry(
    "c01_trip_duration",
    o.over_bronze("SELECT tpep_pickup_datetime, tpep_dropoff_datetime, trip_duration_min FROM bronze"),
)
def c01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed_bronze(spark, sf_dir).select("tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_duration_min")


@entry(
    "c02_tolerant_projection",
    o.over_bronze(
        f"SELECT {o.listed(n for n in BRONZE_COLUMNS if n != 'cbd_congestion_fee')}, trip_duration_min FROM bronze"
    ),
)
def c02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input with a column too many and one too few."""
    odd = timed_bronze(spark, sf_dir).drop("cbd_congestion_fee").withColumn("unknown", F.lit(1))
    return c.keep_known_columns(odd, keep=())


FILTER_COLUMNS = ("tpep_pickup_datetime", "trip_duration_min", "trip_distance", "fare_amount", "total_amount")


@entry("c03_duration_filter", o.over_bronze(f"SELECT {o.listed(FILTER_COLUMNS)} FROM bronze WHERE {o.DURATION_OK}"))
def c03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.keep_valid_durations(timed_bronze(spark, sf_dir)).select(*FILTER_COLUMNS)


@entry("c04_distance_filter", o.over_bronze(f"SELECT {o.listed(FILTER_COLUMNS)} FROM bronze WHERE {o.DISTANCE_OK}"))
def c04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.keep_valid_distances(timed_bronze(spark, sf_dir)).select(*FILTER_COLUMNS)


@entry("c05_money_filter", o.over_bronze(f"SELECT {o.listed(FILTER_COLUMNS)} FROM bronze WHERE {o.MONEY_OK}"))
def c05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.keep_valid_money(timed_bronze(spark, sf_dir)).select(*FILTER_COLUMNS)


@entry(
    "c06_critical_filter",
    o.over_bronze(
        "SELECT tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID FROM bronze"
        f" WHERE {o.COMPLETE}"
    ),
)
def c06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.keep_complete(bronze(spark, sf_dir)).select(
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID"
    )


@entry("c07_imputation", o.over_bronze(f"SELECT {o.BRONZE_LIST} FROM (SELECT {o.FILLED} FROM bronze)"))
def c07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.fill_missing(trips_view(spark, sf_dir))


@entry(
    "c08_clip_rate_code",
    o.over_bronze(
        "SELECT tpep_pickup_datetime, CASE WHEN r < 1 THEN 1 WHEN r > 6 THEN 6 ELSE r END AS RatecodeID"
        " FROM (SELECT tpep_pickup_datetime, coalesce(RatecodeID, 1) AS r FROM bronze)"
    ),
)
def c08(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = c.fill_missing(trips_view(spark, sf_dir))
    return c.clip_rate_code(filled).select("tpep_pickup_datetime", "RatecodeID")


@entry(
    "c09_clip_tip",
    o.over_bronze(
        "SELECT tpep_pickup_datetime, fare_amount, CASE WHEN tip_amount < 0 THEN 0e0"
        " WHEN tip_amount > fare_amount * 2e0 THEN fare_amount * 2e0 ELSE tip_amount END AS tip_amount FROM bronze"
    ),
)
def c09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.clip_tip(trips_view(spark, sf_dir)).select("tpep_pickup_datetime", "fare_amount", "tip_amount")


@entry("c10_clean", o.over_silver(f"SELECT {o.SILVER_LIST} FROM silver"))
def c10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.clean(trips_view(spark, sf_dir))


TIGHT = CleaningLimits(5.0, 90.0, 1.0, 30.0, 10.0, 200.0, 20.0, 1.0)


@entry(
    "c11_thresholds",
    f"WITH {o.BRONZE}, filled AS (SELECT {o.FILLED} FROM bronze WHERE {o.COMPLETE}"
    " AND trip_duration_min > 5 AND trip_duration_min < 90 AND trip_distance > 1 AND trip_distance < 30"
    " AND fare_amount > 10 AND fare_amount < 200 AND total_amount >= 20),"
    f" silver AS (SELECT {o.clipped('1e0')} FROM filled) SELECT {o.SILVER_LIST} FROM silver",
)
def c11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.clean(trips_view(spark, sf_dir), TIGHT)


@entry("c12_silver_stage", o.over_silver(f"SELECT {o.SILVER_LIST}, year, month FROM silver"))
def c12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored bronze to stored silver."""
    lake = empty_lake(spark)
    land_bronze(spark, trips_view(spark, sf_dir), lake.layer("bronze"))
    build_silver(spark, lake)
    return read_layer(spark, lake.layer("silver"))


# --- features ------------------------------------------------------------------------------------

FEATURE_OF = {
    "f01_pickup_hour": ("pickup_hour",),
    "f02_pickup_day_of_week": ("pickup_day_of_week",),
    "f03_pickup_day_of_month": ("pickup_day_of_month",),
    "f04_pickup_week_of_year": ("pickup_week_of_year",),
    "f05_pickup_month": ("pickup_month",),
    "f06_pickup_year": ("pickup_year",),
    "f07_is_weekend": ("is_weekend",),
    "f08_is_peak_hour": ("is_peak_hour",),
    "f09_is_night": ("is_night",),
    "f10_is_rush_hour": ("is_rush_hour",),
    "f11_cyclic_hour": ("sin_hour", "cos_hour"),
    "f12_cyclic_day_of_week": ("sin_day_of_week", "cos_day_of_week"),
    "f13_short_long_trip": ("is_short_trip", "is_long_trip"),
    "f14_log_trip_distance": ("log_trip_distance",),
    "f15_sqrt_trip_distance": ("sqrt_trip_distance",),
    "f16_fare_per_mile": ("fare_per_mile",),
    "f17_surcharge_ratio": ("surcharge_ratio",),
    "f18_toll_ratio": ("toll_ratio",),
    "f19a_has_tolls": ("has_tolls",),
    "f19b_has_airport_fee": ("has_airport_fee",),
    "f19c_has_congestion_fee": ("has_congestion_fee",),
    "f19d_non_fare_amount": ("non_fare_amount",),
    "f21_route_id": ("route_id",),
    "f22_is_same_zone": ("is_same_zone",),
}
TRANSCENDENTAL = ("sin_hour", "cos_hour", "sin_day_of_week", "cos_day_of_week", "log_trip_distance")


def steady(df: DataFrame) -> DataFrame:
    """Round the columns whose last bits depend on the maths library."""
    return rounded(df, *[name for name in TRANSCENDENTAL if name in df.columns], digits=9)


def feature_query(names: tuple[str, ...]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return steady(gold(spark, sf_dir).select("tpep_pickup_datetime", "trip_distance", "fare_amount", *names))

    return run


for _name, _columns in FEATURE_OF.items():
    ENTRIES[_name] = Entry(
        feature_query(_columns),
        o.over_features(
            f"SELECT tpep_pickup_datetime, trip_distance, fare_amount, {o.listed(_columns)} FROM gold_base"
        ),
    )


@entry(
    "f20_zone_normalise",
    o.over_bronze(
        "SELECT tpep_pickup_datetime, PULocationID, CASE WHEN l_linenumber = 7 THEN NULL ELSE DOLocationID END"
        " AS DOLocationID FROM bronze"
    ),
)
def f20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero-padded, decimal and non-numeric spellings of the zones."""
    line = F.col("l_linenumber")
    spelled = (
        F.when(line == 7, F.concat(F.lit("x"), "DOLocationID"))
        .when(line % 2 == 0, F.concat("DOLocationID", F.lit(".0")))
        .otherwise(F.concat(F.lit(" "), "DOLocationID"))
    )
    trips = trips_view(spark, sf_dir, keep=("l_linenumber",)).withColumns(
        {"PULocationID": F.concat(F.lit("00"), "PULocationID"), "DOLocationID": spelled}
    )
    return f.normalise_zones(trips).select("tpep_pickup_datetime", "PULocationID", "DOLocationID")


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).transform(f.normalise_zones).transform(f.add_route)


def frequency_query(column: str, scope: tuple[str, ...], bounds: JoinBounds = JoinBounds()):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        counted = f.add_frequencies(located(spark, sf_dir), scope, bounds, only=(column,))
        return counted.select("tpep_pickup_datetime", "route_id", "fare_amount", column)

    return run


for _id, _column in (
    ("f23", "pickup_zone_trip_count"),
    ("f24", "dropoff_zone_trip_count"),
    ("f25", "route_trip_count"),
):
    _sql = f"SELECT tpep_pickup_datetime, route_id, fare_amount, {_column} FROM gold_wide"
    ENTRIES[f"{_id}_{_column}"] = Entry(frequency_query(_column, ("year", "month")), o.over_gold(_sql))
    ENTRIES[f"{_id}_{_column}_whole_input"] = Entry(frequency_query(_column, ()), o.over_gold(_sql, scope=""))

ENTRIES["f25_route_trip_count_shuffled"] = Entry(
    frequency_query("route_trip_count", ("year", "month"), JoinBounds(broadcast_rows=0, hot_keys=5000, salts=16)),
    o.over_gold("SELECT tpep_pickup_datetime, route_id, fare_amount, route_trip_count FROM gold_wide"),
)


@entry(
    "f26_final_projection",
    o.over_features("SELECT tpep_pickup_datetime, trip_distance, has_tolls, route_id, year, month FROM gold_base"),
)
def f26(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = located(spark, sf_dir).transform(f.add_flag_features)
    narrow = f.gold_projection(wide)
    assert not {"tpep_dropoff_datetime", "total_amount"} & set(narrow.columns)
    return narrow.select("tpep_pickup_datetime", "trip_distance", "has_tolls", "route_id", "year", "month")


@entry(
    "f27_feature_groups",
    o.over_features(
        f"SELECT {o.listed(n for n in GOLD_COLUMNS[:20] if n != 'route_id')}, fare_per_mile, surcharge_ratio,"
        " toll_ratio FROM gold_base"
    ),
)
def f27(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the ratio group switched on; zones keep their raw form."""
    groups = FeatureGroups(time=False, distance=False, flags=False, location=False)
    return f.add_features(silver(spark, sf_dir), groups, keep=())


@entry("f28_features", o.over_gold(f"SELECT {o.GOLD_LIST} FROM gold_wide"))
def f28(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steady(full_gold(spark, sf_dir).select(*GOLD_COLUMNS))


@entry("f29_gold_stage", o.over_gold(f"SELECT {o.GOLD_LIST}, year, month FROM gold_wide"))
def f29(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored silver to stored gold."""
    lake = empty_lake(spark)
    write_layer(silver(spark, sf_dir), lake.layer("silver"), rebalance=True)
    build_gold(spark, lake)
    return steady(read_layer(spark, lake.layer("gold")))


@entry(
    "j01_broadcast_lookup",
    o.over_features(
        "SELECT g.route_id, g.fare_amount, p.pickup_count FROM gold_base g LEFT JOIN pickup p USING (PULocationID)",
        o.PICKUP,
    ),
)
def j01(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = gold(spark, sf_dir)
    zones = marts.pickup_stats(trips).select("PULocationID", "pickup_count")
    zones = broadcast_if_small(zones, zones.count())
    return trips.join(zones, "PULocationID", "left").select("route_id", "fare_amount", "pickup_count")


@entry("p11_layers", o.over_gold(f"SELECT {o.GOLD_LIST} FROM gold_wide"))
def p11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze to silver to gold on disk, then gold read back."""
    lake = empty_lake(spark)
    land_bronze(spark, trips_view(spark, sf_dir), lake.layer("bronze"))
    _, stored = build_layers(spark, lake)
    return steady(read_layer(spark, stored).select(*GOLD_COLUMNS))

