"""Queries for marts and BI reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterline.operators import features as f
from meterline.operators import marts as m
from meterline.plans import reports as r
from meterline.plans.stages import export_marts
from meterline.schema import GOLD_COLUMNS
from meterline.sources.layers import read_layer
from meterline.sources.scratch import scratch_path
from meterline.suite import oracle as o
from meterline.suite.frames import MONTH, YEAR, Entry, bronze, gold, rounded, silver, single, stored_lake

ENTRIES: dict[str, Entry] = {}


def entry(name: str, sql: str | None = None):
    def register(run):
        ENTRIES[name] = Entry(run, sql)
        return run

    return register


def timed_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with time features: what queries on the total amount read."""
    return f.add_time_features(silver(spark, sf_dir), cyclic=False)


DAILY_SQL = (
    "SELECT pickup_year, pickup_month, pickup_day_of_month, trip_count,"
    f" {o.single('avg_duration_min', 'avg_distance', 'avg_fare')}, {o.rounded('total_revenue')} FROM daily"
)
HOURLY_SQL = (
    "SELECT pickup_hour, is_weekend, is_rush_hour, trip_count,"
    f" {o.single('avg_duration_min', 'avg_fare_per_mile')} FROM hourly"
)
PICKUP_SQL = (
    f"SELECT PULocationID, pickup_count, {o.single('avg_distance_from_zone', 'avg_fare_from_zone')} FROM pickup"
)


@entry("m01_daily_summary", o.over_features(DAILY_SQL, o.DAILY))
def m01(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = m.daily_summary(gold(spark, sf_dir))
    return single(rounded(daily, "total_revenue"), "avg_duration_min", "avg_distance", "avg_fare")


@entry("m02_hourly_patterns", o.over_features(HOURLY_SQL, o.HOURLY))
def m02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single(m.hourly_patterns(gold(spark, sf_dir)), "avg_duration_min", "avg_fare_per_mile")


@entry("m03_pickup_stats", o.over_features(PICKUP_SQL, o.PICKUP))
def m03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single(m.pickup_stats(gold(spark, sf_dir)), "avg_distance_from_zone", "avg_fare_from_zone")


RECENT_SQL = (
    f"SELECT {o.listed(m.RECENT_COLUMNS)} FROM gold_base ORDER BY "
    + ", ".join(f"{name} DESC NULLS LAST" for name in m.RECENT_COLUMNS)
    + " LIMIT 1000"
)


@entry("m04_recent_trips", o.over_features(RECENT_SQL))
def m04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.recent_trips(gold(spark, sf_dir))


@entry(
    "m05_daily_totals",
    o.over_features(
        "SELECT pickup_year, pickup_month, pickup_day_of_month, CAST(CAST(avg(trip_duration_min) AS FLOAT) AS DOUBLE) AS trip_duration_min,"
        " CAST(CAST(avg(trip_distance) AS FLOAT) AS DOUBLE) AS trip_distance, CAST(CAST(avg(fare_amount) AS FLOAT) AS DOUBLE) AS fare_amount,"
        " round(sum(total_amount), 6) AS total_amount, count(VendorID) AS trip_count FROM gold_base GROUP BY 1, 2, 3"
    ),
)
def m05(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = m.daily_totals(timed_silver(spark, sf_dir))
    return single(rounded(daily, "total_amount"), "trip_duration_min", "trip_distance", "fare_amount")


@entry(
    "m06_hourly_means",
    o.over_features(
        "SELECT pickup_hour, is_weekend, is_rush_hour, CAST(CAST(avg(trip_duration_min) AS FLOAT) AS DOUBLE) AS trip_duration_min,"
        " CAST(CAST(avg(fare_per_mile) AS FLOAT) AS DOUBLE) AS fare_per_mile, count(VendorID) AS trip_count FROM gold_base GROUP BY 1, 2, 3"
    ),
)
def m06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single(m.hourly_means(gold(spark, sf_dir)), "trip_duration_min", "fare_per_mile")


@entry(
    "m07_pickup_means",
    o.over_features(
        "SELECT PULocationID, CAST(CAST(avg(trip_distance) AS FLOAT) AS DOUBLE) AS trip_distance, CAST(CAST(avg(fare_amount) AS FLOAT) AS DOUBLE) AS fare_amount,"
        " count(VendorID) AS pickup_count FROM gold_base GROUP BY 1"
    ),
)
def m07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single(m.pickup_means(gold(spark, sf_dir)), "trip_distance", "fare_amount")


@entry("m08_largest_pickups", o.over_features(RECENT_SQL))
def m08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.largest_pickups(gold(spark, sf_dir))


def exported(name: str):
    """A mart as written by the export of all four, read back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        paths = export_marts(gold(spark, sf_dir), scratch_path(spark, "marts"))
        frame = spark.read.parquet(paths[name])
        frame = rounded(frame, *[c for c in frame.columns if c == "total_revenue"])
        return single(frame, *[c for c in frame.columns if c.startswith("avg_")])

    return run


ENTRIES["m01_daily_summary_exported"] = Entry(exported("daily"), o.over_features(DAILY_SQL, o.DAILY))
ENTRIES["m02_hourly_patterns_exported"] = Entry(exported("hourly"), o.over_features(HOURLY_SQL, o.HOURLY))
ENTRIES["m03_pickup_stats_exported"] = Entry(exported("pickup"), o.over_features(PICKUP_SQL, o.PICKUP))


# --- BI queries ----------------------------------------------------------------------------------


@entry(
    "q01_days_of_month",
    o.over_features(
        "SELECT pickup_day_of_month AS day, trip_count, round(avg_duration_min, 2) AS avg_duration,"
        " round(avg_distance, 2) AS avg_distance, round(total_revenue, 2) AS revenue FROM daily"
        f" WHERE pickup_year = {YEAR} AND pickup_month = {MONTH} ORDER BY day LIMIT 10",
        o.DAILY,
    ),
)
def q01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.days_of_month(m.daily_summary(gold(spark, sf_dir)), YEAR, MONTH)


@entry(
    "q02_rush_hour_contrast",
    o.over_features(
        "SELECT is_rush_hour, CAST(sum(trip_count) AS BIGINT) AS total_trips,"
        " round(avg(avg_duration_min), 2) AS avg_duration, round(avg(avg_fare_per_mile), 3) AS avg_fare_per_mile"
        " FROM hourly WHERE NOT is_weekend GROUP BY is_rush_hour",
        o.HOURLY,
    ),
)
def q02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.rush_hour_contrast(m.hourly_patterns(gold(spark, sf_dir)))


@entry(
    "q03_busiest_pickups",
    o.over_features(
        "SELECT PULocationID AS location_id, pickup_count, round(avg_distance_from_zone, 2) AS avg_distance,"
        " round(avg_fare_from_zone, 2) AS avg_fare FROM pickup ORDER BY pickup_count DESC, PULocationID LIMIT 10",
        o.PICKUP,
    ),
)
def q03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.busiest_pickups(m.pickup_stats(gold(spark, sf_dir)))


@entry(
    "q04_weekend_contrast",
    o.over_features(
        "SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type,"
        " CAST(sum(trip_count) AS BIGINT) AS total_trips, round(avg(avg_duration_min), 2) AS avg_duration"
        " FROM hourly GROUP BY is_weekend",
        o.HOURLY,
    ),
)
def q04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.weekend_contrast(m.hourly_patterns(gold(spark, sf_dir)))


@entry(
    "q05_volume_by_hour",
    o.over_features(
        f"SELECT pickup_hour, count(*) AS trip_count FROM gold_base WHERE year = {YEAR} GROUP BY pickup_hour"
    ),
)
def q05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.volume_by_hour(gold(spark, sf_dir), YEAR)


@entry(
    "q06_duration_by_weekday",
    o.over_features(
        "SELECT pickup_day_of_week, CAST(CAST(avg(trip_duration_min) AS FLOAT) AS DOUBLE) AS avg_duration_min, count(*) AS trip_count"
        f" FROM gold_base WHERE year = {YEAR} GROUP BY pickup_day_of_week"
    ),
)
def q06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single(r.duration_by_weekday(gold(spark, sf_dir), YEAR), "avg_duration_min")


@entry(
    "q07_revenue_by_month",
    o.over_features(
        "SELECT pickup_month, round(sum(total_amount), 6) AS total_revenue, CAST(CAST(avg(total_amount) AS FLOAT) AS DOUBLE) AS avg_fare,"
        f" count(*) AS trip_count FROM gold_base WHERE year = {YEAR} GROUP BY pickup_month"
    ),
)
def q07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single(rounded(r.revenue_by_month(timed_silver(spark, sf_dir), YEAR), "total_revenue"), "avg_fare")


@entry(
    "q08_distance_buckets",
    o.over_features(
        "SELECT CASE WHEN trip_distance < 1 THEN 'Short (<1mi)' WHEN trip_distance < 5 THEN 'Medium (1-5mi)'"
        " WHEN trip_distance < 10 THEN 'Long (5-10mi)' ELSE 'Very Long (>10mi)' END AS distance_category,"
        " CAST(CAST(avg(trip_duration_min) AS FLOAT) AS DOUBLE) AS avg_duration, CAST(CAST(avg(trip_distance) AS FLOAT) AS DOUBLE) AS avg_distance,"
        " count(*) AS trip_count FROM gold_base GROUP BY 1"
    ),
)
def q08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single(r.distance_buckets(gold(spark, sf_dir)), "avg_duration", "avg_distance")


@entry(
    "q09_popular_pickups",
    o.over_features(
        "SELECT PULocationID, count(*) AS pickup_count, CAST(CAST(avg(trip_duration_min) AS FLOAT) AS DOUBLE) AS avg_duration"
        " FROM gold_base GROUP BY PULocationID ORDER BY pickup_count DESC, PULocationID LIMIT 20"
    ),
)
def q09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single(r.popular_pickups(gold(spark, sf_dir)), "avg_duration")


@entry(
    "q10_month_volume_by_hour",
    o.over_silver(
        "SELECT CAST(hour(tpep_pickup_datetime) AS INT) AS pickup_hour, count(*) AS trip_count FROM silver"
        f" WHERE year = {YEAR} AND month = {MONTH} GROUP BY 1"
    ),
)
def q10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over stored gold, of which one partition is read."""
    return r.volume_by_hour(read_layer(spark, stored_lake(spark, sf_dir).layer("gold")), YEAR, MONTH)


@entry(
    "q11_duration_by_day_name",
    o.over_features(
        f"SELECT {o.DAY_CASE} AS day_name, CAST(CAST(avg(trip_duration_min) AS FLOAT) AS DOUBLE) AS avg_duration FROM gold_base"
        " GROUP BY pickup_day_of_week"
    ),
)
def q11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single(r.duration_by_day_name(gold(spark, sf_dir)), "avg_duration")


@entry(
    "q12_daily_view",
    o.over_features(
        "SELECT pickup_year, pickup_month, pickup_day_of_month, count(*) AS trip_count,"
        " CAST(CAST(avg(trip_duration_min) AS FLOAT) AS DOUBLE) AS avg_duration, round(sum(total_amount), 6) AS total_revenue"
        " FROM gold_base GROUP BY 1, 2, 3"
    ),
)
def q12(spark: SparkSession, sf_dir: str) -> DataFrame:
    r.daily_view(timed_silver(spark, sf_dir))
    return spark.sql(
        "SELECT pickup_year, pickup_month, pickup_day_of_month, trip_count,"
        " CAST(CAST(avg_duration AS FLOAT) AS DOUBLE) AS avg_duration, round(total_revenue, 6) AS total_revenue"
        " FROM daily_trip_summary"
    )


PLAIN_GOLD = [name for name in GOLD_COLUMNS if not name.endswith("_trip_count")]


def sample_sql(condition: str, limit: int) -> str:
    order = ", ".join(f"{name} ASC NULLS LAST" for name in (*PLAIN_GOLD, "year", "month"))
    return o.over_features(
        f"SELECT {o.listed(PLAIN_GOLD)}, year, month FROM gold_base WHERE {condition} ORDER BY {order} LIMIT {limit}"
    )


def steady(df: DataFrame) -> DataFrame:
    waves = ("sin_hour", "cos_hour", "sin_day_of_week", "cos_day_of_week", "log_trip_distance")
    return rounded(df, *waves, digits=9)


@entry("q13_month_sample", sample_sql(f"year = {YEAR} AND month = {MONTH}", 100))
def q13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steady(r.month_sample(gold(spark, sf_dir), YEAR, MONTH, ordered=True))


@entry("q13_year_sample", sample_sql(f"year = {YEAR}", 1000))
def q13_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steady(r.month_sample(gold(spark, sf_dir), YEAR, limit=1000, ordered=True))


@entry(
    "q14_layer_month_counts",
    o.over_silver(
        "SELECT 'bronze' AS layer, year, month, count(*) AS trip_count FROM bronze GROUP BY ALL"
        " UNION ALL SELECT 'silver', year, month, count(*) FROM silver GROUP BY ALL"
        " UNION ALL SELECT 'gold', year, month, count(*) FROM silver GROUP BY ALL"
    ),
)
def q14(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = {"bronze": bronze, "silver": silver, "gold": gold}
    return r.layer_month_counts({name: make(spark, sf_dir) for name, make in layers.items()})
