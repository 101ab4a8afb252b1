"""Queries for partitioned processing, stage runs and entity features."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators import entity as e
from meterline.operators import features as f
from meterline.operators import partitions as p
from meterline.operators.clean import clean
from meterline.operators.marts import DAY_KEYS, HOUR_KEYS, MART_TABLES
from meterline.plans.stages import Run, parse_months, run_months, run_silver_months, run_stages
from meterline.settings import JoinBounds, QualityLimits
from meterline.sources.layers import land_bronze, months_present, read_layer, write_layer
from meterline.sources.scratch import checkpointed, cut_lineage, scratch_path
from meterline.sources.sinks import write_as
from meterline.sources.trips import trips_view, with_months
from meterline.suite import oracle as o
from meterline.suite.business import DAILY_SQL, HOURLY_SQL, PICKUP_SQL, RECENT_SQL
from meterline.suite.frames import (
    MONTH,
    YEAR,
    Entry,
    bronze,
    empty_lake,
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


# --- partitioned processing ----------------------------------------------------------------------


@entry("p01_partition_values", o.over_silver("SELECT DISTINCT PULocationID FROM silver"))
def p01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.distinct_values(silver(spark, sf_dir), "PULocationID")


@entry(
    "p02_process_partition",
    o.over_silver(
        f"SELECT PULocationID, count(*) AS trip_count FROM silver WHERE year = {YEAR} GROUP BY PULocationID"
    ),
)
def p02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One year transformed and written on its own."""
    path = scratch_path(spark, "year")
    _, written, done, error = p.process_partition(
        bronze(spark, sf_dir), "year", YEAR, lambda df: clean(df, keep=()), path
    )
    assert done, error
    return spark.read.parquet(written).groupBy("PULocationID").agg(F.count("*").alias("trip_count"))


@entry(
    "p03_process_by_value",
    o.over_silver("SELECT PULocationID, count(*) AS trip_count FROM silver GROUP BY PULocationID"),
)
def p03(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job per year for a transform that counts, then the results of all."""
    base = scratch_path(spark, "years")
    log = p.process_by_value(
        read_layer(spark, stored_lake(spark, sf_dir, "silver").layer("silver")),
        "year",
        lambda df: df.groupBy("PULocationID").agg(F.count("*").alias("n")),
        base,
    )
    paths = [row.output_path for row in log.where("success").collect()]
    return spark.read.parquet(*paths).groupBy("PULocationID").agg(F.sum("n").alias("trip_count"))


KEPT = "trip_distance >= 10 AND NOT (month = 2)"


@entry(
    "p03_process_partitioned",
    o.over_bronze(
        "SELECT 'year=' || year || '/month=' || month AS partition_value, true AS success,"
        f" count(*) FILTER (WHERE {KEPT}) = 0 AS empty, count(*) FILTER (WHERE {KEPT}) AS trip_count"
        " FROM bronze GROUP BY year, month"
    ),
)
def p03_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row-wise transform that empties some months, in one job; its log beside what was written."""
    base = scratch_path(spark, "months")
    log = p.process_partitioned(
        bronze(spark, sf_dir), ["year", "month"], lambda df: df.where(KEPT), base, rebalance=True
    )
    value = F.format_string("year=%d/month=%d", "year", "month")
    written = spark.read.parquet(base).groupBy(value.alias("partition_value")).agg(F.count("*").alias("trip_count"))
    log = log.join(written, "partition_value", "left").fillna(0, ["trip_count"])
    return log.select("partition_value", "success", "empty", "trip_count")


@entry(
    "p04_process_by_month",
    o.over_silver("SELECT year, month, count(*) AS trip_count FROM silver GROUP BY year, month"),
)
def p04(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder YYYY/MM per month of each year."""
    base = scratch_path(spark, "monthly")
    stored = read_layer(spark, stored_lake(spark, sf_dir, "bronze").layer("bronze"))
    log = p.process_by_month(stored, clean, base, row_wise=False)
    return month_counts(spark.read.parquet(*p.written_paths(log)))


@entry(
    "p04_process_by_month_row_wise",
    o.over_silver("SELECT year, month, count(*) AS trip_count FROM silver GROUP BY year, month"),
)
def p04_row_wise(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "monthly")
    log = p.process_by_month(read_layer(spark, stored_lake(spark, sf_dir, "bronze").layer("bronze")), clean, base)
    assert log.where("NOT success").isEmpty()
    return month_counts(spark.read.parquet(base))


def month_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("year", "month").agg(F.count("*").alias("trip_count"))


@entry("p05_batches", o.over_silver("SELECT year, count(*) AS trip_count FROM silver GROUP BY year"))
def p05(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three years at a time."""
    base = scratch_path(spark, "batches")
    stored = read_layer(spark, stored_lake(spark, sf_dir, "bronze").layer("bronze"))
    log = p.process_in_batches(stored, "year", clean, base, at_once=3)
    return spark.read.parquet(*p.written_paths(log)).groupBy("year").agg(F.count("*").alias("trip_count"))


@entry(
    "p06_iterate_values",
    o.over_silver("SELECT year, PULocationID, count(*) AS trip_count FROM silver GROUP BY ALL"),
)
def p06(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = read_layer(spark, stored_lake(spark, sf_dir, "silver").layer("silver"))
    result = None
    for _, part in p.iterate_values(
        stored, "year", lambda df: df.groupBy("year", "PULocationID").agg(F.count("*").alias("trip_count"))
    ):
        result = part if result is None else result.union(part)
    return result


@entry(
    "p07_aggregate_by",
    o.over_silver(
        "SELECT PULocationID, max(trip_distance) AS longest, CAST(CAST(avg(fare_amount) AS FLOAT) AS DOUBLE) AS fare,"
        " count(VendorID) AS trips FROM silver GROUP BY PULocationID"
    ),
)
def p07(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = p.aggregate_by(
        silver(spark, sf_dir), ["PULocationID"], {"trip_distance": "max", "fare_amount": "avg", "VendorID": "count"}
    )
    return result.select(
        "PULocationID",
        F.col("max(trip_distance)").alias("longest"),
        F.col("avg(fare_amount)").cast("float").cast("double").alias("fare"),
        F.col("count(VendorID)").alias("trips"),
    )


@entry(
    "p08_months_run",
    o.over_bronze(
        "SELECT CAST(y AS INT) AS year, CAST(n AS INT) AS month,"
        " CASE WHEN (y, n) IN (SELECT (year, month) FROM bronze) THEN 'built' ELSE 'skipped' END AS status"
        " FROM (SELECT DISTINCT year AS y FROM bronze), range(1, 13) t(n)"
    ),
)
def p08(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months of all years asked for; the first and last year do not have them all."""
    lake = empty_lake(spark)
    land_bronze(spark, trips_view(spark, sf_dir), lake.layer("bronze"))
    years = sorted({row.year for row in months_present(spark, lake.layer("bronze")).collect()})
    logs = [run_silver_months(spark, lake, year, parse_months("all")) for year in years]
    return reduce(DataFrame.union, logs).drop("error")


@entry(
    "p08_months_run_with_failure",
    o.over_silver(
        f"SELECT CAST(month AS INT) AS month, 'built' AS status, count(*) AS trip_count FROM silver"
        f" WHERE year = {YEAR} AND month IN (1, 3) GROUP BY month"
        " UNION ALL SELECT 2, 'failed', NULL"
    ),
)
def p08_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month that cannot be built does not hold back the others."""
    source, lake = stored_lake(spark, sf_dir, "bronze").layer("bronze"), empty_lake(spark)

    def build(year: int, months: list[int]) -> None:
        if 2 in months:
            raise RuntimeError("bad month")
        write_layer(clean(read_layer(spark, source, year, months)), lake.layer("silver"))

    log = run_months(spark, source, YEAR, [1, 2, 3], build)
    built = read_layer(spark, lake.layer("silver")).groupBy("month").agg(F.count("*").alias("trip_count"))
    return log.select("month", "status").join(F.broadcast(built), "month", "left")


@entry("p09_repartition", o.over_silver("SELECT year, count(*) AS trip_count FROM silver GROUP BY year"))
def p09(spark: SparkSession, sf_dir: str) -> DataFrame:
    """To a number of partitions, then to the advised size by year; the rows stay the same."""
    stored = read_layer(spark, stored_lake(spark, sf_dir, "silver").layer("silver"))
    return p.rebalanced(p.rebalanced(stored, 64), None, "year").groupBy("year").agg(F.count("*").alias("trip_count"))


@entry("p10_checkpoint", o.over_silver(f"SELECT {o.SILVER_LIST} FROM silver"))
def p10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_lineage(clean(trips_view(spark, sf_dir)))[0]


MARTS_AFTER_RUN = o.over_features(
    f"""
SELECT 'daily' AS mart, concat_ws('-', pickup_year, pickup_month, pickup_day_of_month) AS key, trip_count AS trips,
  avg_duration_min AS a, avg_distance AS b, avg_fare AS c, total_revenue AS d FROM ({DAILY_SQL})
UNION ALL SELECT 'hourly', concat_ws('-', pickup_hour, is_weekend, is_rush_hour), trip_count,
  avg_duration_min, avg_fare_per_mile, NULL, NULL FROM ({HOURLY_SQL})
UNION ALL SELECT 'pickup', PULocationID, pickup_count, avg_distance_from_zone, avg_fare_from_zone, NULL, NULL
  FROM ({PICKUP_SQL})
UNION ALL SELECT 'recent', strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S'), passenger_count, trip_duration_min,
  trip_distance, fare_amount, NULL FROM ({RECENT_SQL})""",
    f"{o.DAILY}, {o.HOURLY}, {o.PICKUP}",
)


def mart_contents(spark: SparkSession, target: str) -> DataFrame:
    """All four marts below each other."""

    def read(name: str) -> DataFrame:
        frame = spark.read.parquet(f"{target}/{MART_TABLES[name]}")
        return rounded(single(frame, *[c for c in frame.columns if c.startswith("avg_")]), *{"total_revenue"} & {*frame.columns})

    def rows(name: str, key, *columns: str) -> DataFrame:
        values = [F.lit(None).cast("double") if c is None else F.col(c) for c in columns[1:]]
        named = [value.alias(letter) for value, letter in zip(values, "abcd")]
        return read(name).select(F.lit(name).alias("mart"), key.alias("key"), F.col(columns[0]).alias("trips"), *named)

    def joined(*names: str):
        return F.concat_ws("-", *[F.col(name).cast("string") for name in names])

    daily = rows("daily", joined(*DAY_KEYS), "trip_count", "avg_duration_min", "avg_distance", "avg_fare", "total_revenue")
    hourly = rows("hourly", joined(*HOUR_KEYS), "trip_count", "avg_duration_min", "avg_fare_per_mile", None, None)
    pickup = rows(
        "pickup", F.col("PULocationID"), "pickup_count", "avg_distance_from_zone", "avg_fare_from_zone", None, None
    )
    time = F.date_format("tpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss")
    recent = rows("recent", time, "passenger_count", "trip_duration_min", "trip_distance", "fare_amount", None)
    return daily.union(hourly).union(pickup).union(recent)


@entry("p12_stage_run", MARTS_AFTER_RUN)
def p12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything landed, checked, transformed, checked and exported; then a run of one month, as a rebuild.

    Returned are the contents of the marts that the second run leaves.
    """
    raw = write_as(trips_view(spark, sf_dir), scratch_path(spark, "raw"))
    lake, target = empty_lake(spark), scratch_path(spark, "marts")
    first = run_stages(spark, Run(lake, raw=raw, mart_target=target, quality=QualityLimits(), reports=f"{target}-reports"))
    assert first.where("NOT success").isEmpty(), first.collect()
    second = run_stages(spark, Run(lake, YEAR, (MONTH,), raw=raw, mart_target=target))
    assert second.where("NOT success").isEmpty(), second.collect()
    return mart_contents(spark, target)


# --- entity features -----------------------------------------------------------------------------

CREATED_AT = datetime(2002, 1, 1)


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver trips with time and ratio features, their line as trip id, and a route as pair."""
    trips = with_months(trips_view(spark, sf_dir, keep=("l_orderkey", "l_linenumber")))
    rows = clean(trips, keep=("l_orderkey", "l_linenumber"))
    rows = rows.transform(f.add_time_features).transform(f.add_ratio_features)
    rows = rows.withColumn("trip_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return e.prepare_entities(rows, CREATED_AT)


VIEW = """
entity AS MATERIALIZED (
  SELECT l_orderkey * 10 + l_linenumber AS trip_id, route_id AS location_pair, tpep_pickup_datetime,
    TIMESTAMP '2002-01-01 00:00:00' AS created_at,
    CAST(trip_duration_min AS FLOAT) AS trip_duration_min, CAST(trip_distance AS FLOAT) AS trip_distance,
    passenger_count, CAST(fare_amount AS FLOAT) AS fare_amount, CAST(tip_amount AS FLOAT) AS tip_amount,
    CAST(total_amount AS FLOAT) AS total_amount, CAST(pickup_hour AS BIGINT) AS hour_of_day,
    CAST(pickup_day_of_week AS BIGINT) AS day_of_week, CAST(pickup_month AS BIGINT) AS month,
    CAST(sin(2 * pi() * pickup_hour / 24) AS FLOAT) AS sin_hour,
    CAST(cos(2 * pi() * pickup_hour / 24) AS FLOAT) AS cos_hour,
    CAST(sin(2 * pi() * pickup_day_of_week / 7) AS FLOAT) AS sin_day_of_week,
    CAST(cos(2 * pi() * pickup_day_of_week / 7) AS FLOAT) AS cos_day_of_week,
    CAST(trip_distance / nullif(trip_duration_min, 0) AS FLOAT) AS distance_per_minute,
    CAST(fare_per_mile AS FLOAT) AS fare_per_mile
  FROM gold_base
)"""
VIEW_COLUMNS = ["trip_id", "location_pair", "tpep_pickup_datetime", "created_at", *e.FEATURE_NAMES]
PAIR = ("location_pair",)


def newest_sql(source: str, condition: str, keys: tuple[str, ...] = PAIR) -> str:
    """The newest row per entity, ties settled by the other columns."""
    order = ["tpep_pickup_datetime", "created_at", *[name for name in VIEW_COLUMNS if name not in keys]]
    return (
        f"SELECT {o.listed(VIEW_COLUMNS)} FROM {source} WHERE {condition} QUALIFY row_number() OVER"
        f" (PARTITION BY {o.listed(keys)} ORDER BY {o.listed(f'{name} DESC NULLS LAST' for name in order)}) = 1"
    )


@entry(
    "k01_prepare_entities",
    o.over_features(
        "SELECT location_pair, count(*) AS trips, count(DISTINCT l_orderkey * 10 + l_linenumber) AS ids,"
        " min(created_at) AS created_at, max(tpep_pickup_datetime) AS newest FROM (SELECT *, route_id AS location_pair,"
        " TIMESTAMP '2002-01-01 00:00:00' AS created_at FROM gold_base) GROUP BY location_pair"
    ),
)
def k01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids are hashes without counterpart in SQL, but there must be as many as there are trips."""
    trips = with_months(trips_view(spark, sf_dir, keep=("l_orderkey", "l_linenumber")))
    rows = clean(trips, keep=("l_orderkey", "l_linenumber"))
    prepared = e.prepare_entities(rows, CREATED_AT, ["l_orderkey", "l_linenumber"])
    return prepared.groupBy("location_pair").agg(
        F.count("*").alias("trips"),
        F.countDistinct("trip_id").alias("ids"),
        F.min("created_at").alias("created_at"),
        F.max("tpep_pickup_datetime").alias("newest"),
    )


@entry("k02_feature_view", o.over_features(f"SELECT {o.listed(VIEW_COLUMNS)} FROM entity", VIEW))
def k02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return e.feature_view(entities(spark, sf_dir))


@entry(
    "k03_materialise",
    o.over_features(newest_sql("entity", "tpep_pickup_datetime >= TIMESTAMP '1996-06-01'"), VIEW),
)
def k03(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = e.feature_view(entities(spark, sf_dir))
    return e.materialise(view, start="1996-06-01 00:00:00", keys=PAIR)


@entry(
    "k03_materialise_trips",
    o.over_features(newest_sql("entity", "tpep_pickup_datetime >= TIMESTAMP '1996-06-01'", e.ENTITY_KEYS), VIEW),
)
def k03_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By both entity keys; nearly every trip is its own entity."""
    return e.materialise(e.feature_view(entities(spark, sf_dir)), start="1996-06-01 00:00:00")


IN_STEPS = (
    "tpep_pickup_datetime BETWEEN TIMESTAMP '1996-06-01' AND TIMESTAMP '1997-12-31'"
    " OR tpep_pickup_datetime BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '2000-06-30'"
)


@entry("k04_materialise_increment", o.over_features(newest_sql("entity", IN_STEPS), VIEW))
def k04(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = e.feature_view(entities(spark, sf_dir))
    # a state is stored, not computed anew by each of the joins that read it
    state = checkpointed(e.materialise(view, "1996-06-01 00:00:00", "1997-12-31 00:00:00", PAIR))
    return e.materialise_increment(state, view, "1999-01-01 00:00:00", "2000-06-30 00:00:00", PAIR)


@entry("k04_increment_in_buckets", o.over_features(newest_sql("entity", IN_STEPS), VIEW))
def k04_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state lies in buckets of its keys, and so does what replaces it."""
    view = e.feature_view(entities(spark, sf_dir))
    first = e.materialise(view, "1996-06-01 00:00:00", "1997-12-31 00:00:00", PAIR)
    name = scratch_path(spark, "entity_state").rsplit("/", 1)[-1].replace("-", "_")
    state = e.store_state(first, f"{name}_1", scratch_path(spark, "state"), PAIR, buckets=32)
    merged = e.materialise_increment(state, view, "1999-01-01 00:00:00", "2000-06-30 00:00:00", PAIR)
    return e.store_state(merged, f"{name}_2", scratch_path(spark, "state"), PAIR, buckets=32)


@entry("k03_materialise_shuffled", o.over_features(newest_sql("entity", "tpep_pickup_datetime >= TIMESTAMP '1996-06-01'"), VIEW))
def k03_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With more entities than may be broadcast."""
    view = e.feature_view(entities(spark, sf_dir))
    return e.materialise(view, start="1996-06-01 00:00:00", keys=PAIR, bounds=JoinBounds(broadcast_rows=0))


def lookup_query(bounds: JoinBounds = JoinBounds()):
    """Each part's route asked for: known, unknown and expired ones."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        latest = e.materialise(e.feature_view(entities(spark, sf_dir)), None, keys=PAIR)
        parts = spark.read.parquet(f"{sf_dir}/part.parquet")
        wanted = parts.select(
            "p_partkey",
            F.concat_ws("_", (F.col("p_partkey") % 110 + 1).cast("string"), (F.col("p_partkey") % 265 + 1).cast("string"))
            .alias("location_pair"),
        )
        return e.lookup_features(
            wanted,
            latest,
            ("trip_distance", "passenger_count", "fare_per_mile"),
            PAIR,
            now="2001-06-01 00:00:00",
            bounds=bounds,
        )

    return run


LOOKUP_SQL = o.over_features(
    "SELECT w.p_partkey, w.location_pair, l.trip_distance, l.passenger_count, l.fare_per_mile FROM"
    " (SELECT p_partkey, (p_partkey % 110 + 1) || '_' || (p_partkey % 265 + 1) AS location_pair FROM part) w"
    f" LEFT JOIN ({newest_sql('entity', 'true')}) l ON w.location_pair = l.location_pair"
    " AND l.tpep_pickup_datetime >= TIMESTAMP '2001-06-01' - INTERVAL 365 DAY",
    VIEW,
)
ENTRIES["k05_lookup"] = Entry(lookup_query(), LOOKUP_SQL)
ENTRIES["k05_lookup_shuffled"] = Entry(lookup_query(JoinBounds(broadcast_rows=0)), LOOKUP_SQL)
