"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

The three stages write their layer and are timed once, after a plain scan of the source that
starts the JVM. Queries over the stored layers run to completion without a sink, once to warm up
and once timed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).parent))

from meterline.operators import features, marts, quality  # noqa: E402
from meterline.operators.clean import clean  # noqa: E402
from meterline.plans import reports, stages  # noqa: E402
from meterline.schema import rules_for  # noqa: E402
from meterline.settings import FeatureGroups, tune  # noqa: E402
from meterline.sources.layers import land_bronze, read_layer  # noqa: E402
from meterline.sources.scratch import scratch_path  # noqa: E402
from meterline.sources.trips import trips_view  # noqa: E402
from meterline.suite.runs import ENTRIES  # noqa: E402

YEAR, MONTH = 1998, 1


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("meterline-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    lake = stages.Lake(scratch_path(spark, "bench"))
    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    run(trips_view(spark, sf_dir))
    timed("s13_land_bronze", lambda: land_bronze(spark, trips_view(spark, sf_dir), lake.layer("bronze")))
    timed("c12_silver_stage", lambda: stages.build_silver(spark, lake))
    timed("f29_gold_stage", lambda: stages.build_gold(spark, lake))

    def bronze() -> DataFrame:
        return read_layer(spark, lake.layer("bronze"))

    def silver() -> DataFrame:
        return read_layer(spark, lake.layer("silver"))

    def gold() -> DataFrame:
        return read_layer(spark, lake.layer("gold"))

    def timed_silver() -> DataFrame:
        return features.add_time_features(silver(), cyclic=False)

    queries = {
        "c10_clean": lambda: clean(bronze()),
        "f28_features_row_wise": lambda: features.add_features(silver(), FeatureGroups(frequency=False)),
        "f28_features": lambda: features.add_features(silver()),
        "v_gold_checks_one_pass": lambda: quality.run_checks(
            gold(), quality.data_checks(gold(), rules_for("gold")), "gold"
        ),
        "v14_duplicates": lambda: quality.duplicate_counts(gold()),
        "m01_daily_summary": lambda: marts.daily_summary(gold()),
        "m02_hourly_patterns": lambda: marts.hourly_patterns(gold()),
        "m03_pickup_stats": lambda: marts.pickup_stats(gold()),
        "m04_recent_trips": lambda: marts.recent_trips(gold()),
        "q05_volume_by_hour": lambda: reports.volume_by_hour(gold(), YEAR),
        "q06_duration_by_weekday": lambda: reports.duration_by_weekday(gold(), YEAR),
        "q07_revenue_by_month": lambda: reports.revenue_by_month(timed_silver(), YEAR),
        "q08_distance_buckets": lambda: reports.distance_buckets(gold(), YEAR),
        "q09_popular_pickups": lambda: reports.popular_pickups(gold(), YEAR),
        "q10_month_volume_by_hour": lambda: reports.volume_by_hour(gold(), YEAR, MONTH),
        "q11_duration_by_day_name": lambda: reports.duration_by_day_name(gold(), YEAR),
        "q12_daily_view": lambda: reports.daily_view(timed_silver()),
    }
    # newest row per entity, its increment, and lookups by broadcast and by shuffle
    for name in ("k03_materialise", "k04_materialise_increment", "k05_lookup", "k05_lookup_shuffled"):
        queries[name] = lambda name=name: ENTRIES[name].run(spark, sf_dir)
    for name, query in queries.items():
        run(query())
        timed(name, lambda query=query: run(query()))

    rows = bronze().count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(Path(sf_dir).name.removeprefix("sf")),
                "rows": rows,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
