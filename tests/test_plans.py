"""What the physical plans must and must not contain."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from meterline.operators import entity as e
from meterline.operators import features as f
from meterline.operators import lookup
from meterline.operators import marts as m
from meterline.operators import quality as q
from meterline.operators.clean import clean
from meterline.plans import reports as r
from meterline.schema import rules_for
from meterline.settings import FeatureGroups, JoinBounds
from meterline.sources.layers import read_layer
from meterline.sources.layers import months_present
from meterline.suite.frames import stored_lake
from meterline.suite.runs import entities

PLAIN = FeatureGroups(frequency=False)


def plan(df, run: bool = False) -> str:
    if run:
        df.collect()
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


@contextmanager
def without_automatic_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def layers(spark, sf_dir):
    lake = stored_lake(spark, sf_dir)
    return {name: read_layer(spark, lake.layer(name)) for name in ("bronze", "silver", "gold")}


def test_cleaning_is_narrow_and_its_bounds_reach_the_scan(layers):
    text = plan(clean(layers["bronze"]))
    assert "Exchange" not in text and "Python" not in text
    pushed = re.search(r"PushedFilters: \[(.*?)\],? ?ReadSchema", layers_explained(clean(layers["bronze"]))).group(1)
    for bound in (
        "GreaterThan(trip_distance,0.0)",
        "LessThan(trip_distance,60.0)",
        "GreaterThan(fare_amount,0.0)",
        "GreaterThanOrEqual(total_amount,0.0)",
        "IsNotNull(PULocationID)",
    ):
        assert bound in pushed


def layers_explained(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode).replace("\n", " ")


def test_row_wise_features_are_narrow(layers):
    assert "Exchange" not in plan(f.add_features(layers["silver"], PLAIN))


def test_frequencies_move_no_trips(layers):
    text = plan(f.add_features(layers["silver"]))
    assert "SortMergeJoin" not in text
    assert text.count("BroadcastHashJoin") == 3
    # trips are scanned once here; the exchanges are those of the count tables
    assert text.count("FileScan") == 1
    for exchange in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text):
        assert exchange in ("year, month, PULocationID", "year, month, DOLocationID", "year, month, route_id")
    assert "tip_amount" not in "".join(line for line in text.splitlines() if "hashpartitioning" in line)


def located(silver):
    return silver.transform(f.normalise_zones).transform(f.add_route)


def test_large_counts_are_joined_by_a_salted_shuffle(spark, layers):
    with without_automatic_broadcast(spark):
        trips = located(layers["silver"])
        bounds = JoinBounds(broadcast_rows=0, hot_keys=50, salts=8)
        joined = f.add_frequencies(trips, (), bounds, only=("pickup_zone_trip_count",))
        text = plan(joined)
        assert "hashpartitioning(PULocationID, _salt" in text
        assert text.count("BroadcastExchange") == 1  # the heavy keys, bounded by hot_keys
        plain = f.add_frequencies(trips, only=("pickup_zone_trip_count",))
        assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()


def test_counts_too_many_for_a_plain_broadcast_move_no_trips_either(spark, layers):
    """More routes than may be broadcast as rows are broadcast packed; NULL zones have no count in both."""
    silver = layers["silver"].withColumn("PULocationID", F.expr("nullif(PULocationID, '9')"))
    bounds = JoinBounds(broadcast_rows=1000)
    assert silver.select("year", "month", "PULocationID", "DOLocationID").distinct().count() > bounds.broadcast_rows
    with without_automatic_broadcast(spark):
        packed, plain = f.add_features(silver, bounds=bounds), f.add_features(silver)
        text = plan(packed)
        assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 3
        assert "tip_amount" not in "".join(line for line in text.splitlines() if "hashpartitioning" in line)
        assert packed.columns == plain.columns
        assert packed.exceptAll(plain).isEmpty() and plain.exceptAll(packed).isEmpty()


def test_keys_that_share_a_hash_are_not_packed(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long")
    assert lookup._packed(counts, ["k"], "n", 1, hash_of=lambda *keys: F.lit(7).cast("long")) is None
    assert lookup._packed(counts, ["k"], "n", 1) is not None


def test_one_hot_zone_is_spread(spark, layers):
    """Two thirds of the trips in one zone, or in none: no shuffle partition gets them all."""
    with without_automatic_broadcast(spark):
        number = F.monotonically_increasing_id() % 3
        zone = F.when(number == 0, "1").when(number == 1, F.lit(None)).otherwise(F.col("PULocationID"))
        skewed = located(layers["silver"].withColumn("PULocationID", zone))
        bounds = JoinBounds(broadcast_rows=0, hot_keys=10, salts=64)
        joined = f.add_frequencies(skewed, (), bounds, only=("pickup_zone_trip_count",))
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            sizes = [row["count"] for row in joined.groupBy(F.spark_partition_id()).count().collect()]
            expected = skewed.groupBy("PULocationID").count().where("PULocationID IS NOT NULL")
            found = joined.groupBy("PULocationID").agg(F.max("pickup_zone_trip_count").alias("count"))
            assert found.where("PULocationID IS NOT NULL").exceptAll(expected).isEmpty()
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
        assert max(sizes) < 0.35 * sum(sizes)


def test_all_checks_share_one_scan(layers):
    gold = layers["gold"]
    text = plan(q.run_checks(gold, q.data_checks(gold, rules_for("gold")), "gold"))
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == 1 and "Exchange SinglePartition" in text


def test_duplicates_shuffle_hashes_only(spark, layers):
    with without_automatic_broadcast(spark):
        text = plan(q.hash_counts(layers["silver"]))
    assert re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text) == ["_hash"]
    assert "Sort" not in text


def test_months_are_learned_from_folders(layers, spark):
    text = plan(months_present(spark, layers["silver"].inputFiles()[0].rsplit("/year=", 1)[0]))
    assert "binaryFile" in text and "ReadSchema: struct<>" in text


def test_months_prune_partitions_and_columns(layers):
    text = layers_explained(r.volume_by_hour(layers["gold"], 1998, 1))
    assert re.search(r"PartitionFilters: \[isnotnull\(year#\d+\), isnotnull\(month#\d+\), \(year#\d+ = 1998\)", text)
    assert "ReadSchema: struct<pickup_hour:int>" in text


def test_marts_read_only_their_columns(layers):
    text = layers_explained(m.pickup_stats(layers["gold"]))
    assert "ReadSchema: struct<PULocationID:string,trip_distance:double,fare_amount:double>" in text


def test_newest_trips_are_a_top_k(layers):
    assert "TakeOrderedAndProject" in plan(m.recent_trips(layers["gold"]))


def test_newest_row_per_entity_sorts_survivors_only(spark, sf_dir):
    view = e.feature_view(entities(spark, sf_dir))
    with without_automatic_broadcast(spark):
        text = plan(e.materialise(view, None, keys=("location_pair",), bounds=JoinBounds(broadcast_rows=0)))
    above, below = text.split("ShuffledHashJoin", 1)
    assert "Window" not in text and "SortAggregate" in above
    assert "Sort" not in below


def test_only_newest_rows_leave_their_place(spark, sf_dir):
    """Below the filter there is no exchange but that of entities and times."""
    view = e.feature_view(entities(spark, sf_dir))
    text = plan(e.materialise(view, None, keys=("location_pair",)))
    above, below = text.split("BroadcastHashJoin", 1)
    assert "LeftSemi" in below and "Exchange hashpartitioning" in above
    assert "Exchange hashpartitioning" not in below and "ShuffleQueryStage" not in below


def test_an_increment_leaves_the_state_in_place(spark, sf_dir, tmp_path):
    """The state is scanned by bucket under the joins, with no exchange in between, and written without one."""
    keys = ["location_pair"]
    view = e.feature_view(entities(spark, sf_dir))
    first = e.materialise(view, "1995-01-01", "1997-12-31", keys)
    with without_automatic_broadcast(spark):
        state = e.store_state(first, "entity_state_1", str(tmp_path / "state1"), keys, buckets=16)
        merged = e.materialise_increment(state, view, "1997-12-31", "1999-06-30", keys)
        lines = plan(merged).splitlines()
        exchanges = [n for n, line in enumerate(lines) if "Exchange" in line]
        below = [next(line for line in lines[n:] if "Scan" in line) for n in exchanges]
        # what is shuffled is the increment, which is checkpointed; the state is scanned by bucket
        assert exchanges and all("Scan ExistingRDD" in line for line in below)
        assert sum("entity_state_1" in line for line in lines) == 3
        assert all("Bucketed: true" in line or "Bucketed: false (disabled" not in line for line in lines if "entity_state_1" in line)
        again = e.store_state(merged, "entity_state_2", str(tmp_path / "state2"), keys, buckets=16)
        expected = e.materialise(view, "1995-01-01", "1999-06-30", keys)
        assert again.count() == expected.count() and again.exceptAll(expected).isEmpty()


def test_a_wanted_hot_key_and_null_keys_are_spread(spark):
    """Two thirds of the wanted rows ask for one key and most of the rest for none."""
    latest = spark.range(1000).selectExpr(
        "id AS k", "timestamp_ntz '2025-01-01' AS tpep_pickup_datetime", "cast(id * 2 as int) AS v"
    )
    wanted = spark.range(0, 90_000, 1, 32).selectExpr("CASE id % 9 WHEN 6 THEN id % 900 + 100 WHEN 7 THEN NULL WHEN 8 THEN NULL ELSE 5 END AS k", "id")
    with without_automatic_broadcast(spark):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            found = e.lookup_features(wanted, latest, ("v",), ["k"], "2025-02-01", bounds=JoinBounds(0, hot_keys=100))
            sizes = [row["count"] for row in found.groupBy(F.spark_partition_id()).count().collect()]
            assert found.columns == ["k", "id", "v"] and found.where("k = 5 AND v = 10").count() == 60_000
            assert found.where("v IS NULL").count() == 20_000
            assert found.where("k <> 5 AND v = 2 * k").count() == 10_000
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
    # eight partitions, evenly filled without any adaptive setting
    assert sum(sizes) == 90_000 and max(sizes) < 0.2 * sum(sizes)


def test_a_hot_key_that_is_not_held_is_spread_too(spark):
    latest = spark.range(100).selectExpr("id AS k", "timestamp_ntz '2025-01-01' AS tpep_pickup_datetime", "cast(id as int) AS v")
    wanted = spark.range(0, 40_000, 1, 8).selectExpr("IF(id % 4 = 0, id % 50, 777) AS k")
    with without_automatic_broadcast(spark):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = e.lookup_features(wanted, latest, ("v",), ["k"], "2025-02-01", bounds=JoinBounds(0, hot_keys=10))
        sizes = [row["count"] for row in found.groupBy(F.spark_partition_id()).count().collect()]
        assert found.where("v IS NULL").count() == 30_000 and found.where("v = k").count() == 10_000
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < 0.3 * sum(sizes)


def test_no_operator_leaves_the_jvm(spark, sf_dir, layers):
    for df in (clean(layers["bronze"]), f.add_features(layers["silver"]), m.daily_summary(layers["gold"])):
        assert "Python" not in plan(df) and "Arrow" not in plan(df)
