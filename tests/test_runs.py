import re
import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meterline.operators import entity as e
from meterline.operators import partitions as p
from meterline.operators import marts
from meterline.operators.clean import clean
from meterline.plans import stages
from meterline.plans import stages as s
from meterline.plans.stages import Lake
from meterline.settings import CleaningLimits, JoinBounds, QualityLimits
from meterline.sources import layers
from meterline.sources.layers import land_bronze, layer_exists, months_present, read_layer, write_layer
from meterline.sources.scratch import checkpoint_root
from meterline.sources.trips import trips_view, with_months
from meterline.suite import runs
from meterline.suite.frames import gold, stored_lake
from meterline.suite.rows import ENTRIES


def numbers(spark):
    return spark.range(30).selectExpr("id", "cast(id % 3 as int) AS k")


def test_partition_values(spark):
    assert list(p.partition_values(numbers(spark), "k")) == [0, 1, 2]


def fails_on_one(df):
    return df.withColumn("x", F.when(df.k == 1, F.raise_error(F.lit("bad"))).otherwise(0))


@pytest.mark.parametrize("at_once", [1, 3])
def test_a_failing_value_is_logged_and_the_others_are_written(spark, tmp_path, at_once):
    log = p.process_by_value(numbers(spark), "k", fails_on_one, str(tmp_path), at_once=at_once)
    entries = {row.partition_value: row for row in log.collect()}
    assert {value: row.success for value, row in entries.items()} == {"0": True, "1": False, "2": True}
    assert "bad" in entries["1"].error and entries["1"].output_path is None
    assert spark.read.parquet(entries["2"].output_path).count() == 10
    assert entries["0"].output_path.endswith("/0")


def test_what_a_log_with_a_failure_holds_is_not_the_whole(spark, tmp_path):
    log = p.process_by_value(numbers(spark), "k", fails_on_one, str(tmp_path))
    with pytest.raises(RuntimeError, match=r"1 of 3 values failed \(1\), the first with: .*bad"):
        p.written_paths(log)
    whole = p.process_by_value(numbers(spark), "k", lambda part: part, str(tmp_path))
    assert p.written_paths(whole) == [f"{tmp_path}/{k}" for k in range(3)]


def lines_of(spark, folder, *dates):
    """A small ``lineitem`` table: one line per ship date, each a clean trip."""
    line = "100L, 2L, 3L, 1, 4.0D, 2000.0D, 0.05D, 0.02D, 'A', 'F'"
    lines = " UNION ALL ".join(f"SELECT {line}, TIMESTAMP '{date}'" for date in dates)
    names = "orderkey partkey suppkey linenumber quantity extendedprice discount tax returnflag linestatus shipdate"
    spark.sql(lines).toDF(*[f"l_{name}" for name in names.split()]).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_months_that_fail_are_no_result(spark, tmp_path, monkeypatch):
    """The query counts the months when all are written, and raises when one of them is not."""
    folder = lines_of(spark, tmp_path, "1998-01-10", "1998-02-10", "1998-02-11", "1999-03-10")
    query = runs.ENTRIES["p04_process_by_month"].run
    assert sorted(tuple(row) for row in query(spark, folder).collect()) == [(1998, 1, 1), (1998, 2, 2), (1999, 3, 1)]
    bad = F.when(F.col("month") == 2, F.raise_error(F.lit("bad month")).cast("int")).otherwise(F.col("month"))
    monkeypatch.setattr(runs, "clean", lambda df: clean(df.withColumn("month", bad)))
    with pytest.raises(RuntimeError, match=r"1 of 3 values failed \(2\), the first with: .*bad month"):
        query(spark, folder)


def test_years_that_fail_are_no_result(spark, tmp_path, monkeypatch):
    """Side by side, too: the other years are written, and the query raises."""
    folder = lines_of(spark, tmp_path, "1996-05-01", "1997-05-01", "1997-06-01", "1998-05-01", "1999-05-01")
    query = runs.ENTRIES["p05_batches"].run
    assert sorted(tuple(row) for row in query(spark, folder).collect()) == [(1996, 1), (1997, 2), (1998, 1), (1999, 1)]
    bad = F.when(F.col("year") == 1997, F.raise_error(F.lit("bad year")).cast("int")).otherwise(F.col("year"))
    monkeypatch.setattr(runs, "clean", lambda df: clean(df.withColumn("year", bad)))
    scratch = Path(checkpoint_root(spark).removeprefix("file:"))
    before = set(scratch.glob("batches-*"))
    with pytest.raises(RuntimeError, match=r"1 of 4 values failed \(1997\), the first with: .*bad year"):
        query(spark, folder)
    (written,) = set(scratch.glob("batches-*")) - before
    assert sorted(done.parent.name for done in written.glob("*/_SUCCESS")) == ["1996", "1998", "1999"]


def test_null_is_a_value_of_its_own(spark, tmp_path):
    df = numbers(spark).withColumn("k", F.nullif("k", F.lit(2)))
    log = p.process_by_value(df, "k", lambda part: part, str(tmp_path))
    assert all(row.success for row in log.collect())
    assert spark.read.parquet(*[row.output_path for row in log.collect()]).count() == 30


def test_one_job_for_all_values(spark, tmp_path):
    base = str(tmp_path / "out")
    log = p.process_partitioned(numbers(spark), ["k"], lambda df: df.withColumn("y", df.id * 2), base)
    assert sorted(row.output_path for row in log.collect()) == [f"{base}/k={k}" for k in range(3)]
    p.process_partitioned(numbers(spark).where("k = 1 AND id < 5"), ["k"], lambda df: df, base)
    counts = {row.k: row["count"] for row in spark.read.parquet(base).groupBy("k").count().collect()}
    assert counts == {0: 10, 1: 2, 2: 10}


def test_months_get_their_folders(spark, tmp_path):
    df = numbers(spark).selectExpr("id", "2024 AS year", "k + 1 AS month")
    log = p.process_by_month(df, lambda part: part, str(tmp_path), row_wise=False, year=2024)
    assert sorted(row.output_path[-7:] for row in log.collect()) == ["2024/01", "2024/02", "2024/03"]
    log = p.process_by_month(df, lambda part: part, str(tmp_path / "all"), row_wise=False)
    assert log.count() == 3


def test_the_log_tells_what_was_written(spark, tmp_path):
    base = str(tmp_path / "out")
    log = p.process_partitioned(numbers(spark), ["k"], lambda df: df.where("k = 0"), base)
    found = {row.partition_value: (row.output_path, row.success, row.empty) for row in log.collect()}
    assert found == {"k=0": (f"{base}/k=0", True, False), "k=1": (None, True, True), "k=2": (None, True, True)}
    failed = p.process_partitioned(numbers(spark), ["k"], fails_on_one, base).collect()
    assert len(failed) == 3 and all("bad" in row.error and not row.success for row in failed)


def test_odd_values_are_named_as_their_folders(spark, tmp_path):
    df = spark.createDataFrame([("a b",), ("x/y",), ("50%",), (None,), ("c+d",)], "k string")
    log = p.process_partitioned(df, ["k"], lambda part: part.withColumn("v", F.lit(1)), str(tmp_path / "out"))
    assert {(row.partition_value, row.empty) for row in log.collect()} == {
        (f"k={value}", False) for value in ("a b", "x/y", "50%", "__HIVE_DEFAULT_PARTITION__", "c+d")
    }


def test_iterating_is_lazy(spark):
    parts = dict(p.iterate_values(numbers(spark), "k", lambda df: df.withColumn("x", F.raise_error(F.lit("late")))))
    assert sorted(parts) == [0, 1, 2]


def test_aggregate_by(spark):
    result = p.aggregate_by(numbers(spark), ["k"], {"id": "max"})
    assert {row.k: row["max(id)"] for row in result.collect()} == {0: 27, 1: 28, 2: 29}


def test_rebalancing(spark):
    assert [p.partitions_for(n, 100) for n in (0, 1, 100, 101)] == [1, 1, 1, 2]
    df = spark.range(0, 100, 1, 8)
    assert p.rebalanced(df, 20).rdd.getNumPartitions() == 20
    assert p.rebalanced(df).count() == p.rebalanced(df, None, "id").count() == 100
    with pytest.raises(ValueError):
        p.rebalanced(df, 0)


# --- stages --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    lake = s.Lake(str(tmp_path_factory.mktemp("lake")))
    land_bronze(spark, trips_view(spark, sf_dir), lake.layer("bronze"))
    return lake


def test_parse_months():
    assert s.parse_months("all") == list(range(1, 13))
    assert s.parse_months("1, 2,3") == [1, 2, 3]
    for wrong in ("13", "", "0,1"):
        with pytest.raises(ValueError):
            s.parse_months(wrong)


def test_stages_with_reports(spark, lake):
    limits = QualityLimits(min_rows=1)
    silver = s.build_silver(spark, lake, 1998, [1, 2], quality=limits)
    found = {(row.check, row.column): row for row in silver.collect()}
    rows = read_layer(spark, lake.layer("silver")).count()
    assert found[("total_rows", "")].metric == rows > 0
    assert found[("duplicate_rows", "count")].metric == 0
    gold_report = s.build_gold(spark, lake, 1998, [2], quality=limits)
    stored = read_layer(spark, lake.layer("gold"))
    assert {row.month for row in stored.select("month").distinct().collect()} == {2}
    assert gold_report.where("check = 'range' AND column = 'pickup_year'").first().metric == stored.count()
    failing = QualityLimits(min_rows=10**9, fail_on_error=True, duplicates=False)
    with pytest.raises(Exception, match="row_count"):
        s.build_silver(spark, lake, 1998, [1], quality=failing)


def test_month_run_without_success_is_an_error(spark, lake):
    with pytest.raises(RuntimeError, match="no data"):
        s.run_silver_months(spark, lake, 1980, [1, 2])

    def never(year, months):
        raise RuntimeError("always bad")

    with pytest.raises(RuntimeError, match="always bad"):
        s.run_months(spark, lake.layer("bronze"), 1998, [1, 2], never)


def test_month_runs(spark, lake):
    log = s.run_silver_months(spark, lake, 1999, [1, 2])
    assert [row.status for row in log.orderBy("month").collect()] == ["built", "built"]
    log = s.run_gold_months(spark, lake, 1999, [1, 7])
    assert [row.status for row in log.orderBy("month").collect()] == ["built", "skipped"]


def test_gold_beyond_the_broadcast_bound_is_the_same(spark, sf_dir, tmp_path):
    whole, large = s.Lake(str(tmp_path / "whole")), s.Lake(str(tmp_path / "large"))
    for lake in (whole, large):
        land_bronze(spark, trips_view(spark, sf_dir).where("year(tpep_pickup_datetime) < 1998"), lake.layer("bronze"))
        s.build_silver(spark, lake)
    limits = QualityLimits(duplicates=False)
    one = s.build_gold(spark, whole, quality=limits)
    many = s.build_gold(spark, large, quality=limits, bounds=JoinBounds(broadcast_rows=0))
    a, b = (read_layer(spark, lake.layer("gold")) for lake in (whole, large))
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).isEmpty()
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_absent_months_are_an_error(spark, lake):
    with pytest.raises(ValueError, match="none of the months"):
        s.build_silver(spark, lake, 1980)
    with pytest.raises(ValueError, match="none of the months"):
        s.build_gold(spark, lake, 1998, [99])


def test_stages_leave_the_settings_of_the_session(spark, lake):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "12345")
    try:
        s.build_silver(spark, lake, 1998, [1])
        assert spark.conf.get(key) == "12345"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_bronze_of_an_older_schema(spark, sf_dir, tmp_path):
    """Months written before the optional fee existed, and one with a column nobody knows."""
    lake = s.Lake(str(tmp_path))
    trips = with_months(trips_view(spark, sf_dir)).where("year = 1998")
    write_layer(trips.where("month = 1").drop("cbd_congestion_fee"), lake.layer("bronze"))
    write_layer(trips.where("month = 2").withColumn("unknown", F.lit(1)), lake.layer("bronze"))
    s.build_layers(spark, lake, 1998)
    gold = read_layer(spark, lake.layer("gold"))
    assert gold.where("month = 1 AND cbd_congestion_fee IS NOT NULL").isEmpty()
    assert not gold.where("month = 2 AND cbd_congestion_fee IS NOT NULL").isEmpty()
    assert "unknown" not in gold.columns


def test_validating_an_absent_layer(spark, tmp_path):
    assert s.validate_layer(spark, s.Lake(str(tmp_path)), "gold", 1998) is None


def test_stage_run_stops_at_the_first_failure(spark, tmp_path):
    log = s.run_stages(spark, s.Run(s.Lake(str(tmp_path / "lake")), raw=str(tmp_path / "no such folder")))
    rows = log.collect()
    assert len(rows) == 1 and not rows[0].success and rows[0].stage == "ingest"


def test_stage_switches(spark, lake, tmp_path):
    run = s.Run(lake, 1998, (3,), ingest=False, mart_target=str(tmp_path))
    log = s.run_stages(spark, run).orderBy("step").collect()
    assert [(row.stage, row.success) for row in log] == [("transform", True), ("check_gold", True), ("export", True)]
    recent = spark.read.parquet(str(tmp_path / "gold_recent_trips"))
    assert recent.count() == min(1000, read_layer(spark, lake.layer("gold")).count())
    assert s.export_marts(read_layer(spark, lake.layer("gold"), 2050), str(tmp_path)) == {}


def test_mart_counts_agree(spark, sf_dir):
    from meterline.operators import marts as m

    trips = gold(spark, sf_dir)
    rows = trips.count()
    for mart, name in ((m.daily_summary, "trip_count"), (m.hourly_patterns, "trip_count"), (m.pickup_stats, "pickup_count")):
        assert mart(trips).agg(F.sum(name)).first()[0] == rows
    assert m.recent_trips(trips, 7).count() == 7


# --- entities ------------------------------------------------------------------------------------

VIEW = "trip_id long, location_pair string, tpep_pickup_datetime timestamp_ntz, created_at timestamp_ntz, v int"


def view(spark):
    day = [datetime(2025, 1, d) for d in range(1, 10)]
    return spark.createDataFrame(
        [
            (1, "a", day[1], day[1], 1),
            (1, "a", day[2], day[1], 2),
            (1, "a", day[2], day[3], 3),
            (1, "a", day[2], day[3], 4),
            (1, "b", day[4], day[4], 5),
            (2, "a", day[8], day[8], 6),
        ],
        VIEW,
    )


def values(df):
    return {(row.trip_id, row.location_pair): row.v for row in df.collect()}


def test_newest_row_per_entity(spark):
    assert values(e.materialise(view(spark))) == {(1, "a"): 4, (1, "b"): 5, (2, "a"): 6}
    assert values(e.materialise(view(spark), end="2025-01-02")) == {(1, "a"): 1}
    assert e.materialise(view(spark), start="2026-01-01").isEmpty()
    by_pair = e.latest_rows(view(spark), ("location_pair",))
    assert {row.location_pair: row.v for row in by_pair.collect()} == {"a": 6, "b": 5}


def test_increments_give_what_a_full_run_gives(spark):
    state = e.materialise(view(spark), end="2025-01-02")
    state = e.materialise_increment(state, view(spark), "2025-01-03", "2025-01-04")
    assert values(state) == {(1, "a"): 4}
    state = e.materialise_increment(state, view(spark), "2025-01-05", "2025-01-30")
    assert values(state) == values(e.materialise(view(spark)))
    # an older event does not replace a newer one
    late = e.materialise_increment(state, view(spark).where("v = 1"), "2025-01-01", "2025-01-30")
    assert values(late) == values(state)


@pytest.mark.parametrize("bounds", [JoinBounds(), JoinBounds(broadcast_rows=0)])
def test_lookup(spark, bounds):
    latest = e.materialise(view(spark))
    wanted = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (9, "a")], "trip_id long, location_pair string")
    found = e.lookup_features(wanted, latest, ("v",), now="2025-02-01", bounds=bounds)
    assert sorted((r.trip_id, r.location_pair, r.v) for r in found.collect() if r.v is not None) == [
        (1, "a", 4),
        (1, "a", 4),
        (1, "b", 5),
    ]
    assert found.count() == 4
    with pytest.raises(ValueError, match="more rows than keys"):
        e.lookup_features(wanted, latest.union(latest), ("v",), now="2025-02-01", bounds=bounds)
    # 365 days after the event it still counts, later it does not
    edge = e.lookup_features(wanted, latest, ("v",), now="2026-01-03", bounds=bounds)
    assert {row.v for row in edge.where("trip_id = 1").collect()} == {4, 5}
    gone = e.lookup_features(wanted, latest, ("v",), now="2026-01-04", bounds=bounds)
    assert {row.v for row in gone.where("trip_id = 1").collect()} == {None, 5}


def test_prepared_ids_are_stable(spark, sf_dir):
    trips = gold(spark, sf_dir)
    prepared = e.prepare_entities(trips, datetime(2025, 1, 1))
    again = e.prepare_entities(trips.repartition(5), datetime(2025, 1, 1))
    ids = prepared.select("trip_id", "tpep_pickup_datetime", "fare_amount")
    assert ids.exceptAll(again.select(*ids.columns)).isEmpty()
    assert ids.select("trip_id").distinct().count() == trips.distinct().count()
    given = trips.select(F.lit(5).alias("trip_id"), F.lit("x").alias("location_pair"))
    assert tuple(e.prepare_entities(given, datetime(2025, 1, 1)).first()[:2]) == (5, "x")


def test_feature_view_types(spark):
    assert len(e.FEATURES) == 15
    assert sum(kind == "float" for _, kind in e.FEATURES) == 11


class Stopped(Exception):
    """The driver is gone."""


def test_a_rebuild_that_dies_before_it_empties_a_month_is_finished(spark, sf_dir, monkeypatch, tmp_path):
    """It stops between the overwrite and the emptying; the next rebuild, of another month, does the rest."""
    lake = Lake(str(tmp_path / "lake"))
    land_bronze(spark, trips_view(spark, sf_dir).where("year(tpep_pickup_datetime) = 1998"), lake.layer("bronze"))
    stages.build_silver(spark, lake)
    held = {row.month for row in months_present(spark, lake.layer("silver")).collect()}
    assert {1, 2, 3} <= held
    real = layers._files_by_month

    def die_after_writing(spark, root, months, calls=[]):  # noqa: B006
        calls.append(months)
        if len(calls) == 2:
            raise Stopped
        return real(spark, root, months)

    with monkeypatch.context() as patch:
        patch.setattr(layers, "_files_by_month", die_after_writing)
        with pytest.raises(Stopped):
            stages.build_silver(spark, lake, 1998, [1, 2], CleaningLimits(max_trip_distance=-1.0))
    assert not read_layer(spark, lake.layer("silver"), 1998, [1]).isEmpty()
    before = read_layer(spark, lake.layer("silver"), 1998, [4]).count()
    stages.build_silver(spark, lake, 1998, [3], CleaningLimits(max_trip_distance=-1.0))
    for month in (1, 2, 3):
        assert read_layer(spark, lake.layer("silver"), 1998, [month]).isEmpty()
    assert read_layer(spark, lake.layer("silver"), 1998, [4]).count() == before
    assert stages._unfinished(spark, lake.layer("silver"), stages.REBUILD) == set()


def test_stored_marts_read_only_months_rebuilt(spark, sf_dir, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "lake"))
    land_bronze(spark, trips_view(spark, sf_dir).where("year(tpep_pickup_datetime) = 1998"), lake.layer("bronze"))
    stages.build_layers(spark, lake)
    first = stages.refresh_marts(spark, lake, 50)
    assert {month for _, month in first} == set(range(1, 13)) and stages.refresh_marts(spark, lake, 50) == []
    stages.build_silver(spark, lake, 1998, [5], CleaningLimits(max_trip_distance=3.0))
    stages.build_gold(spark, lake, 1998, [5])
    plans, write = [], stages.write_layer
    monkeypatch.setattr(stages, "write_layer", lambda df, *a, **k: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, *a, **k))
    target = str(tmp_path / "marts")
    stages.export_stored_marts(spark, lake, target, 50)
    assert len(plans) == 2
    for text in plans:
        scan = next(line for line in text.splitlines() if "FileScan" in line)
        assert re.search(r"PartitionFilters: \[[^]]*year#?\d* = 1998[^]]*month#?\d* = 5", scan)
    gold = read_layer(spark, lake.layer("gold"))
    whole = {**marts.marts_from_grain(marts.trip_grain(gold)), "recent": marts.recent_trips(gold, 50)}
    for name, expected in whole.items():
        found = spark.read.parquet(f"{target}/{marts.MART_TABLES[name]}")
        columns = [F.col(c).cast("float").alias(c) if t == "double" else F.col(c) for c, t in expected.dtypes]
        assert found.select(*columns).exceptAll(expected.select(*columns)).isEmpty() and found.count() == expected.count()


def test_no_more_values_are_drawn_than_slots(spark, tmp_path, monkeypatch):
    drawn, done, ahead, pools = [], [], [], set()

    def values(df, column):
        for value in range(12):
            drawn.append(value)
            ahead.append(len(drawn) - len(done))
            yield value

    def work(df, column, value, transform, path, *rest):
        pools.add(df.sparkSession.sparkContext.getLocalProperty("spark.scheduler.pool"))
        time.sleep(0.05)
        done.append(value)
        return p._log_row(value, path)

    monkeypatch.setattr(p, "partition_values", values)
    monkeypatch.setattr(p, "process_partition", work)
    log = p.process_in_batches(spark.range(12).withColumnRenamed("id", "k"), "k", lambda df: df, str(tmp_path), at_once=3)
    assert [row.partition_value for row in log.collect()] == [str(n) for n in range(12)] and sorted(done) == list(range(12))
    assert max(ahead) <= 4 and pools == {"partitions-0", "partitions-1", "partitions-2"}


def test_a_stored_lake_holds_no_more_layers_than_asked_for(spark, tmp_path):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").limit(100)
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    for layer, held in (("bronze", [True, False, False]), ("silver", [True, True, False]), ("gold", [True, True, True])):
        lake = stored_lake(spark, str(tmp_path), layer)
        assert [layer_exists(spark, lake.layer(name)) for name in ("bronze", "silver", "gold")] == held
    assert read_layer(spark, lake.layer("bronze")).count() == 100


def test_files_of_the_same_names_are_written_by_many_tasks(spark, tmp_path):
    """The raw files of the query come from as many tasks as its input has splits."""
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").limit(1000)
    lines.repartition(8).write.parquet(str(tmp_path / "lineitem.parquet"))
    scratch = Path(checkpoint_root(spark).removeprefix("file:"))
    before = set(scratch.glob("raw-*"))
    assert ENTRIES["s13_land_same_names"].run(spark, str(tmp_path)).agg(F.sum("trip_count")).first()[0] == 1000
    (raw,) = set(scratch.glob("raw-*")) - before
    assert len({file.name for file in raw.rglob("*.parquet")}) > 1
