from datetime import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from meterline.operators.clean import clean
from meterline.operators.partitions import process_partitioned
from meterline.settings import WriteOptions
from meterline.sources import layers, scratch, sinks, tables
from meterline.sources.trips import with_months
from tests.making import trips


def january_and_february(spark, **change):
    days = [datetime(2024, 1, 5), datetime(2024, 1, 6), datetime(2024, 2, 5)]
    return trips(spark, *[{"tpep_pickup_datetime": day, **change} for day in days])


def months_of(df):
    return {(r.year, r.month): r["count"] for r in df.groupBy("year", "month").count().collect()}


def test_reading_nothing_is_an_error(spark):
    with pytest.raises(ValueError, match="no files"):
        layers.read_parquet(spark, [])


def test_schemas_are_merged(spark, tmp_path):
    df = trips(spark, {})
    df.drop("cbd_congestion_fee").write.parquet(str(tmp_path / "a"))
    df.withColumn("cbd_congestion_fee", F.lit(0.75)).write.parquet(str(tmp_path / "b"))
    merged = layers.read_parquet(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert sorted(row.cbd_congestion_fee or 0 for row in merged.collect()) == [0, 0.75]


def test_overwriting_a_month_leaves_the_others(spark, tmp_path):
    root = str(tmp_path / "silver")
    layers.write_layer(with_months(january_and_february(spark)), root, rebalance=True)
    again = with_months(january_and_february(spark)).where("month = 1").limit(1)
    layers.write_layer(again, root)
    assert months_of(layers.read_layer(spark, root)) == {(2024, 1): 1, (2024, 2): 1}


def test_layer_write_options(spark, tmp_path):
    root = str(tmp_path / "silver")
    df = with_months(january_and_february(spark)).repartition(8)
    layers.write_layer(df, root, WriteOptions(files=1))
    assert len(list((tmp_path / "silver" / "year=2024" / "month=1").glob("*.snappy.parquet"))) == 1
    with pytest.raises(Exception, match="exists"):
        layers.write_layer(df, root, WriteOptions(mode="error"))


def test_a_month_gets_its_files_from_tasks_of_its_own(spark, tmp_path):
    """Few files a month do not mean as few tasks for the whole layer."""
    root, months = str(tmp_path / "silver"), range(1, 13)
    df = with_months(trips(spark, *[{"tpep_pickup_datetime": datetime(2024, m, d)} for m in months for d in range(1, 11)]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layers.write_layer(df.repartition(8), root, WriteOptions(files=2))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    by_month = [[f.name[:10] for f in (tmp_path / "silver" / "year=2024" / f"month={m}").glob("*.parquet")] for m in months]
    assert all(1 <= len(names) <= 2 for names in by_month)
    assert len({name for names in by_month for name in names}) > 2
    assert months_of(layers.read_layer(spark, root)) == {(2024, m): 10 for m in months}


@pytest.mark.parametrize("write", ["layer", "landing", "partitioned"])
def test_partitioned_writes_do_not_sort(spark, tmp_path, monkeypatch, write):
    """What Spark would do for a write into month folders at the moment a layer is written."""
    plans = []

    def watched(real):
        def call(self, *args, **options):
            if not args[0].endswith(("-landed", "-journal")):
                plans.append("\n".join(row[0] for row in spark.sql("EXPLAIN INSERT INTO probe SELECT id, id % 9 FROM range(9)").collect()))
            return real(self, *args, **options)

        return call

    spark.sql(f"CREATE TABLE probe (id long, month long) USING parquet PARTITIONED BY (month) LOCATION '{tmp_path / 'probe'}'")
    try:
        for name in ("parquet", "save"):
            monkeypatch.setattr(DataFrameWriter, name, watched(getattr(DataFrameWriter, name)))
        df, root = january_and_february(spark), str(tmp_path / "out")
        if write == "layer":
            layers.write_layer(with_months(df), root)
        elif write == "landing":
            layers.land_bronze(spark, df, root)
        else:
            process_partitioned(with_months(df), ["year", "month"], lambda rows: rows, root)
    finally:
        spark.sql("DROP TABLE probe")
    assert plans and "WriteFiles" in plans[-1]
    assert any("Sort" not in text for text in plans)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_month_selection_prunes_partitions(spark, tmp_path):
    root = str(tmp_path / "silver")
    layers.write_layer(with_months(january_and_february(spark)), root)
    assert months_of(layers.read_layer(spark, root, 2024, [2])) == {(2024, 2): 1}
    assert months_of(layers.read_layer(spark, root, 2024)) == {(2024, 1): 2, (2024, 2): 1}
    assert months_of(layers.read_layer(spark, root, 2023)) == {}
    plan = layers.read_layer(spark, root, 2024, [2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(month" in plan


def test_a_source_is_landed_once_and_no_month_keeps_rows_out(spark, tmp_path):
    root = str(tmp_path / "bronze")
    january = january_and_february(spark).where("month(tpep_pickup_datetime) = 1")
    first = layers.land_bronze(spark, january.limit(1), root, source="a")
    assert [(r.source, r.year, r.month, r.rows) for r in first.collect()] == [("a", 2024, 1, 1)]
    second = layers.land_bronze(spark, january_and_february(spark), root, source="b")
    assert {(r.month, r.rows) for r in second.collect()} == {(1, 2), (2, 1)}
    assert months_of(layers.read_layer(spark, root)) == {(2024, 1): 3, (2024, 2): 1}
    assert layers.land_bronze(spark, january_and_february(spark), root, source="b").isEmpty()
    assert months_of(layers.read_layer(spark, root)) == {(2024, 1): 3, (2024, 2): 1}


def test_landing_under_a_nominal_month_and_without_a_pickup(spark, tmp_path):
    root = str(tmp_path / "bronze")
    stray = trips(spark, {"tpep_pickup_datetime": None}, {})
    for _ in range(2):
        layers.land_bronze(spark, stray, root, month=(2025, 3))
        assert months_of(layers.read_layer(spark, root)) == {(2025, 3): 2}
    other = str(tmp_path / "other")
    for times in (1, 2):
        layers.land_bronze(spark, stray, other)
        assert months_of(layers.read_layer(spark, other)) == {(2024, 1): times, (None, None): times}


def test_files_that_differ_are_conformed_one_by_one(spark, tmp_path, caplog):
    raw, root = tmp_path / "raw", str(tmp_path / "bronze")
    good = trips(spark, {"passenger_count": 3})
    good.drop("cbd_congestion_fee").coalesce(1).write.parquet(str(raw))
    text = good.withColumn("passenger_count", F.lit("many")).withColumn("unknown", F.lit(1))
    text.coalesce(1).write.mode("append").parquet(str(raw))
    assert layers.land_files(spark, str(raw), root).agg(F.sum("rows")).first()[0] == 2
    assert sorted(r.passenger_count or 0 for r in layers.read_layer(spark, root).collect()) == [0, 3]
    assert "passenger_count" in caplog.text
    assert layers.land_files(spark, str(raw), root).isEmpty()


class Stopped(Exception):
    """The driver is gone."""


@pytest.mark.parametrize("step", ["begin", "write", "end"])
def test_a_landing_that_dies_is_repeated(spark, tmp_path, monkeypatch, step):
    """Stopped before the data, between data and notes, or in the repair: every row is there once."""
    raw, root = tmp_path / "raw", str(tmp_path / "bronze")
    january_and_february(spark).coalesce(1).write.parquet(str(raw / "a"))
    layers.land_files(spark, str(raw), root)
    january_and_february(spark, VendorID=2).coalesce(1).write.parquet(str(raw / "b"))
    owner, name = {"begin": (layers.journal, "begin"), "write": (layers, "write_layer"), "end": (layers.journal, "end")}[step]
    real = getattr(owner, name)

    def stop(*args, **kwargs):
        if step == "write":
            real(*args, **kwargs)
        raise Stopped

    def die(*args, **kwargs):
        raise Stopped

    with monkeypatch.context() as patch:
        patch.setattr(owner, name, stop)
        with pytest.raises(Stopped):
            layers.land_files(spark, str(raw), root)
    assert layers.landed(spark, root).agg(F.sum("rows")).first()[0] == 3
    if step == "write":
        assert sum(months_of(layers.read_layer(spark, root)).values()) == 6
        # and the repair dies too, before its copy is noted as done
        with monkeypatch.context() as patch:
            patch.setattr(layers.journal, "end", die)
            with pytest.raises(Stopped):
                layers.land_files(spark, str(raw), root)
    landed = layers.land_files(spark, str(raw), root)
    assert landed.agg(F.sum("rows")).first()[0] == 3
    assert months_of(layers.read_layer(spark, root)) == {(2024, 1): 4, (2024, 2): 2}
    assert layers.read_layer(spark, root).where("VendorID = 2").count() == 3
    assert layers.landed(spark, root).agg(F.sum("rows")).first()[0] == 6
    assert layers.land_files(spark, str(raw), root).isEmpty()
    assert layers.LANDING not in layers.read_layer(spark, root).columns


def test_a_repair_that_leaves_a_month_empty(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "bronze")
    stray = trips(spark, {"tpep_pickup_datetime": None}, {})
    with monkeypatch.context() as patch:
        patch.setattr(layers.journal, "end", lambda *a, **k: (_ for _ in ()).throw(Stopped()))
        with pytest.raises(Stopped):
            layers.land_bronze(spark, stray, root, source="a")
    assert len(layers.repair(spark, root)) == 1 and layers.repair(spark, root) == []
    assert layers.read_layer(spark, root).isEmpty()
    for _ in range(2):
        layers.land_bronze(spark, stray, root, source="a")
        assert months_of(layers.read_layer(spark, root)) == {(2024, 1): 1, (None, None): 1}


def test_raw_files_in_folders_of_any_name(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "bronze")
    for n, folder in enumerate(("2024/01", "2024/02", "kind=a/deep", "kind=b/deep")):
        trips(spark, *[{"VendorID": n}] * (n + 1)).coalesce(1).write.parquet(str(tmp_path / f"made{n}"))
        (file,) = (tmp_path / f"made{n}").glob("*.parquet")
        target = raw / folder / "trips.parquet"
        target.parent.mkdir(parents=True)
        target.write_bytes(file.read_bytes())
    landed = layers.land_files(spark, str(raw), root, {"trips.parquet": (2031, 5)}).collect()
    assert sorted(row.rows for row in landed) == [1, 2, 3, 4] and len({row.source for row in landed}) == 4
    assert months_of(layers.read_layer(spark, root)) == {(2031, 5): 10}
    assert layers.land_files(spark, str(raw), root).isEmpty()
    (tmp_path / "nothing").mkdir()
    with pytest.raises(ValueError, match="no raw files"):
        layers.land_files(spark, str(tmp_path / "nothing"), root)


def test_plan_and_jobs_grow_with_schemas(spark, tmp_path, caplog):
    """Forty files of two schemas: two branches, and the lost values are counted by the job that writes."""
    raw, root = tmp_path / "raw", str(tmp_path / "bronze")
    whole = trips(spark, *[{"passenger_count": n % 5} for n in range(200)])
    whole.repartition(20).write.parquet(str(raw / "new"))
    text = whole.withColumn("passenger_count", F.when(F.col("passenger_count") == 4, "many").otherwise(F.col("passenger_count").cast("string")))
    text.repartition(20).write.parquet(str(raw / "old"))
    paths = [row.path for row in layers.listed_files(spark, str(raw), recursive=True).select("path").collect()]
    groups = layers.schema_groups(spark, paths)
    assert sorted(len(files) for _, files in groups) == [20, 20] and len(paths) == 40
    assert layers.land_files(spark, str(raw), root).agg(F.sum("rows")).first()[0] == 400
    assert layers.read_layer(spark, root).where("passenger_count IS NULL").count() == 40
    assert caplog.text.count("'passenger_count': 40") == 1


def test_a_changed_file_is_told_and_left_alone(spark, tmp_path, caplog):
    raw, root = tmp_path / "raw", str(tmp_path / "bronze")
    trips(spark, {}).coalesce(1).write.parquet(str(raw))
    layers.land_files(spark, str(raw), root)
    trips(spark, {}, {}, {}).coalesce(1).write.parquet(str(tmp_path / "other"))
    (file,), (other,) = raw.glob("*.parquet"), (tmp_path / "other").glob("*.parquet")
    file.write_bytes(other.read_bytes())
    for crc in raw.glob(".*.crc"):
        crc.write_bytes((tmp_path / "other" / f".{other.name}.crc").read_bytes())
    assert layers.land_files(spark, str(raw), root).isEmpty() and "changed since" in caplog.text
    assert layers.read_layer(spark, root).count() == 1


def test_a_replaced_month_without_rows_becomes_empty(spark, tmp_path):
    root = str(tmp_path / "silver")
    df = with_months(january_and_february(spark))
    layers.write_layer(df, root)
    layers.write_layer(df.where("month = 2"), root, replaces=[(2024, 1), (2024, 2), (2024, 3)])
    assert months_of(layers.read_layer(spark, root)) == {(2024, 2): 1}


def test_missing_and_empty_layers(spark, tmp_path):
    assert not layers.layer_exists(spark, str(tmp_path / "none"))
    assert layers.months_present(spark, str(tmp_path / "none")).isEmpty()
    df = trips(spark, {})
    assert layers.require_rows(df) is df
    assert layers.require_rows(df.where("VendorID = 9")) is None


def test_tables(spark, tmp_path):
    df = with_months(january_and_february(spark))
    bronze = layers.write_layer(df, str(tmp_path / "bronze"))
    silver = layers.write_layer(clean(df.withColumn("tpep_dropoff_datetime", F.expr("tpep_pickup_datetime + INTERVAL 9 MINUTES"))), str(tmp_path / "silver"))
    for _ in range(2):
        names = tables.create_tables(spark, {"bronze": bronze, "silver": silver}, "test_trips")
        assert tables.refresh_partitions(spark, names).count() == 4
    summary = {row.table_name: (row.column_count, row.trip_count) for row in tables.table_summary(spark, "test_trips").collect()}
    assert summary == {"bronze_trips": (22, 3), "silver_trips": (23, 3)}
    assert spark.sql("SELECT count(*) FROM test_trips.silver_trips WHERE year = 2024 AND month = 1").first()[0] == 2
    with pytest.raises(ValueError):
        spark.sql("CREATE DATABASE IF NOT EXISTS nothing_here")
        tables.table_summary(spark, "nothing_here")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    path = sinks.write_csv(df, str(tmp_path / "csv"))
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 1
    assert spark.read.option("header", True).schema("n int, s string").csv(path).exceptAll(df).isEmpty()
    assert spark.read.json(sinks.write_as(df, str(tmp_path / "json"), "json")).count() == 2
    report = sinks.write_report(df, str(tmp_path), datetime(2024, 5, 6, 7, 8, 9))
    assert report.endswith("validation_report_20240506_070809")
    assert spark.read.parquet(sinks.write_mart(df, "mart", str(tmp_path))).count() == 2


def test_a_jdbc_target_goes_to_the_jdbc_writer():
    """Without a database: only what the writer is asked to do."""
    calls = []

    class Writer:
        def jdbc(self, **arguments):
            calls.append(arguments)

    class Frame:
        write = Writer()

    name = sinks.write_mart(Frame(), "gold_recent_trips", "jdbc:postgresql://host/db", {"user": "u"})
    assert name == "gold_recent_trips"
    assert calls == [
        {
            "url": "jdbc:postgresql://host/db",
            "table": "gold_recent_trips",
            "mode": "overwrite",
            "properties": {"user": "u"},
        }
    ]


def test_scratch_follows_the_session(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert shared in scratch.ensure_checkpoint_dir(spark)
    first, second = scratch.scratch_path(spark, "x"), scratch.scratch_path(spark, "x")
    assert first != second and shared in first
    assert scratch.checkpointed(spark.range(5)).count() == 5


def test_lineage_is_kept_where_spark_refuses_a_checkpoint(spark, tmp_path, caplog):
    scratch.ensure_checkpoint_dir(spark)
    folder = spark.sparkContext.getCheckpointDir()
    bad = spark.range(3).selectExpr("raise_error('no') AS x")
    same, done = scratch.cut_lineage(bad)
    assert same is bad and not done and "lineage kept" in caplog.text
    elsewhere, done = scratch.cut_lineage(spark.range(3), str(tmp_path / "elsewhere"), eager=False)
    assert done and elsewhere.count() == 3
    assert spark.sparkContext.getCheckpointDir() == folder


def test_only_sparks_refusals_are_caught(spark, monkeypatch):
    df = spark.range(3)
    monkeypatch.setattr(type(df), "checkpoint", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        scratch.cut_lineage(df)
