import math
import random
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators import quality as q
from meterline.operators.clean import add_duration
from meterline.schema import GOLD_COLUMNS, ColumnRule, rules_for
from meterline.settings import QualityLimits
from meterline.suite.frames import full_gold, silver
from tests.making import after, trips

NAN = float("nan")


def metrics(report) -> dict:
    return {(row.check, row.column): row.metric for row in report.collect()}


def rows_of(report) -> dict:
    return {(row.check, row.column): row for row in report.collect()}


def test_accepted_types():
    assert q.type_matches(T.StringType(), "string")
    assert q.type_matches(T.FloatType(), "double")
    assert q.type_matches(T.TimestampNTZType(), "timestamp")
    assert q.type_matches(T.TimestampType(), "timestamp_ntz")
    assert q.type_matches(T.IntegerType(), "anything else")
    assert not q.type_matches(T.IntegerType(), "long")
    assert not q.type_matches(T.StringType(), "integer")


def test_schema_checks(spark):
    df = trips(spark, {}).select(F.col("VendorID").cast("long"), "extra", F.lit("x").alias("note"))
    rules = [ColumnRule("VendorID", "integer"), ColumnRule("extra", "double"), ColumnRule("gone", "string")]
    found = {(c.check, c.column): c.severity for c in q.schema_checks(df.schema, rules)}
    assert found == {
        ("missing_column", "gone"): "error",
        ("extra_column", "note"): "error",
        ("column_type", "VendorID"): "error",
        ("column_nullable", "VendorID"): "ok",
        ("column_type", "extra"): "ok",
        ("column_nullable", "extra"): "ok",
    }
    lenient = QualityLimits(allow_extra_columns=True, allow_missing_columns=True, strict=False, column_order=True)
    rules = [ColumnRule("extra", "double", nullable=False), ColumnRule("VendorID", "long"), ColumnRule("gone", "long")]
    found = {(c.check, c.column): c.severity for c in q.schema_checks(df.schema, rules, lenient)}
    assert found[("missing_column", "gone")] == found[("extra_column", "note")] == "warning"
    assert found[("column_nullable", "extra")] == "warning"
    assert found[("column_order", "")] == "error"


def test_row_count(spark):
    few = rows_of(q.run_checks(trips(spark, {}), q.completeness_checks(), "bronze"))[("row_count", "")]
    assert (few.metric, few.threshold, few.severity, few.valid) == (1.0, 1000.0, "error", False)
    enough = q.run_checks(trips(spark, {}), q.completeness_checks(QualityLimits(min_rows=1)), "bronze").first()
    assert (enough.severity, enough.valid) == ("ok", True)


def test_speed_precedence(spark):
    # 10 minutes: 4.9, 5, 60 and 60.1 mph, then no and negative duration
    miles = (4.9 / 6, 5 / 6, 10.0, 60.1 / 6)
    df = trips(
        spark,
        *[{"trip_distance": d} for d in miles],
        {"tpep_dropoff_datetime": after(0)},
        {"tpep_dropoff_datetime": after(-10)},
        {"trip_distance": None},
    )
    checks = [c for c in q.business_checks(add_duration(df).columns) if c.check == "speed"]
    assert metrics(q.run_checks(add_duration(df), checks, "x")) == {("speed", "trip_distance"): 2.0}


def test_ranges_and_values(spark):
    df = trips(
        spark,
        {"PULocationID": "0", "fare_amount": 0.0},
        {"PULocationID": "x", "fare_amount": 500.0},
        {"PULocationID": None, "fare_amount": 500.1},
        {"PULocationID": "266", "fare_amount": NAN},
        {"PULocationID": "265", "fare_amount": None, "VendorID": 6, "store_and_fwd_flag": None},
    )
    rules = rules_for("bronze")
    found = metrics(q.run_checks(df, q.range_checks(df.schema, rules) + q.allowed_value_checks(df.columns, rules), "x"))
    assert found[("range", "PULocationID")] == 2
    assert found[("range", "fare_amount")] == 2
    assert found[("allowed_values", "VendorID")] == 1
    assert found[("allowed_values", "store_and_fwd_flag")] == 0


def test_nulls(spark):
    df = trips(spark, {"extra": None, "RatecodeID": None}, {}, {"extra": None})
    rules = [ColumnRule("extra", "double"), ColumnRule("RatecodeID", "long", nullable=False), ColumnRule("VendorID", "integer")]
    found = rows_of(q.run_checks(df, q.null_checks(df.columns, rules), "x"))
    assert found[("null_percent", "extra")].severity == "warning"
    assert found[("null_percent", "extra")].metric == pytest.approx(200 / 3)
    assert (found[("null_count", "RatecodeID")].severity, found[("null_count", "RatecodeID")].valid) == ("error", False)
    assert found[("null_percent", "VendorID")].metric == 0
    empty = rows_of(q.run_checks(df.limit(0), q.null_checks(df.columns, rules), "x"))
    assert empty[("null_percent", "extra")].metric == 0


@pytest.mark.parametrize(("copies", "severity"), [(0, "ok"), (5, "warning"), (6, "error")])
def test_duplicates_against_the_limit(spark, copies, severity):
    base = spark.range(500 - copies).selectExpr("id", "cast(id % 7 as double) AS v")
    df = base.union(base.where(f"id < {copies}"))
    found = rows_of(q.duplicate_report(df, "x"))
    assert found[("duplicate_rows", "count")].metric == copies
    assert found[("duplicate_rows", "percent")].metric == pytest.approx(copies / 5)
    assert found[("duplicate_rows", "percent")].severity == severity
    assert found[("duplicate_rows", "percent")].valid == (severity != "error")


def one_hash(*columns):
    """All rows collide."""
    return F.lit(0).cast("long")


@pytest.mark.parametrize("hash_of", [F.xxhash64, one_hash])
def test_duplicates_of_special_values_and_heavy_groups(spark, hash_of):
    df = spark.sql(
        "SELECT * FROM VALUES (double('NaN'), 0.0D, 'a'), (double('NaN'), -0.0D, 'a'), (1.0D, NULL, NULL),"
        " (1.0D, NULL, NULL), (1.0D, NULL, ''), (NULL, 1.0D, NULL) AS t(a, b, c)"
    )
    heavy = df.union(spark.range(3000).selectExpr("7.0D AS a", "7.0D AS b", "'hot' AS c"))
    row = q.duplicate_counts(heavy, hash_of).first()
    assert row.total_rows == 3006
    assert row.distinct_rows == heavy.distinct().count()
    assert row.duplicate_count == row.total_rows - row.distinct_rows
    empty = q.duplicate_counts(df.limit(0), hash_of).first()
    assert tuple(empty) == (0, 0, 0)


def test_one_pass_equals_a_count_per_check(spark, sf_dir):
    df = silver(spark, sf_dir)
    rules, limits = rules_for("silver"), QualityLimits(schema=False)
    found = metrics(q.run_checks(df, q.data_checks(df, rules, limits), "silver"))
    rows = df.count()
    assert found[("total_rows", "")] == found[("row_count", "")] == rows
    for rule in rules:
        assert found[("null_count", rule.name)] == df.where(F.col(rule.name).isNull()).count()
        if rule.valid_range is not None:
            low, high = rule.valid_range
            value = F.col(rule.name).cast("int") if rule.type == "string" else F.col(rule.name)
            assert found[("range", rule.name)] == df.where((value < low) | (value > high)).count()


def test_verdict_ignores_warnings_and_optionally_nulls(spark):
    schema = q.REPORT_SCHEMA
    warned = [("gold", "range", "a", 3.0, 0.0, "warning", True), ("gold", "null_count", "b", 1.0, 0.0, "error", False)]
    report = spark.createDataFrame(warned, schema)
    assert q.verdict(report).first().overall_valid
    strict = QualityLimits(nulls_decide=True)
    assert not q.verdict(report, strict).first().overall_valid
    q.enforce(report)
    with pytest.raises(q.ValidationFailed, match="null_count"):
        q.enforce(report, strict)
    few = spark.createDataFrame([("gold", "row_count", "", 3.0, 1000.0, "error", False)], schema)
    row = q.verdict(few).first()
    assert (row.schema_valid, row.data_valid, row.overall_valid, row.errors) == (True, False, False, 1)


def test_watched_write_gives_the_same_report(spark, sf_dir, tmp_path):
    gold, rules = full_gold(spark, sf_dir), rules_for("gold")
    watched = q.WatchedWrite(gold, rules)
    watched.df.write.parquet(str(tmp_path / "gold"))
    limits = QualityLimits(duplicates=False)
    seen, asked = watched.report(), q.validate(gold, rules, limits)
    assert seen.exceptAll(asked).isEmpty() and asked.exceptAll(seen).isEmpty()


def test_rules_of_the_layers():
    assert [rule.name for rule in rules_for("gold")] == GOLD_COLUMNS
    gold = rules_for("gold")
    assert sum(rule.valid_range is not None for rule in gold) == 35
    assert sum(rule.valid_values is not None for rule in gold) == 5
    assert sum(not rule.nullable for rule in gold) == 9
    assert all(rule.nullable for rule in rules_for("bronze"))
    with pytest.raises(ValueError):
        rules_for("platinum")


def test_outliers(spark):
    df = spark.range(100).selectExpr("cast(id as double) AS v").union(spark.sql("SELECT 1000.0D AS v"))
    assert metrics(q.run_checks(df, q.iqr_outliers(df, ["v"]), "x")) == {("iqr_outliers", "v"): 1.0}
    assert metrics(q.run_checks(df, q.zscore_outliers(df, ["v"]), "x")) == {("zscore_outliers", "v"): 1.0}
    nothing = df.where("v < 0")
    assert q.iqr_outliers(nothing, ["v"]) == [] and q.zscore_outliers(nothing, ["v"]) == []


def test_iqr_against_brute_force(spark, sf_dir):
    df = silver(spark, sf_dir)
    values = sorted(row.fare_amount for row in df.select("fare_amount").collect())
    import math

    low, high = (values[math.ceil(len(values) * share) - 1] for share in (0.25, 0.75))
    reach = 1.5 * (high - low)
    expected = sum(v < low - reach or v > high + reach for v in values)
    assert metrics(q.run_checks(df, q.iqr_outliers(df, ["fare_amount"]), "x")) == {
        ("iqr_outliers", "fare_amount"): expected
    }


@pytest.mark.parametrize("few", [5, 10_000])
def test_quantiles_are_exact(spark, monkeypatch, few):
    """Of values of all magnitudes, with ties, nulls, NaN and infinities."""
    monkeypatch.setattr(q, "FEW", few)
    monkeypatch.setattr(q, "HISTOGRAM", 16)
    draw = random.Random(few)
    columns = {
        "wide": [draw.choice([-1, 1]) * 10 ** draw.uniform(-300, 300) for _ in range(700)],
        "ties": [draw.choice([1.0, 2.0, 2.0, 2.0, 7.5, None]) for _ in range(700)],
        "close": [1.0 + draw.randrange(40) * 2.0**-52 for _ in range(700)],
        "ends": [draw.choice([1.7e308, -1.7e308, 5e-324, 0.0, -5e-324, float("nan"), 3.0]) for _ in range(700)],
        "none": [None] * 700,
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{name} double" for name in columns)).repartition(6)
    shares = (0.0, 0.25, 0.5, 0.75, 0.999, 1.0)
    found = q.exact_quantiles(df, list(columns), shares)
    for name, values in columns.items():
        held = sorted(v for v in values if v is not None and v == v)
        assert found[name] == ([held[max(1, math.ceil(s * len(held))) - 1] for s in shares] if held else None)


@pytest.mark.parametrize("hash_of", [F.xxhash64, lambda *columns: F.xxhash64(*columns) % 3])
def test_conditions_go_with_the_hash(spark, hash_of):
    """As many conditions as need two marks, over repeated rows and rows that share a hash."""
    rows = [(n % 40, None if n % 4 == 0 else float(n % 5)) for n in range(400)]
    df = spark.createDataFrame(rows, "a int, b double").repartition(5)
    conditions = ["b IS NULL", "b > 3", *[f"a = {n} OR b < 1" for n in range(70)]]
    total, duplicates, counted = q.duplicates_and_conditions(df, conditions, hash_of)
    assert (total, duplicates) == (400, 400 - len(set(rows)))
    assert counted == {c: df.where(c).count() for c in conditions}
    nothing = q.duplicates_and_conditions(df.limit(0), conditions, hash_of)
    assert nothing == (0, 0, dict.fromkeys(conditions, 0))


def test_validation_computes_the_frame_once(spark, sf_dir):
    """With duplicates, too: rows are neither read nor given their features a second time."""
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    gold = full_gold(spark, sf_dir).localCheckpoint()
    df, rules = gold.mapInArrow(passed, gold.schema), rules_for("gold")
    report = q.validate(df, rules).collect()
    assert seen.value == gold.count()
    alone = q.run_checks(gold, q.data_checks(df, rules), "gold").union(q.duplicate_report(gold, "gold"))
    assert sorted(map(str, report)) == sorted(map(str, alone.collect()))
