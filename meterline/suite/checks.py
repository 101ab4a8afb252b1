"""Queries for the schema and data-quality operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators import quality as q
from meterline.operators.features import add_distance_features, add_flag_features, add_ratio_features
from meterline.plans.stages import build_silver, validate_layer
from meterline.schema import CRITICAL, FILL_VALUES, GOLD_COLUMNS, GOLD_RULES, SILVER_COLUMNS, rules_for
from meterline.settings import CleaningLimits, QualityLimits
from meterline.sources.layers import land_bronze, read_layer
from meterline.sources.scratch import scratch_path
from meterline.sources.sinks import write_report
from meterline.sources.trips import trips_view
from meterline.suite import oracle as o
from meterline.suite.frames import Entry, bronze, empty_lake, full_gold, gold, rounded, silver, stored_lake

ENTRIES: dict[str, Entry] = {}
RULES = {name: rest for name, *rest in GOLD_RULES}


def entry(name: str, sql: str | None = None):
    def register(run):
        ENTRIES[name] = Entry(run, sql)
        return run

    return register


# --- SQL of report rows --------------------------------------------------------------------------


def sql_row(
    table: str,
    check: str,
    column: str,
    metric: str,
    threshold: float | None = 0.0,
    severity: str = "warning",
    below: bool = False,
    scope: str = "gold",
    fixed: str | None = None,
) -> str:
    """One report row; ``fixed`` is a severity that holds whatever the metric."""
    limit = "CAST(NULL AS DOUBLE)" if threshold is None else f"CAST({threshold} AS DOUBLE)"
    fails = f"m {'<' if below else '>'} {threshold}"
    if fixed is not None:
        outcome, valid = f"'{fixed}'", str(fixed != "error")
    elif threshold is None:
        outcome, valid = "'ok'", "true"
    else:
        outcome = f"CASE WHEN {fails} THEN '{severity}' ELSE 'ok' END"
        valid = f"NOT ({fails})" if severity == "error" else "true"
    return (
        f"SELECT '{scope}' AS scope, '{check}' AS \"check\", '{column}' AS \"column\", m AS metric,"
        f" {limit} AS threshold, {outcome} AS severity, {valid} AS valid"
        f" FROM (SELECT round(CAST({metric} AS DOUBLE), 9) AS m FROM {table})"
    )


def counting(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def sql_schema(table: str, columns: dict[str, str], scope: str = "gold", strict: bool = True) -> list[str]:
    """Schema rows: ``columns`` maps the columns of ``table`` to their declared type."""
    rows = [
        sql_row(table, "missing_column", name, "count(*)", None, fixed="error", scope=scope)
        for name in RULES
        if name not in columns
    ]
    for name, kind in columns.items():
        if name not in RULES:
            rows.append(sql_row(table, "extra_column", name, "count(*)", None, fixed="error", scope=scope))
            continue
        expected, nullable = RULES[name][0], RULES[name][1]
        rows.append(
            sql_row(
                table, "column_type", name, "count(*)", None, fixed="ok" if kind == expected else "error", scope=scope
            )
        )
        agrees = nullable != (name in NEVER_NULL)
        wrong = "error" if strict else "warning"
        rows.append(
            sql_row(table, "column_nullable", name, "count(*)", None, fixed="ok" if agrees else wrong, scope=scope)
        )
    return rows


# columns that are non-null by construction, and that Spark's schema gives as such
NEVER_NULL = (
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "route_id",
    "has_tolls",
    "has_airport_fee",
    "has_congestion_fee",
    "passenger_count",
    "store_and_fwd_flag",
    "congestion_surcharge",
    "Airport_fee",
    "RatecodeID",
)

ROW_COUNT = sql_row("{t}", "row_count", "", "count(*)", 1000, "error", below=True)


def sql_consistency(table: str) -> list[str]:
    return [
        sql_row(
            table, "duration", "trip_duration_min", counting("trip_duration_min < 10 / 60e0 OR trip_duration_min > 180")
        ),
        sql_row(
            table, "cyclic_identity", "hour", counting("abs(pow(sin_hour, 2) + pow(cos_hour, 2) - 1) > 1e-2")
        ),
        sql_row(
            table,
            "cyclic_identity",
            "day_of_week",
            counting("abs(pow(sin_day_of_week, 2) + pow(cos_day_of_week, 2) - 1) > 1e-2"),
        ),
    ]


MPH = "trip_distance / nullif(trip_duration_min / 60e0, 0)"
SPEED = f"(trip_duration_min > 0 AND {MPH} < 5) OR {MPH} > 60"


def sql_business(table: str) -> list[str]:
    return [
        sql_row(
            table, "route_id", "route_id", counting("route_id <> concat_ws('_', PULocationID, DOLocationID)")
        ),
        sql_row(table, "tip", "tip_amount", counting("tip_amount > fare_amount * 2e0")),
        sql_row(table, "speed", "trip_distance", counting(SPEED)),
    ]


def sql_ranges(table: str, names=GOLD_COLUMNS, scope: str = "gold") -> list[str]:
    rows = []
    for name in names:
        if name in RULES and RULES[name][2] is not None:
            low, high = RULES[name][2]
            value = f"TRY_CAST({name} AS INT)" if RULES[name][0] == "string" else name
            rows.append(
                sql_row(table, "range", name, counting(f"{value} < {low} OR {value} > {high}"), scope=scope)
            )
    return rows


def sql_values(table: str, names=GOLD_COLUMNS, scope: str = "gold") -> list[str]:
    rows = []
    for name in names:
        if name in RULES and RULES[name][3] is not None:
            allowed = ", ".join(repr(value) for value in RULES[name][3])
            rows.append(
                sql_row(table, "allowed_values", name, counting(f"{name} NOT IN ({allowed})"), scope=scope)
            )
    return rows


def sql_nulls(table: str, names=GOLD_COLUMNS, scope: str = "gold", always_nullable: bool = False) -> list[str]:
    rows = []
    for name in names:
        nullable = always_nullable or name not in RULES or RULES[name][1]
        nulls = f"count(*) - count({name})"
        percent = f"coalesce(({nulls}) / nullif(count(*), 0)::DOUBLE * 100, 0)"
        if nullable:
            rows.append(sql_row(table, "null_count", name, nulls, None, scope=scope))
            rows.append(sql_row(table, "null_percent", name, percent, 50, scope=scope))
        else:
            rows.append(sql_row(table, "null_count", name, nulls, 0, "error", scope=scope))
            rows.append(sql_row(table, "null_percent", name, percent, None, scope=scope))
    return rows


def sql_totals(table: str, columns: int, scope: str = "gold") -> list[str]:
    return [
        sql_row(table, "total_rows", "", "count(*)", None, scope=scope),
        sql_row(table, "total_columns", "", f"max({columns})", None, scope=scope),
    ]


def sql_duplicates(table: str, columns: str, scope: str = "gold") -> list[str]:
    counts = f"(SELECT count(*) AS n, (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {table})) AS d FROM {table})"
    body = (
        "SELECT '{scope}' AS scope, 'duplicate_rows' AS \"check\", '{column}' AS \"column\", {metric} AS metric,"
        " CAST(1 AS DOUBLE) AS threshold,"
        " CASE WHEN (n - d) * 1e2 / n > 1 THEN 'error' WHEN n > d THEN 'warning' ELSE 'ok' END AS severity,"
        " NOT ((n - d) * 1e2 / n > 1) AS valid FROM {counts}"
    )
    return [
        body.format(scope=scope, column="count", metric="CAST(n - d AS DOUBLE)", counts=counts),
        body.format(scope=scope, column="percent", metric="round((n - d) / CAST(n AS DOUBLE) * 100, 9)", counts=counts),
    ]


def union(rows: list[str]) -> str:
    return "\nUNION ALL ".join(rows)


def report(df: DataFrame) -> DataFrame:
    return rounded(df, "metric", digits=9)


# --- schema --------------------------------------------------------------------------------------

GOLD_TYPES = {name: rule[0] for name, rule in RULES.items()}
SILVER_TYPES = {
    name: RULES[name][0] if name in RULES else ("double" if name == "total_amount" else "timestamp_ntz")
    for name in SILVER_COLUMNS
}


def schema_query(*checks: str, limits: QualityLimits = QualityLimits()):
    """Silver against the gold rules, which it cannot meet: some columns are missing, two are extra."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        trips = silver(spark, sf_dir)
        found = [c for c in q.schema_checks(trips.schema, rules_for("gold"), limits) if c.check in checks]
        return report(q.run_checks(trips, found, "gold"))

    return run


def schema_sql(*checks: str, strict: bool = True) -> str:
    return o.over_silver(
        "SELECT * FROM ("
        + union(sql_schema("silver", SILVER_TYPES, strict=strict))
        + ') WHERE "check" IN ('
        + ", ".join(f"'{check}'" for check in checks)
        + ")"
    )


ENTRIES["v01_missing_columns"] = Entry(schema_query("missing_column"), schema_sql("missing_column"))
ENTRIES["v02_extra_columns"] = Entry(schema_query("extra_column"), schema_sql("extra_column"))
ENTRIES["v04_nullability"] = Entry(schema_query("column_nullable"), schema_sql("column_nullable"))
ENTRIES["v04_nullability_lenient"] = Entry(
    schema_query("column_nullable", limits=QualityLimits(strict=False)), schema_sql("column_nullable", strict=False)
)


@entry(
    "v03_column_types",
    o.over_silver(
        union(
            [
                sql_row("silver", "column_type", name, "count(*)", None, fixed="error" if wrong else "ok")
                for name, wrong in (
                    ("DOLocationID", True),
                    ("passenger_count", True),
                    ("trip_distance", False),
                    ("tpep_pickup_datetime", False),
                    ("store_and_fwd_flag", False),
                )
            ]
        )
    ),
)
def v03(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integers where text or a long is due; a float for a double and a timestamp for an NTZ one pass."""
    trips = silver(spark, sf_dir).select(
        F.col("DOLocationID").cast("int"),
        F.col("passenger_count").cast("int"),
        F.col("trip_distance").cast("float"),
        F.col("tpep_pickup_datetime").cast("timestamp"),
        "store_and_fwd_flag",
    )
    found = [c for c in q.schema_checks(trips.schema, rules_for("gold")) if c.check == "column_type"]
    return report(q.run_checks(trips, found, "gold"))


# --- data ----------------------------------------------------------------------------------------


def checks_query(make):
    """Selected checks over gold trips without frequencies."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        trips = gold(spark, sf_dir)
        return report(q.run_checks(trips, make(trips), "gold"))

    return run


def named(checks, *names: str):
    return [check for check in checks if check.check in names]


ENTRIES["v05_row_count"] = Entry(
    checks_query(lambda df: q.completeness_checks()), o.over_features(ROW_COUNT.format(t="gold_base"))
)
ENTRIES["v06_duration"] = Entry(
    checks_query(lambda df: named(q.consistency_checks(df.columns), "duration")),
    o.over_features(sql_consistency("gold_base")[0]),
)
ENTRIES["v07_cyclic_identity"] = Entry(
    checks_query(lambda df: named(q.consistency_checks(df.columns), "cyclic_identity")),
    o.over_features(union(sql_consistency("gold_base")[1:])),
)
for _position, _name in enumerate(("v08_route_id", "v09_tip", "v10_speed")):
    ENTRIES[_name] = Entry(
        checks_query(lambda df, check=_name[4:]: named(q.business_checks(df.columns), check)),
        o.over_features(sql_business("gold_base")[_position]),
    )


@entry(
    "v09_tip_before_cleaning",
    o.over_bronze(sql_row("bronze", "tip", "tip_amount", counting("tip_amount > fare_amount * 2e0"), scope="bronze")),
)
def v09_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = bronze(spark, sf_dir)
    return report(q.run_checks(trips, named(q.business_checks(trips.columns), "tip"), "bronze"))


COUNTS = ("pickup_zone_trip_count", "dropoff_zone_trip_count", "route_trip_count")


@entry("v11_ranges", o.over_gold(union(sql_ranges("gold_wide"))))
def v11(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = full_gold(spark, sf_dir)
    return report(q.run_checks(trips, q.range_checks(trips.schema, rules_for("gold")), "gold"))


ENTRIES["v12_allowed_values"] = Entry(
    checks_query(lambda df: q.allowed_value_checks(df.columns, rules_for("gold"))),
    o.over_features(union(sql_values("gold_base"))),
)
ENTRIES["v13_nulls"] = Entry(
    checks_query(lambda df: q.null_checks(df.columns, rules_for("gold"))),
    o.over_features(union(sql_nulls("gold_base", [n for n in GOLD_COLUMNS if n not in COUNTS]))),
)


@entry(
    "v13_nulls_before_cleaning",
    o.over_bronze(
        union(
            sql_nulls("bronze", [n for n in SILVER_COLUMNS if n != "trip_duration_min"], "bronze", always_nullable=True)
        )
    ),
)
def v13_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = bronze(spark, sf_dir)
    return report(q.run_checks(trips, q.null_checks(trips.columns, rules_for("bronze")), "bronze"))


ENTRIES["v15_totals"] = Entry(
    checks_query(lambda df: q.total_checks(df.columns)),
    o.over_features(union(sql_totals("gold_base", len(GOLD_COLUMNS) - len(COUNTS) + 2))),
)


def repeated_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with their long rides twice and their very long rides four times."""
    trips = bronze(spark, sf_dir)
    again = trips.where("trip_distance > 40")
    far = trips.where("trip_distance > 60")
    return trips.union(again).union(far).union(far)


REPEATED = (
    f"repeated AS (SELECT {o.BRONZE_LIST} FROM bronze UNION ALL SELECT {o.BRONZE_LIST} FROM bronze"
    f" WHERE trip_distance > 40 UNION ALL SELECT {o.BRONZE_LIST} FROM bronze WHERE trip_distance > 60"
    f" UNION ALL SELECT {o.BRONZE_LIST} FROM bronze WHERE trip_distance > 60)"
)
DUPLICATE_SQL = (
    f"WITH {o.BRONZE}, {REPEATED} SELECT n AS total_rows, d AS distinct_rows, n - d AS duplicate_count"
    " FROM (SELECT count(*) AS n, (SELECT count(*) FROM (SELECT DISTINCT * FROM repeated)) AS d FROM repeated)"
)


@entry("v14_duplicates", o.over_silver(union(sql_duplicates("silver", o.SILVER_LIST, "silver"))))
def v14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(q.duplicate_report(silver(spark, sf_dir), "silver"))


@entry("v14_duplicates_repeated", DUPLICATE_SQL)
def v14_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.duplicate_counts(repeated_trips(spark, sf_dir))


@entry("v14_duplicates_many", DUPLICATE_SQL)
def v14_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above with a first hash of few values, so that nearly all rows are compared in full."""
    return q.duplicate_counts(repeated_trips(spark, sf_dir), lambda *columns: F.xxhash64(*columns) % 7)


PLAIN_GOLD = [n for n in GOLD_COLUMNS if n not in COUNTS]


@entry(
    "v16_check_selection",
    o.over_features(
        union([ROW_COUNT.format(t="gold_base"), *sql_business("gold_base"), *sql_values("gold_base")])
        + "\nUNION ALL "
        + union(sql_ranges("gold_base", PLAIN_GOLD))
        + "\nUNION ALL "
        + union([*sql_nulls("gold_base", PLAIN_GOLD), *sql_totals("gold_base", 48)])
    ),
)
def v16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema, consistency and duplicates switched off."""
    limits = QualityLimits(schema=False, consistency=False, duplicates=False)
    return report(q.validate(gold(spark, sf_dir), rules_for("gold"), limits))


ALL_GOLD = [
    *sql_schema("gold_wide", GOLD_TYPES),
    ROW_COUNT.format(t="gold_wide"),
    *sql_consistency("gold_wide"),
    *sql_business("gold_wide"),
    *sql_ranges("gold_wide"),
    *sql_values("gold_wide"),
    *sql_nulls("gold_wide"),
    *sql_totals("gold_wide", 51),
    *sql_duplicates("gold_wide", o.GOLD_LIST),
]


@entry("v00_gold_report", o.over_gold(union(ALL_GOLD)))
def v00(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report over gold."""
    return report(q.validate(full_gold(spark, sf_dir), rules_for("gold")))


@entry(
    "v17_verdict",
    o.over_gold(
        "SELECT scope, bool_and(valid) FILTER (WHERE s) AS schema_valid, bool_and(valid OR \"check\" = 'null_count')"
        " FILTER (WHERE NOT s) AS data_valid, count(*) FILTER (WHERE severity = 'warning') AS warnings,"
        " count(*) FILTER (WHERE severity = 'error') AS errors, bool_and(valid OR \"check\" = 'null_count')"
        " AS overall_valid FROM (SELECT *, \"check\" IN ('missing_column', 'extra_column', 'column_type',"
        " 'column_nullable') AS s FROM (" + union(ALL_GOLD) + ")) GROUP BY scope"
    ),
)
def v17(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.verdict(q.validate(full_gold(spark, sf_dir), rules_for("gold")))


@entry(
    "v18_fail_on_error",
    o.over_silver("SELECT 'gold' AS scope, count(*) > 0 AS raised FROM silver"),
)
def v18(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver breaks the gold rules, so enforcing them must raise."""
    trips = silver(spark, sf_dir)
    limits = QualityLimits(fail_on_error=True, duplicates=False)
    try:
        q.validate(trips, rules_for("gold"), limits)
        raised = False
    except q.ValidationFailed:
        raised = True
    return spark.createDataFrame([("gold", raised)], "scope string, raised boolean")


@entry(
    "v18_bad_layer_not_published",
    o.over_silver("SELECT year, month, count(*) AS trip_count, true AS raised FROM silver GROUP BY ALL"),
)
def v18_not_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rebuilt with other limits and a rule it breaks: the stage raises, and the old rows are still stored."""
    lake, raised = empty_lake(spark), False
    land_bronze(spark, trips_view(spark, sf_dir), lake.layer("bronze"))
    build_silver(spark, lake)
    strict = QualityLimits(fail_on_error=True, duplicates=False, min_rows=10**9)
    try:
        build_silver(spark, lake, limits=CleaningLimits(max_trip_distance=5.0), quality=strict)
    except q.ValidationFailed:
        raised = True
    stored = read_layer(spark, lake.layer("silver")).groupBy("year", "month").agg(F.count("*").alias("trip_count"))
    return stored.withColumn("raised", F.lit(raised))


@entry(
    "v17_verdict_stored_gold",
    o.over_gold("SELECT 'gold' AS scope, true AS schema_valid, true AS data_valid, true AS overall_valid FROM gold_wide LIMIT 1"),
)
def v17_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold read back from storage is valid, though Parquet allows nulls in every column."""
    lake = stored_lake(spark, sf_dir)
    limits = QualityLimits(min_rows=1, max_duplicate_percent=100.0)
    found = q.verdict(validate_layer(spark, lake, "gold", limits=limits), limits)
    return found.select("scope", "schema_valid", "data_valid", "overall_valid")


BRONZE_NAMES = [n for n in SILVER_COLUMNS if n != "trip_duration_min"]


def bronze_schema_sql() -> list[str]:
    """Types agree; stored columns are nullable, which is a warning where the rule has them non-null."""
    rows = []
    for rule in rules_for("bronze"):
        rows.append(sql_row("stored", "column_type", rule.name, "count(*)", None, fixed="ok", scope="bronze"))
        agrees = "ok" if rule.nullable else "warning"
        rows.append(sql_row("stored", "column_nullable", rule.name, "count(*)", None, fixed=agrees, scope="bronze"))
    return rows


@entry(
    "v19_bronze_validation",
    o.over_bronze(
        "SELECT * FROM ("
        + union(
            [
                *bronze_schema_sql(),
                ROW_COUNT.format(t="stored").replace("'gold'", "'bronze'"),
                sql_business("stored")[1].replace("'gold'", "'bronze'"),
                *sql_ranges("stored", BRONZE_NAMES, "bronze"),
                *sql_values("stored", BRONZE_NAMES, "bronze"),
                *sql_nulls("stored", BRONZE_NAMES, "bronze", always_nullable=True),
                *sql_totals("stored", 22, "bronze"),
                *sql_duplicates("stored", o.BRONZE_LIST, "bronze"),
            ]
        )
        + ")"
    ).replace("SELECT * FROM (", "SELECT * FROM (WITH stored AS (SELECT * FROM bronze) ", 1),
)
def v19(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of stored bronze against the bronze rules."""
    return report(validate_layer(spark, stored_lake(spark, sf_dir, "bronze"), "bronze"))


@entry(
    "s12_report_sink",
    o.over_features(union([ROW_COUNT.format(t="gold_base"), *sql_business("gold_base")])),
)
def s12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written as JSON and read back."""
    trips = gold(spark, sf_dir)
    found = report(q.run_checks(trips, q.completeness_checks() + q.business_checks(trips.columns), "gold"))
    path = write_report(found, scratch_path(spark, "reports"), datetime(2025, 1, 1))
    return spark.read.schema(found.schema).json(path)


# --- optional checks -----------------------------------------------------------------------------

OUTLIER_COLUMNS = ("extra", "RatecodeID", "passenger_count")


IQR_FAR = (
    "{c} < (SELECT quantile_disc({c}, 0.25) - 1.5 * (quantile_disc({c}, 0.75) - quantile_disc({c}, 0.25)) FROM silver)"
    " OR {c} > (SELECT quantile_disc({c}, 0.75) + 1.5 * (quantile_disc({c}, 0.75) - quantile_disc({c}, 0.25)) FROM silver)"
)


@entry(
    "v20_iqr_outliers",
    o.over_silver(
        union(
            [
                sql_row(
                    f"(SELECT *, {IQR_FAR.format(c=name)} AS far FROM silver)",
                    "iqr_outliers",
                    name,
                    counting("far"),
                    scope="silver",
                )
                for name in OUTLIER_COLUMNS
            ]
        )
    ),
)
def v20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of few values."""
    trips = silver(spark, sf_dir)
    return q.run_checks(trips, q.iqr_outliers(trips, OUTLIER_COLUMNS), "silver")


CONTINUOUS_COLUMNS = ("trip_distance", "fare_amount", "tip_amount", "total_amount")


@entry(
    "v20_iqr_continuous",
    o.over_silver(
        union(
            [
                sql_row(f"(SELECT *, {IQR_FAR.format(c=name)} AS far FROM silver)", "iqr_outliers", name, counting("far"), scope="silver")
                for name in CONTINUOUS_COLUMNS
            ]
        )
    ),
)
def v20_continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns in which nearly every value is another."""
    trips = silver(spark, sf_dir)
    return q.run_checks(trips, q.iqr_outliers(trips, CONTINUOUS_COLUMNS), "silver")


Z_CONDITION = "abs({c} - (SELECT avg({c}) FROM bronze)) > 3 * (SELECT stddev_samp({c}) FROM bronze)"


@entry(
    "v21_zscore_outliers",
    o.over_bronze(
        union(
            [
                sql_row(
                    f"(SELECT *, {Z_CONDITION.format(c=name)} AS far FROM bronze)",
                    "zscore_outliers",
                    name,
                    counting("far"),
                    scope="bronze",
                )
                for name in ("trip_distance", "fare_amount", "tip_amount")
            ]
        )
    ),
)
def v21(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = bronze(spark, sf_dir)
    return q.run_checks(trips, q.zscore_outliers(trips, ("trip_distance", "fare_amount", "tip_amount")), "bronze")


def tiers_sql(limit_of) -> list[str]:
    rows = []
    for name in BRONZE_NAMES:
        if name in CRITICAL:
            tier, limit = "critical", 0
        elif name in FILL_VALUES:
            tier, limit = "important", 5
        else:
            tier, limit = "optional", 50
        percent = f"(count(*) - count({name})) / count(*)::DOUBLE * 100"
        rows.append(limit_of(tier, name, percent, limit))
    return rows


NULL_CELLS = " + ".join(f"(count(*) - count({name}))" for name in BRONZE_NAMES)


@entry(
    "v22_overall_nulls",
    o.over_bronze(
        sql_row(
            "bronze",
            "overall_null_percent",
            "",
            f"({NULL_CELLS}) / (count(*) * {len(BRONZE_NAMES)})::DOUBLE * 100",
            10,
            scope="bronze",
        )
    ),
)
def v22(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = bronze(spark, sf_dir)
    found = named(q.null_tier_checks(trips.columns, rules_for("bronze")), "overall_null_percent")
    return report(q.run_checks(trips, found, "bronze"))


def ratio_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with ratio and flag features, total amount still there; some ratios are put wrong."""
    trips = silver(spark, sf_dir).transform(add_ratio_features).transform(add_distance_features)
    trips = trips.transform(add_flag_features)
    return trips.withColumn(
        "toll_ratio", F.when(F.col("payment_type") == 3, F.col("toll_ratio") + 0.5).otherwise(F.col("toll_ratio"))
    )


SURCHARGE_SUM = (
    "coalesce(extra, 0) + coalesce(congestion_surcharge, 0) + coalesce(Airport_fee, 0) + coalesce(cbd_congestion_fee, 0)"
)
PARTS_SUM = " + ".join(
    f"coalesce({name}, 0)"
    for name in (
        "fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge congestion_surcharge Airport_fee"
        " cbd_congestion_fee"
    ).split()
)


@entry(
    "v23_ratio_tolerance",
    o.over_features(
        union(
            [
                sql_row(
                    "gold_base",
                    "ratio",
                    "surcharge_ratio",
                    counting(
                        f"abs(surcharge_ratio * total_amount - ({SURCHARGE_SUM})) > abs(total_amount) * 5e-2"
                    ),
                    scope="silver",
                ),
                sql_row(
                    "(SELECT * REPLACE (CASE WHEN payment_type = 3 THEN toll_ratio + 5e-1 ELSE toll_ratio END"
                    " AS toll_ratio) FROM gold_base)",
                    "ratio",
                    "toll_ratio",
                    counting("abs(toll_ratio * total_amount - tolls_amount) > abs(total_amount) * 5e-2"),
                    scope="silver",
                ),
            ]
        )
    ),
)
def v23(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = ratio_frame(spark, sf_dir)
    return q.run_checks(trips, named(q.tolerance_checks(trips.columns), "ratio"), "silver")


@entry(
    "v24_fare_total",
    o.over_silver(
        sql_row(
            "silver",
            "fare_total",
            "total_amount",
            counting(f"abs(total_amount - ({PARTS_SUM})) > abs(total_amount) * 1e-1"),
            scope="silver",
        )
    ),
)
def v24(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = silver(spark, sf_dir)
    return q.run_checks(trips, named(q.tolerance_checks(trips.columns), "fare_total"), "silver")


@entry(
    "v25_null_tiers_and_order",
    o.over_bronze(
        union(
            [
                sql_row("bronze", "column_order", "", "count(*)", None, fixed="ok", scope="bronze"),
                *tiers_sql(
                    lambda tier, name, percent, limit: sql_row(
                        "bronze", f"null_percent_{tier}", name, percent, limit, scope="bronze"
                    )
                ),
            ]
        )
    ),
)
def v25(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips, rules = bronze(spark, sf_dir), rules_for("bronze")
    order = named(q.schema_checks(trips.schema, rules, QualityLimits(column_order=True)), "column_order")
    tiers = [c for c in q.null_tier_checks(trips.columns, rules) if c.check != "overall_null_percent"]
    return report(q.run_checks(trips, order + tiers, "bronze"))
