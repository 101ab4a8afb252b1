"""Schema and data quality: every per-row check is one aggregate in a single pass.

Metrics are SQL aggregates, so that some two hundred of them make one ``SELECT``. A report is a
tidy frame ``(scope, check, column, metric, threshold, severity, valid)``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.fares import CHARGES, SURCHARGES
from meterline.functions.zones import zone_number_sql
from meterline.schema import ACCEPTED_TYPES, CRITICAL, FILL_VALUES, MONTH_KEYS, ColumnRule
from meterline.settings import QualityLimits
from meterline.sources.scratch import checkpointed

REPORT_SCHEMA = (
    "scope string, check string, column string, metric double, threshold double, severity string, valid boolean"
)
SCHEMA_CHECKS = ("missing_column", "extra_column", "column_type", "column_nullable", "column_order")
# checks whose failure makes the whole frame invalid
DECIDING = (*SCHEMA_CHECKS, "row_count", "duplicate_rows")


@dataclass(frozen=True)
class Check:
    """One report row: a SQL aggregate, and what it means when it exceeds its threshold.

    Without a threshold the row has a fixed severity. ``where`` is the condition whose rows the metric counts, or gives
    as a ``percent`` of all; without one the metric is the number of rows, or a number.
    """

    check: str
    column: str
    metric: str
    threshold: float | None = 0.0
    severity: str = "warning"
    below: bool = False
    where: str | None = None
    percent: bool = False

    def of(self, rows: int, counted: dict[str, int]) -> float:
        """The metric of so many ``rows``, of which ``counted`` meet each condition."""
        if self.where is None:
            return float(rows if self.metric == "count(*)" else self.metric)
        found = counted[self.where]
        return (found / rows * 100 if rows else 0.0) if self.percent else float(found)


def _number_where(condition: str) -> str:
    return f"count_if({condition})"


def _counted(check: str, column: str, condition: str) -> Check:
    return Check(check, column, _number_where(condition), where=condition)


def _literal(value) -> str:
    return "'" + value.replace("'", "\\'") + "'" if isinstance(value, str) else repr(value)


def _double(value: float) -> str:
    return f"{float(value)!r}D" if math.isfinite(value) else f"double('{float(value)}')"


# --- schema ------------------------------------------------------------------------------------


def type_matches(actual: T.DataType, expected: str) -> bool:
    """Whether a column of type ``actual`` may stand for one declared as ``expected``."""
    accepted = ACCEPTED_TYPES.get(expected.lower())
    return accepted is None or isinstance(actual, accepted)


def schema_checks(
    schema: T.StructType, rules: Sequence[ColumnRule], limits: QualityLimits = QualityLimits()
) -> list[Check]:
    """Columns missing, extra, of another type or nullability, and optionally out of order.

    The findings come from the schema alone; their metric is the number of rows they concern,
    so they ride along in the same pass as the data checks.
    """
    ignored = set(MONTH_KEYS) - {rule.name for rule in rules}
    actual = [field for field in schema.fields if field.name not in ignored]
    names = {field.name for field in actual}
    expected = {rule.name: rule for rule in rules}

    def found(check: str, column: str, severity: str) -> Check:
        return Check(check, column, "count(*)", None, severity)

    out = []
    for name in expected:
        if name not in names:
            out.append(found("missing_column", name, "warning" if limits.allow_missing_columns else "error"))
    for field in actual:
        rule = expected.get(field.name)
        if rule is None:
            out.append(found("extra_column", field.name, "warning" if limits.allow_extra_columns else "error"))
            continue
        matches = type_matches(field.dataType, rule.type)
        out.append(found("column_type", field.name, "ok" if matches else "error"))
        same = field.nullable == rule.nullable
        wrong = "error" if limits.strict else "warning"
        out.append(found("column_nullable", field.name, "ok" if same else wrong))
    if limits.column_order:
        shared = [field.name for field in actual if field.name in expected]
        in_order = shared == [name for name in expected if name in names]
        out.append(found("column_order", "", "ok" if in_order else "error"))
    return out


# --- data --------------------------------------------------------------------------------------


def completeness_checks(limits: QualityLimits = QualityLimits()) -> list[Check]:
    return [Check("row_count", "", "count(*)", limits.min_rows, "error", below=True)]


def consistency_checks(columns: Sequence[str], limits: QualityLimits = QualityLimits()) -> list[Check]:
    """Duration bounds and the identity ``sin² + cos² = 1``."""
    out = []
    if {"tpep_pickup_datetime", "trip_duration_min"} <= set(columns):
        low, high = limits.min_duration_seconds / 60.0, limits.max_duration_hours * 60.0
        outside = f"trip_duration_min < {_double(low)} OR trip_duration_min > {_double(high)}"
        out.append(_counted("duration", "trip_duration_min", outside))
    for name in ("hour", "day_of_week"):
        sin, cos = f"sin_{name}", f"cos_{name}"
        if {sin, cos} <= set(columns):
            gap = f"abs({sin} * {sin} + {cos} * {cos} - 1)"
            out.append(_counted("cyclic_identity", name, f"{gap} > {_double(limits.cyclic_tolerance)}"))
    return out


def business_checks(columns: Sequence[str], limits: QualityLimits = QualityLimits()) -> list[Check]:
    """Route composition, tip against fare, and speed.

    The speed rule reads ``(duration > 0 AND speed < low) OR speed > high``.
    """
    out, names = [], set(columns)
    if {"route_id", "PULocationID", "DOLocationID"} <= names:
        differs = "route_id != concat_ws('_', PULocationID, DOLocationID)"
        out.append(_counted("route_id", "route_id", differs))
    if {"tip_amount", "fare_amount"} <= names:
        most = f"fare_amount * {_double(limits.max_tip_multiplier)}"
        out.append(_counted("tip", "tip_amount", f"tip_amount > {most}"))
    if {"trip_distance", "trip_duration_min"} <= names:
        speed = "try_divide(trip_distance, trip_duration_min / 60.0D)"
        slow = f"trip_duration_min > 0 AND {speed} < {_double(limits.min_speed_mph)}"
        fast = f"{speed} > {_double(limits.max_speed_mph)}"
        out.append(_counted("speed", "trip_distance", f"({slow}) OR {fast}"))
    return out


def range_checks(schema: T.StructType, rules: Sequence[ColumnRule]) -> list[Check]:
    """Values outside an inclusive range; NULLs, and text that is no number, are not counted."""
    out = []
    for rule in rules:
        if rule.valid_range is None or rule.name not in schema.names:
            continue
        low, high = rule.valid_range
        is_text = isinstance(schema[rule.name].dataType, T.StringType)
        value = zone_number_sql(rule.name) if is_text else f"`{rule.name}`"
        out.append(_counted("range", rule.name, f"{value} < {low!r} OR {value} > {high!r}"))
    return out


def allowed_value_checks(columns: Sequence[str], rules: Sequence[ColumnRule]) -> list[Check]:
    out = []
    for rule in rules:
        if rule.valid_values is not None and rule.name in columns:
            allowed = ", ".join(map(_literal, rule.valid_values))
            out.append(_counted("allowed_values", rule.name, f"`{rule.name}` NOT IN ({allowed})"))
    return out


def _nulls(name: str) -> str:
    return f"count(*) - count(`{name}`)"


def _null_percent(name: str) -> str:
    return f"coalesce(try_divide({_nulls(name)}, count(*)) * 100, 0)"


def null_checks(
    columns: Sequence[str], rules: Sequence[ColumnRule], limits: QualityLimits = QualityLimits()
) -> list[Check]:
    """Null count (an error where the column must not be null) and null percentage per column."""
    out = []
    for rule in rules:
        name, null = rule.name, f"`{rule.name}` IS NULL"
        if name not in columns:
            continue
        if rule.nullable:
            out.append(Check("null_count", name, _nulls(name), None, "ok", where=null))
            out.append(Check("null_percent", name, _null_percent(name), limits.optional_null_percent, where=null, percent=True))
        else:
            out.append(Check("null_count", name, _nulls(name), 0.0, "error", where=null))
            out.append(Check("null_percent", name, _null_percent(name), None, "ok", where=null, percent=True))
    return out


def total_checks(columns: Sequence[str]) -> list[Check]:
    return [
        Check("total_rows", "", "count(*)", None, "ok"),
        Check("total_columns", "", str(len(columns)), None, "ok"),
    ]


def data_checks(
    df: DataFrame,
    rules: Sequence[ColumnRule],
    limits: QualityLimits = QualityLimits(),
    schema: T.StructType | None = None,
) -> list[Check]:
    """All enabled per-row checks of ``df``; ``schema`` stands in for its own in the schema checks."""
    out = []
    if limits.schema:
        out += schema_checks(df.schema if schema is None else schema, rules, limits)
    if limits.completeness:
        out += completeness_checks(limits)
    if limits.consistency:
        out += consistency_checks(df.columns, limits)
    if limits.business:
        out += business_checks(df.columns, limits)
    out += range_checks(df.schema, rules)
    out += allowed_value_checks(df.columns, rules)
    out += null_checks(df.columns, rules, limits)
    return out + total_checks(df.columns)


# --- optional checks, declared with tolerances -------------------------------------------------


def _sum_of(names: Sequence[str]) -> str:
    return " + ".join(f"coalesce({name}, 0.0D)" for name in names)


def tolerance_checks(columns: Sequence[str], limits: QualityLimits = QualityLimits()) -> list[Check]:
    """Ratios against their parts, and the total against the sum of its parts."""
    out, names = [], set(columns)
    if {"total_amount", "toll_ratio", "surcharge_ratio", "tolls_amount", *SURCHARGES} <= names:
        slack = f"abs(total_amount) * {_double(limits.ratio_tolerance)}"
        off = f"abs(surcharge_ratio * total_amount - ({_sum_of(SURCHARGES)})) > {slack}"
        off_toll = f"abs(toll_ratio * total_amount - tolls_amount) > {slack}"
        out.append(Check("ratio", "surcharge_ratio", _number_where(off)))
        out.append(Check("ratio", "toll_ratio", _number_where(off_toll)))
    if {"total_amount", *CHARGES} <= names:
        slack = f"abs(total_amount) * {_double(limits.fare_tolerance)}"
        off = f"abs(total_amount - ({_sum_of(CHARGES)})) > {slack}"
        out.append(Check("fare_total", "total_amount", _number_where(off)))
    return out


def null_tier_checks(
    columns: Sequence[str], rules: Sequence[ColumnRule], limits: QualityLimits = QualityLimits()
) -> list[Check]:
    """Null percentage over all cells, and per column against the limit of its tier.

    Columns every trip must have are critical, those that cleaning fills are important.
    """
    names = [rule.name for rule in rules if rule.name in columns]
    nulls = " + ".join(f"({_nulls(name)})" for name in names)
    cells = f"coalesce(try_divide({nulls}, count(*) * {len(names)}) * 100, 0)"
    out = [Check("overall_null_percent", "", cells, limits.max_null_percent)]
    for name in names:
        if name in CRITICAL:
            tier, limit = "critical", limits.critical_null_percent
        elif name in FILL_VALUES:
            tier, limit = "important", limits.important_null_percent
        else:
            tier, limit = "optional", limits.optional_null_percent
        out.append(Check(f"null_percent_{tier}", name, _null_percent(name), limit))
    return out


#: buckets of a histogram that looks for a quantile, and rows of a bucket whose values are counted one by one
HISTOGRAM, FEW = 4096, 10_000


@dataclass
class _Sought:
    """A quantile: the row that is number ``rank`` of ``rows`` between ``low`` and ``high``."""

    column: str
    rank: int
    rows: int
    low: float
    high: float

    def bucket(self) -> Column:
        """Number of the histogram's bucket a value is in; halves keep the difference finite."""
        x, low, width = F.col(self.column).cast("double") / 2, self.low / 2, self.high / 2 - self.low / 2
        if not width:
            return F.col(self.column)
        return F.least(F.floor((x - F.lit(low)) / F.lit(width) * HISTOGRAM), F.lit(HISTOGRAM - 1))

    def inside(self) -> Column:
        return F.col(self.column).cast("double").between(self.low, self.high)


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> dict[str, list[float] | None]:
    """For each column the least values at or below which the ``shares`` of its values lie, nulls and NaN left out.

    No sketch and no sort: a histogram between the least and the greatest value tells in which bucket the wanted
    row is, the next one divides that bucket, and so on, until it holds one value or few rows, whose distinct
    values are then counted. Every pass serves all columns, and a bucket is a row however many values are in it.
    None stands for a column without values.
    """
    measured = [F.when(~F.isnan(F.col(name).cast("double")), F.col(name).cast("double")) for name in columns]
    row = df.agg(*[f(x) for x in measured for f in (F.count, F.min, F.max)]).first()
    ends = {name: row[3 * n : 3 * n + 3] for n, name in enumerate(columns)}
    sought = {
        (name, share): _Sought(name, max(1, math.ceil(share * n)), n, low, high)
        for name, (n, low, high) in ends.items() if n for share in shares
    }
    while todo := [s for s in sought.values() if s.low < s.high]:
        coarse = [s.rows > FEW for s in todo]
        key = [s.bucket() if large else F.col(s.column).cast("double") for s, large in zip(todo, coarse)]
        rows = F.array(*[
            F.when(s.inside(), F.struct(F.lit(n).alias("n"), k.cast("double").alias("key"), F.col(s.column).cast("double").alias("x")))
            for n, (s, k) in enumerate(zip(todo, key))
        ])
        found = df.select(F.explode(F.array_compact(rows)).alias("row")).select("row.*")
        counted = found.groupBy("n", "key").agg(F.count(F.lit(1)).alias("rows"), F.min("x").alias("low"), F.max("x").alias("high"))
        held = counted.orderBy("n", "key").collect()
        for n, s in enumerate(todo):
            for part in (part for part in held if part.n == n):
                if part.rows >= s.rank:
                    s.rows, s.low, s.high = part.rows, part.low, part.high
                    break
                s.rank -= part.rows
    return {name: [sought[name, share].low for share in shares] if n else None for name, (n, _, _) in ends.items()}


def iqr_outliers(df: DataFrame, columns: Sequence[str], limits: QualityLimits = QualityLimits()) -> list[Check]:
    """Values beyond the quartiles by a multiple of their distance.

    Reads the quartiles first, exactly; only two numbers per column come back.
    """
    quartiles = exact_quantiles(df, columns, (0.25, 0.75))
    out = []
    for name in columns:
        if quartiles[name] is None:
            continue
        low, high = quartiles[name]
        reach = (high - low) * limits.iqr_multiplier
        outside = f"`{name}` < {_double(low - reach)} OR `{name}` > {_double(high + reach)}"
        out.append(Check("iqr_outliers", name, _number_where(outside)))
    return out


def zscore_outliers(
    df: DataFrame, columns: Sequence[str], limits: QualityLimits = QualityLimits()
) -> list[Check]:
    """Values further from the mean than a multiple of the standard deviation."""
    moments = df.agg(
        *[F.avg(name).alias(f"avg_{name}") for name in columns],
        *[F.stddev(name).alias(f"std_{name}") for name in columns],
    ).first()
    out = []
    for name in columns:
        mean, deviation = moments[f"avg_{name}"], moments[f"std_{name}"]
        if mean is None or deviation is None:
            continue
        far = f"abs(`{name}` - {_double(mean)}) > {_double(deviation * limits.zscore_threshold)}"
        out.append(Check("zscore_outliers", name, _number_where(far)))
    return out


# --- duplicates --------------------------------------------------------------------------------


def hash_counts(
    df: DataFrame, hash_of: Callable[..., Column] = F.xxhash64, marks: Sequence[Column] = ()
) -> DataFrame:
    """Rows per 64-bit hash, with the least and greatest of a second, independent hash among them, and ``marks``."""
    columns = [F.col(f"`{name}`") for name in df.columns]
    # Spark's hashes pass over NULLs, so the second one also takes in where they are
    second = F.xxhash64(F.lit("second"), *[part for column in columns for part in (column.isNull(), column)])
    named = [mark.alias(f"_mark{n}") for n, mark in enumerate(marks)]
    hashed = df.select(hash_of(*columns).alias("_hash"), second.alias("_second"), *named)
    return hashed.groupBy("_hash").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_second").alias("_low"),
        F.max("_second").alias("_high"),
        *[F.min(f"_mark{n}").alias(f"_mark{n}") for n in range(len(marks))],
    )


#: conditions in a mark, a 64-bit number whose bits tell which of them a row meets
MARKED = 63


def _marks(conditions: Sequence[str]) -> list[Column]:
    parts = [conditions[n : n + MARKED] for n in range(0, len(conditions), MARKED)]
    return [F.expr(_joined([f"if({c}, {1 << bit}L, 0L)" for bit, c in enumerate(part)])) for part in parts]


def _joined(bits: Sequence[str]) -> str:
    """The bits by ``|``, in halves: Spark's analysis of a chain of them goes with the square of its depth or worse."""
    half = len(bits) // 2
    return f"({_joined(bits[:half])} | {_joined(bits[half:])})" if half else bits[0]


def duplicates_and_conditions(
    df: DataFrame, conditions: Sequence[str] = (), hash_of: Callable[..., Column] = F.xxhash64
) -> tuple[int, int, dict[str, int]]:
    """Number of rows, of rows that repeat another, and of rows that meet each condition, in one pass.

    See :func:`duplicate_counts` for how rows are told apart. Rows that are equal meet the same conditions, so these
    go with the hash as bits, 8 bytes a row for 63 of them; rows are then counted by them.
    """
    marks = _marks(conditions)
    names = [f"_mark{n}" for n in range(len(marks))]
    differ = F.col("_low") != F.col("_high")
    # of rows that differ and share a hash the marks are not known
    known = [F.when(~differ, F.col(name)).alias(name) for name in names]
    found = checkpointed(
        hash_counts(df, hash_of, marks).groupBy(F.when(differ, F.col("_hash")).alias("_hash"), *known).agg(
            F.sum("_n").alias("_n"), F.sum(F.col("_n") - 1).alias("_more")
        )
    )
    collided = found.where("_hash IS NOT NULL").select("_hash")
    parts = [found.where("_hash IS NULL").select(*names, "_n", "_more")]
    if not collided.isEmpty():
        columns = [F.col(f"`{name}`") for name in df.columns]
        hashed = df.withColumn("_hash", hash_of(*columns))
        rows = hashed.join(F.broadcast(collided), "_hash", "left_semi").groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
        again = [mark.alias(name) for mark, name in zip(_marks(conditions), names)]
        parts.append(rows.select(*again, "_n", (F.col("_n") - 1).alias("_more")))
    total, duplicates, counted = 0, 0, dict.fromkeys(conditions, 0)
    for part in parts:
        met = [
            F.sum(F.when(F.col(names[n // MARKED]).bitwiseAND(F.lit(1 << n % MARKED)) != 0, F.col("_n")))
            for n in range(len(conditions))
        ]
        row = [value or 0 for value in part.agg(F.sum("_n"), F.sum("_more"), *met).first()]
        total, duplicates = total + row[0], duplicates + row[1]
        for condition, n in zip(conditions, row[2:]):
            counted[condition] += n
    return total, duplicates, counted


def duplicate_counts(df: DataFrame, hash_of: Callable[..., Column] = F.xxhash64) -> DataFrame:
    """Exact ``(total_rows, distinct_rows, duplicate_count)`` over whole rows.

    Rows are counted by a 64-bit hash, along with the least and greatest of a second, independent one. Where
    these agree the rows of a hash are equal; where they differ, rows that are not equal share the first
    hash. Of such hashes there are a few ten thousand among 10^12 rows, so they are broadcast and only
    their rows compared in full. All else moves 24 bytes a row, after a count per task.
    """
    total, duplicates, _ = duplicates_and_conditions(df, (), hash_of)
    return _duplicates(df.sparkSession, total, duplicates)


def _duplicates(spark: SparkSession, total: int, duplicates: int) -> DataFrame:
    return spark.createDataFrame(
        [(total, total - duplicates, duplicates)], "total_rows long, distinct_rows long, duplicate_count long"
    )


def duplicate_report(
    df: DataFrame, scope: str, limits: QualityLimits = QualityLimits()
) -> DataFrame:
    """Two report rows: duplicates found, and their share against the limit."""
    return _duplicate_rows(duplicate_counts(df), scope, limits)


def _duplicate_rows(counts: DataFrame, scope: str, limits: QualityLimits) -> DataFrame:
    counts = counts.withColumn(
        "percent", F.coalesce(F.try_divide("duplicate_count", "total_rows") * 100, F.lit(0.0))
    )
    too_many = F.col("percent") > limits.max_duplicate_percent
    severity = F.when(too_many, "error").when(F.col("duplicate_count") > 0, "warning").otherwise("ok")
    return counts.select(
        F.lit(scope).alias("scope"),
        F.lit("duplicate_rows").alias("check"),
        F.explode(
            F.array(
                F.struct(F.lit("count").alias("column"), F.col("duplicate_count").cast("double").alias("metric")),
                F.struct(F.lit("percent").alias("column"), F.col("percent").alias("metric")),
            )
        ).alias("found"),
        F.lit(float(limits.max_duplicate_percent)).alias("threshold"),
        severity.alias("severity"),
        (~too_many).alias("valid"),
    ).select(
        "scope", "check", "found.column", "found.metric", "threshold", "severity", "valid"
    )


# --- report ------------------------------------------------------------------------------------


def _report_row(scope: str, check: Check, metric: str) -> str:
    """A report row as a SQL struct over the value ``metric``."""
    if check.threshold is None:
        threshold, severity, valid = "NULL", _literal(check.severity), repr(check.severity != "error")
    else:
        threshold = _double(check.threshold)
        fails = f"{metric} {'<' if check.below else '>'} {threshold}"
        severity = f"CASE WHEN {fails} THEN {_literal(check.severity)} ELSE 'ok' END"
        valid = f"NOT ({fails})" if check.severity == "error" else "true"
    fields = {
        "scope": _literal(scope),
        "check": _literal(check.check),
        "column": _literal(check.column),
        "metric": metric,
        "threshold": f"CAST({threshold} AS DOUBLE)",
        "severity": severity,
        "valid": valid,
    }
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields.items()) + ")"


def _metric_names(checks: Sequence[Check]) -> dict[str, str]:
    """A column name per distinct aggregate; checks that share an aggregate share its column."""
    return {metric: f"m{i}" for i, metric in enumerate(dict.fromkeys(check.metric for check in checks))}


def _report_of(metrics: DataFrame, checks: Sequence[Check], scope: str) -> DataFrame:
    """Report rows from the one row of metrics."""
    names = _metric_names(checks)
    rows = ", ".join(_report_row(scope, check, names[check.metric]) for check in checks)
    return metrics.selectExpr(f"inline(array({rows}))")


def _report_of_values(spark: SparkSession, seen: Mapping[str, float], checks: Sequence[Check], scope: str) -> DataFrame:
    """Report rows from metrics that are known, by column name."""
    values = [f"{_double(seen[name])} AS {name}" for name in _metric_names(checks).values()]
    return _report_of(spark.range(1).selectExpr(*values), checks, scope)


def run_checks(df: DataFrame, checks: Sequence[Check], scope: str) -> DataFrame:
    """One aggregate over ``df``, turned into one report row per check."""
    metrics = [f"CAST({metric} AS DOUBLE) AS {name}" for metric, name in _metric_names(checks).items()]
    return _report_of(df.selectExpr("count(*) AS _rows", *metrics), checks, scope)


def validate(
    df: DataFrame,
    rules: Sequence[ColumnRule],
    limits: QualityLimits = QualityLimits(),
    scope: str = "gold",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Validation report: one pass for all checks, which with duplicates shuffles hashes and what each row meets.

    A frame read from storage has lost which columns cannot be null; ``schema`` gives the one it
    was written with.
    """
    checks = data_checks(df, rules, limits, schema)
    if limits.duplicates:
        conditions = list(dict.fromkeys(check.where for check in checks if check.where is not None))
        total, duplicates, counted = duplicates_and_conditions(df, conditions)
        names = _metric_names(checks)
        seen = {names[check.metric]: check.of(total, counted) for check in checks}
        report = _report_of_values(df.sparkSession, seen, checks, scope)
        report = report.union(_duplicate_rows(_duplicates(df.sparkSession, total, duplicates), scope, limits))
    else:
        report = run_checks(df, checks, scope)
    if limits.fail_on_error:
        report = checkpointed(report)
        enforce(report, limits)
    return report


def deciding_checks(limits: QualityLimits = QualityLimits()) -> tuple[str, ...]:
    """Checks that can make a frame invalid; nulls in non-null columns only where asked for."""
    return (*DECIDING, "null_count") if limits.nulls_decide else DECIDING


def verdict(report: DataFrame, limits: QualityLimits = QualityLimits()) -> DataFrame:
    """Per scope: schema valid, data valid, both, and the number of warnings and errors."""
    of_schema = F.col("check").isin(*SCHEMA_CHECKS)
    decides = F.col("check").isin(*deciding_checks(limits))
    holds = F.col("valid") | ~decides
    return (
        report.groupBy("scope")
        .agg(
            F.bool_and(holds | ~of_schema).alias("schema_valid"),
            F.bool_and(holds | of_schema).alias("data_valid"),
            F.count_if(F.col("severity") == "warning").alias("warnings"),
            F.count_if(F.col("severity") == "error").alias("errors"),
        )
        .withColumn("overall_valid", F.col("schema_valid") & F.col("data_valid"))
    )


class ValidationFailed(ValueError):
    """The report holds errors that make the frame invalid."""


def enforce(report: DataFrame, limits: QualityLimits = QualityLimits()) -> None:
    """Raise with the deciding errors of a report. A report has a few rows per column."""
    failed = report.where(~F.col("valid") & F.col("check").isin(*deciding_checks(limits)))
    found = [f"{row.scope}.{row.check}({row.column}) = {row.metric}" for row in failed.collect()]
    if found:
        raise ValidationFailed("; ".join(sorted(found)))


# --- metrics gathered during a write -----------------------------------------------------------


class WatchedWrite:
    """Gathers the per-row checks while a frame is being written, sparing the second scan.

    ``watched = WatchedWrite(df, rules)``; write ``watched.df``; then ``watched.report()``.
    Duplicates need a shuffle of their own and are not part of it.
    """

    def __init__(
        self,
        df: DataFrame,
        rules: Sequence[ColumnRule],
        limits: QualityLimits = QualityLimits(),
        scope: str = "gold",
    ) -> None:
        self._checks = data_checks(df, rules, limits)
        self._scope = scope
        self._session = df.sparkSession
        self._observation = Observation()
        self._names = _metric_names(self._checks)
        observed = [F.expr(f"CAST({metric} AS DOUBLE)").alias(name) for metric, name in self._names.items()]
        self.df = df.observe(self._observation, *observed)

    def report(self) -> DataFrame:
        """The report; waits until the write has run."""
        return _report_of_values(self._session, self._observation.get, self._checks, self._scope)
