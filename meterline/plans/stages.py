"""Stages that read a layer, transform it and write the next one."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators import marts
from meterline.operators.clean import clean
from meterline.operators.features import add_features
from meterline.operators.quality import WatchedWrite, duplicate_report, validate, verdict
from meterline.schema import LAYERS, MONTH_KEYS, rules_for, stored_ddl
from meterline.settings import CleaningLimits, FeatureGroups, JoinBounds, QualityLimits, WriteOptions, tuned
from meterline.sources import journal
from meterline.sources.layers import (
    in_months,
    land_files,
    layer_exists,
    months_present,
    months_wanted,
    read_layer,
    write_layer,
)
from meterline.sources.scratch import checkpointed
from meterline.sources.sinks import write_mart, write_report

#: kinds of entries in a layer's journal: months being replaced, and months that stored marts do not have yet
REBUILD, MARTS = "rebuild", "marts"
MONTH_LOG = "year int, month int, status string, error string"
STAGE_LOG = "step int, stage string, success boolean, output string, error string"


@dataclass(frozen=True)
class Lake:
    """Where the layers of one lake lie."""

    root: str

    def layer(self, name: str) -> str:
        if name not in LAYERS:
            raise ValueError(f"unknown layer {name!r}")
        return f"{self.root.rstrip('/')}/{name}"


def _store(
    df: DataFrame,
    layer: str,
    lake: Lake,
    months: Sequence[tuple[int, int]],
    quality: QualityLimits | None,
    options: WriteOptions,
) -> DataFrame | None:
    """Write a layer, replacing ``months`` of it; with ``quality``, return its report.

    Where errors are to stop the stage, the frame is checked before anything is written. Otherwise the
    per-row checks are gathered from the pass that writes.
    """
    root = lake.layer(layer)
    if quality is None:
        _publish(df, root, months, options)
        return None
    if quality.fail_on_error:
        report = validate(df, rules_for(layer), quality, layer)
        _publish(df, root, months, options)
        return report
    watched = WatchedWrite(df, rules_for(layer), quality, layer)
    _publish(watched.df, root, months, options)
    report = watched.report()
    if quality.duplicates:
        held = df.sparkSession.createDataFrame(list(months), "year int, month int")
        written = read_layer(df.sparkSession, root, schema=df.schema).join(F.broadcast(held), list(MONTH_KEYS), "left_semi")
        report = report.union(duplicate_report(written, layer, quality))
    return report


def _publish(df: DataFrame, root: str, months: Sequence[tuple[int, int]], options: WriteOptions) -> None:
    """Replace months of a layer, having noted which; the notes are closed when all of them are replaced.

    Rebuilds that died before that are among ``months`` (see :func:`_unfinished`), so they are closed too.
    """
    spark = df.sparkSession
    before = journal.unfinished(spark, root, REBUILD)
    name = journal.begin(spark, root, REBUILD, months)
    write_layer(df, root, options, replaces=months)
    for entry in before:
        journal.end(spark, root, entry.name, REBUILD)
    journal.end(spark, root, name, REBUILD)


def _unfinished(spark: SparkSession, root: str, kind: str) -> set[tuple[int, int]]:
    """Months of what was begun for a layer by a driver that died, or is still to do."""
    return {month for entry in journal.unfinished(spark, root, kind) for month in entry.months}


def _months_held(
    spark: SparkSession, source: str, year: int | None, months: Iterable[int] | None
) -> list[tuple[int, int]]:
    """The months asked for that the source holds; it is an error where it holds none of them."""
    held = months_present(spark, source).where(months_wanted(year, months)).dropna().collect()
    if not held:
        raise ValueError(f"{source} holds none of the months asked for: year {year}, months {list(months or ()) or 'all'}")
    return sorted((row.year, row.month) for row in held)


def silver_frame(
    spark: SparkSession,
    bronze: str,
    year: int | None = None,
    months: Iterable[int] | None = None,
    limits: CleaningLimits = CleaningLimits(),
) -> DataFrame:
    return clean(read_layer(spark, bronze, year, months, schema=stored_ddl("bronze")), limits)


def build_silver(
    spark: SparkSession,
    lake: Lake,
    year: int | None = None,
    months: Iterable[int] | None = None,
    limits: CleaningLimits = CleaningLimits(),
    quality: QualityLimits | None = None,
    options: WriteOptions = WriteOptions(),
) -> DataFrame | None:
    """Bronze to silver for the months asked for; narrow from scan to write.

    Every such month that bronze holds is replaced, also where no trip of it is clean, and with them the months of
    a rebuild that died before it had replaced all of its own. Returns the validation report where ``quality`` is given.
    """
    held = _months_held(spark, lake.layer("bronze"), year, list(months or ()))
    held = sorted({*held, *_unfinished(spark, lake.layer("silver"), REBUILD)})
    with tuned(spark):
        bronze = read_layer(spark, lake.layer("bronze"), schema=stored_ddl("bronze")).where(in_months(held))
        return _store(clean(bronze, limits), "silver", lake, held, quality, options)


def gold_frame(
    spark: SparkSession,
    silver: str,
    year: int | None = None,
    months: Iterable[int] | None = None,
    groups: FeatureGroups = FeatureGroups(),
    scope: Sequence[str] | None = None,
    bounds: JoinBounds = JoinBounds(),
) -> DataFrame:
    return add_features(read_layer(spark, silver, year, months, schema=stored_ddl("silver")), groups, scope, bounds)


def build_gold(
    spark: SparkSession,
    lake: Lake,
    year: int | None = None,
    months: Iterable[int] | None = None,
    groups: FeatureGroups = FeatureGroups(),
    scope: Sequence[str] = MONTH_KEYS,
    quality: QualityLimits | None = None,
    options: WriteOptions = WriteOptions(),
    bounds: JoinBounds = JoinBounds(),
) -> DataFrame | None:
    """Silver to gold for the months asked for; the counts are per month unless scoped otherwise.

    Months of a rebuild that died are replaced with them, as in :func:`build_silver`. That stored marts lack what is
    new in these months is noted before they change.
    """
    held = _months_held(spark, lake.layer("silver"), year, list(months or ()))
    held = sorted({*held, *_unfinished(spark, lake.layer("gold"), REBUILD)})
    with tuned(spark):
        silver = read_layer(spark, lake.layer("silver"), schema=stored_ddl("silver")).where(in_months(held))
        gold = add_features(silver, groups, scope, bounds)
        journal.begin(spark, lake.layer("gold"), MARTS, held)
        return _store(gold, "gold", lake, held, quality, options)


def build_layers(
    spark: SparkSession,
    lake: Lake,
    year: int | None = None,
    months: Iterable[int] | None = None,
    quality: QualityLimits | None = None,
) -> tuple[str, str]:
    """Bronze to silver to gold; returns the two paths written."""
    months = list(months or ())
    build_silver(spark, lake, year, months, quality=quality)
    build_gold(spark, lake, year, months, quality=quality)
    return lake.layer("silver"), lake.layer("gold")


def parse_months(text: str) -> list[int]:
    """``"1,2,3"`` or ``"all"``."""
    if text.strip().lower() == "all":
        return list(range(1, 13))
    months = [int(part) for part in text.split(",") if part.strip()]
    wrong = [month for month in months if not 1 <= month <= 12]
    if wrong or not months:
        raise ValueError(f"no such months: {wrong or text!r}")
    return months


def run_months(
    spark: SparkSession,
    source: str,
    year: int,
    months: Sequence[int],
    build: Callable[[int, list[int]], object],
) -> DataFrame:
    """Build the months of a year that the source holds; the log has one row per month asked for.

    All months present go into one job, which keeps the cluster busy and is enough when all is
    well. Only where that fails is each month built on its own, so that one bad month does not
    hold back the others. It is an error when no month succeeds.
    """
    held = months_present(spark, source).where(months_wanted(year, months))
    present = sorted(row.month for row in held.collect())
    entries = [(year, month, "skipped", None) for month in months if month not in present]
    if present:
        try:
            build(year, present)
            entries += [(year, month, "built", None) for month in present]
        except Exception:
            for month in present:
                try:
                    build(year, [month])
                    entries.append((year, month, "built", None))
                except Exception as error:
                    entries.append((year, month, "failed", str(error)))
    if not any(status == "built" for _, _, status, _ in entries):
        reasons = [error for *_, error in entries if error]
        raise RuntimeError(f"no month of {year} was built: {reasons or 'no data'}")
    return spark.createDataFrame(sorted(entries), MONTH_LOG)


def run_silver_months(spark: SparkSession, lake: Lake, year: int, months: Sequence[int]) -> DataFrame:
    return run_months(spark, lake.layer("bronze"), year, months, lambda y, m: build_silver(spark, lake, y, m))


def run_gold_months(spark: SparkSession, lake: Lake, year: int, months: Sequence[int]) -> DataFrame:
    return run_months(spark, lake.layer("silver"), year, months, lambda y, m: build_gold(spark, lake, y, m))


def validate_layer(
    spark: SparkSession,
    lake: Lake,
    layer: str,
    year: int | None = None,
    limits: QualityLimits = QualityLimits(),
    months: Iterable[int] | None = None,
    nullability: bool = False,
    reports: str | None = None,
) -> DataFrame | None:
    """Validation report of a stored layer or months of it, or None where there is nothing to read.

    Parquet read from storage allows nulls in every column, so whether the schema allows them is a warning
    unless ``nullability`` asks for it; whether there are any is checked on the data. With ``reports`` the
    report is also written as a file to that folder.
    """
    root = lake.layer(layer)
    if not layer_exists(spark, root):
        return None
    df = read_layer(spark, root, year, months, merge=True)
    if df.isEmpty():
        return None
    if not nullability:
        limits = replace(limits, strict=False)
    with tuned(spark):
        report = checkpointed(validate(df, rules_for(layer), limits, layer))
    if reports is not None:
        write_report(report, f"{reports.rstrip('/')}/{layer}")
    return report


def export_marts(
    gold: DataFrame, target: str, recent: int = 1000, properties: dict[str, str] | None = None
) -> dict[str, str]:
    """Write the four marts to a JDBC url or a folder; nothing is written where gold is empty.

    The three grouped marts come from one pre-aggregate, so gold is scanned once for them and
    once for the newest trips.
    """
    if gold.isEmpty():
        return {}
    grain = checkpointed(marts.trip_grain(gold))
    frames = {**marts.marts_from_grain(grain), "recent": marts.recent_trips(gold, recent)}
    return {
        name: write_mart(frame, marts.MART_TABLES[name], target, properties) for name, frame in frames.items()
    }


def _marts_path(lake: Lake, name: str) -> str:
    return f"{lake.root.rstrip('/')}/marts-{name}"


def refresh_marts(spark: SparkSession, lake: Lake, recent: int = 1000) -> list[tuple[int, int]]:
    """Bring the stored parts of the marts up to date with gold; returns the months that were computed.

    The parts are sums and counts per day, hour and zone, and the newest trips, of each month. Only months that
    :func:`build_gold` has replaced since are read; all of them where nothing is stored yet.
    """
    gold_root, grain_root, recent_root = lake.layer("gold"), _marts_path(lake, "grain"), _marts_path(lake, f"recent-{recent}")
    entries = journal.unfinished(spark, gold_root, MARTS)
    months = sorted({month for entry in entries for month in entry.months})
    if not (layer_exists(spark, grain_root) and layer_exists(spark, recent_root)):
        months = sorted((row.year, row.month) for row in months_present(spark, gold_root).dropna().collect())
    if months:
        changed = read_layer(spark, gold_root, schema=stored_ddl("gold")).where(in_months(months))
        write_layer(marts.trip_grain(changed, MONTH_KEYS), grain_root, rebalance=True, replaces=months)
        write_layer(marts.recent_by_month(changed, recent), recent_root, rebalance=True, replaces=months)
    for entry in entries:
        journal.end(spark, gold_root, entry.name, MARTS)
    return months


def export_stored_marts(
    spark: SparkSession, lake: Lake, target: str, recent: int = 1000, properties: dict[str, str] | None = None
) -> dict[str, str]:
    """:func:`export_marts` from the stored parts, after a refresh of those that gold has left behind."""
    refresh_marts(spark, lake, recent)
    grain = checkpointed(read_layer(spark, _marts_path(lake, "grain")))
    if grain.isEmpty():
        return {}
    newest = marts.recent_trips(read_layer(spark, _marts_path(lake, f"recent-{recent}")), recent)
    frames = {**marts.marts_from_grain(grain), "recent": newest}
    return {name: write_mart(frame, marts.MART_TABLES[name], target, properties) for name, frame in frames.items()}


@dataclass(frozen=True)
class Run:
    """What a run of the stages should do.

    ``raw_months`` names the month of raw files that are filed under one. The marts are always those of all
    of gold, whatever months the run builds; ``reports`` is a folder for validation reports.
    """

    lake: Lake
    year: int | None = None
    months: tuple[int, ...] = ()
    raw: str | None = None
    mart_target: str | None = None
    ingest: bool = True
    check: bool = True
    transform: bool = True
    quality: QualityLimits = field(default_factory=QualityLimits)
    raw_months: dict[str, tuple[int, int]] | None = None
    reports: str | None = None


def run_stages(spark: SparkSession, run: Run) -> DataFrame:
    """Land, check, transform, check again and export, as switched on; returns the run log.

    The first stage to fail ends the run; its log row carries the error.
    """
    lake, log = run.lake, []

    def land() -> str:
        if run.raw is None:
            raise ValueError("landing needs a raw folder")
        land_files(spark, run.raw, lake.layer("bronze"), run.raw_months)
        return lake.layer("bronze")

    def check(layer: str) -> str:
        report = validate_layer(spark, lake, layer, run.year, run.quality, run.months, reports=run.reports)
        if report is None:
            return "no data"
        outcome = verdict(report, run.quality).first()
        return f"valid={outcome.overall_valid} errors={outcome.errors} warnings={outcome.warnings}"

    def transform() -> str:
        return " ".join(build_layers(spark, lake, run.year, run.months))

    def export() -> str:
        return " ".join(export_stored_marts(spark, lake, run.mart_target).values())

    steps: list[tuple[str, Callable[[], str]]] = []
    if run.ingest:
        steps.append(("ingest", land))
        if run.check:
            steps.append(("check_bronze", lambda: check("bronze")))
    if run.transform:
        steps.append(("transform", transform))
        if run.check:
            steps.append(("check_gold", lambda: check("gold")))
        if run.mart_target is not None:
            steps.append(("export", export))

    for number, (name, step) in enumerate(steps, 1):
        try:
            log.append((number, name, True, step(), None))
        except Exception as error:
            log.append((number, name, False, None, str(error)))
            break
    return spark.createDataFrame(log, STAGE_LOG)
