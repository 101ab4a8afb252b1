"""Layers on disk: one parquet folder per layer, partitioned by year and month."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from meterline.schema import MONTH_KEYS
from meterline.settings import WRITE_SETTINGS, WriteOptions, tuned
from meterline.sources import journal
from meterline.sources.trips import conform, lost_in_conforming, with_months

log = logging.getLogger(__name__)
LANDED = "source string, year int, month int, rows long"
#: as stored: also the landing a note is of, and a file's size and time
LANDED_NOTES = f"{LANDED}, landing string, bytes long, modified timestamp"
#: column of the landing in bronze files; reads of a layer leave it out
LANDING = "_landing"
#: kinds of entries in a layer's journal
LAND, REPLACE = "land", "replace"


#: from narrow to wide
INTEGERS = ("tinyint", "smallint", "int", "bigint")
FLOATS = ("float", "double")


def _conflicting(error: Exception) -> bool:
    return "CANNOT_MERGE" in str(error)


def read_parquet(spark: SparkSession, paths: Sequence[str], merge: bool = True) -> DataFrame:
    """All files under ``paths`` as one frame; columns that only some files have become NULL.

    Where files differ in a column's type, merging widens it: integers to the wider one, integers and fractions to
    double, anything else to text. Files are then read in groups of one schema, each with its own types.
    """
    if not paths:
        raise ValueError("no files to read")
    try:
        return spark.read.option("mergeSchema", merge).parquet(*paths)
    except (PySparkException, Py4JJavaError) as error:
        if not merge or not _conflicting(error):
            raise
    parts = [part for path in paths for part in _read_by_schema(spark, path)]
    kinds: dict[str, str] = {}
    for part in parts:
        for name, kind in part.dtypes:
            kinds[name] = _wider(kinds.get(name, kind), kind)
    cast = [part.select(*[F.col(name).cast(kinds[name]).alias(name) for name in part.columns]) for part in parts]
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), cast)


def _wider(one: str, other: str) -> str:
    if one == other:
        return one
    if one in INTEGERS and other in INTEGERS:
        return max(one, other, key=INTEGERS.index)
    return "double" if {one, other} <= {*INTEGERS, *FLOATS} else "string"


def _read_by_schema(spark: SparkSession, path: str) -> list[DataFrame]:
    """The files under ``path``, one frame for each schema, with the partition columns of their folders."""
    files = [row.path for row in listed_files(spark, path, recursive=True).select("path").collect()]
    base = spark.read.option("basePath", path)
    return [base.schema(schema).parquet(*some) for schema, some in schema_groups(spark, files, path)]


def months_wanted(year: int | None, months: Iterable[int] | None):
    """Condition on the partition columns; no months means the whole year, no year means all."""
    condition = F.lit(True)
    if year is not None:
        condition = F.col("year") == year
    months = list(months or ())
    if months:
        condition = condition & F.col("month").isin(*months)
    return condition


def read_layer(
    spark: SparkSession,
    root: str,
    year: int | None = None,
    months: Iterable[int] | None = None,
    merge: bool = False,
    schema: str | StructType | None = None,
) -> DataFrame:
    """A layer, or chosen months of it. The condition prunes partitions before any file is opened.

    With a declared ``schema`` no footer is read to find or merge one: columns a file lacks are
    NULL, columns of other names are left out.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(root).where(months_wanted(year, months))
    return read_parquet(spark, [root], merge).drop(LANDING).where(months_wanted(year, months))


def layer_exists(spark: SparkSession, root: str) -> bool:
    """Whether there is anything to read under ``root``."""
    try:
        spark.read.parquet(root)
        return True
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return False
        raise


def listed_files(spark: SparkSession, root: str, recursive: bool = False) -> DataFrame:
    """Paths of the data files under ``root``, with its partition columns. Only folders are listed.

    ``recursive`` looks into folders of any name and depth, and gives no partition columns.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    return files.option("recursiveFileLookup", recursive).load(root)


def months_present(spark: SparkSession, root: str) -> DataFrame:
    """The ``(year, month)`` pairs of a layer, from its partition folders; no data file is opened."""
    if not layer_exists(spark, root):
        return spark.createDataFrame([], "year int, month int")
    return listed_files(spark, root).select(*MONTH_KEYS).distinct()


def _files_by_month(spark: SparkSession, root: str, months: Sequence[tuple[int, int]]) -> dict[tuple[int, int], set[str]]:
    """Files of some months of a layer."""
    found: dict[tuple[int, int], set[str]] = {key: set() for key in months}
    if months and layer_exists(spark, root):
        for row in listed_files(spark, root).where(in_months(months)).select(*MONTH_KEYS, "path").collect():
            found[row.year, row.month].add(row.path)
    return found


def in_months(months: Iterable[journal.Month]) -> Column:
    """Condition on the partition columns; it prunes folders. A month may be NULL."""
    by_year: dict[int | None, list[int | None]] = {}
    for year, month in months:
        by_year.setdefault(year, []).append(month)
    out = F.lit(False)
    for year, listed in by_year.items():
        named = [month for month in listed if month is not None]
        inside = F.col("month").isin(*named) if named else F.lit(False)
        if None in listed:
            inside = inside | F.col("month").isNull()
        out = out | ((F.col("year").isNull() if year is None else F.col("year") == year) & inside)
    return out


def _folder(root: str, year: int | None, month: int | None) -> str:
    none = "__HIVE_DEFAULT_PARTITION__"
    return f"{root}/year={none if year is None else year}/month={none if month is None else month}"


def write_layer(
    df: DataFrame,
    root: str,
    options: WriteOptions = WriteOptions(),
    rebalance: bool = False,
    replaces: Sequence[tuple[int, int]] = (),
) -> str:
    """Write ``df`` partitioned by year and month; returns ``root``.

    ``overwrite`` replaces the months present in ``df``, and those of ``replaces`` also where ``df`` has no
    row of them. Without ``rebalance`` the write is narrow: input that is already laid out by month stays so.
    With it, rows are brought together by month, and adaptive execution splits a month that is larger
    than the advised size. ``options.files`` is the most files a month gets: rows are brought together by month and
    by that many parts of it, so that the size of a task goes with that of a month and not with the whole.
    """
    spark = df.sparkSession
    held = _files_by_month(spark, root, list(replaces))
    if options.files is not None:
        part = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in df.columns]), F.lit(options.files))
        df = df.repartition(*MONTH_KEYS, part)
    elif rebalance:
        df = df.hint("rebalance", *MONTH_KEYS)
    with tuned(spark, WRITE_SETTINGS):
        (
            df.write.mode(options.mode)
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", options.compression)
            .option("parquet.block.size", options.block_bytes)
            .option("parquet.page.size", options.page_bytes)
            .partitionBy(*MONTH_KEYS)
            .parquet(root)
        )
    # a month whose old files are still there got no row; it becomes empty
    after = _files_by_month(spark, root, [key for key, files in held.items() if files])
    nothing = spark.createDataFrame([], df.drop(*MONTH_KEYS).schema)
    for (year, month), files in after.items():
        if files & held[year, month]:
            nothing.write.mode("overwrite").parquet(_folder(root, year, month))
    return root


# --- landing ----------------------------------------------------------------------------------------


def _landed_path(root: str) -> str:
    return f"{root.rstrip('/')}-landed"


def _landed_notes(spark: SparkSession, root: str) -> DataFrame:
    path = _landed_path(root)
    if not layer_exists(spark, path):
        return spark.createDataFrame([], LANDED_NOTES)
    return spark.read.schema(LANDED_NOTES).parquet(path)


def landed(spark: SparkSession, root: str) -> DataFrame:
    """What has been landed in a layer, and from which source: one row per source and month.

    Notes of a landing count once it is done; those that name no landing are of before there were any.
    """
    done = journal.names(spark, root, LAND, journal.DONE).withColumnRenamed("entry", "landing")
    held = _landed_notes(spark, root)
    whole = held.join(done, "landing", "left_semi").unionByName(held.where("landing IS NULL").select("landing", *[c for c in held.columns if c != "landing"]))
    return whole.select(*[name for name in held.columns if name not in ("landing", "bytes", "modified")])


def _copied(spark: SparkSession, root: str, entry: journal.Entry) -> None:
    """Replace the months of an entry by its staged rows; the same however often it is done."""
    staged = read_parquet(spark, [entry.staged])
    write_layer(staged, root, replaces=entry.months)
    journal.end(spark, root, entry.name, REPLACE)


def repair(spark: SparkSession, root: str) -> list[str]:
    """Finish what a landing that died has left; returns the landings made void.

    What it wrote is taken out of the months it had announced: their other rows are staged beside the layer,
    that is noted, and the months are replaced by them. Dying here, too, is repaired the same way. The sources
    of such a landing count as not landed. Nothing is read where all landings are done.
    """
    for entry in journal.unfinished(spark, root, REPLACE):
        _copied(spark, root, entry)
    open_ = journal.unfinished(spark, root, LAND)
    if not open_:
        return []
    names = [entry.name for entry in open_]
    months = sorted({month for entry in open_ for month in entry.months}, key=str)
    if layer_exists(spark, root):
        held = read_parquet(spark, [root]).where(in_months(months))
        if LANDING in held.columns:
            touched = held.where(F.col(LANDING).isin(*names)).select(*MONTH_KEYS).distinct().collect()
            if touched:
                left = [(row.year, row.month) for row in touched]
                staged = f"{root.rstrip('/')}-staged/{uuid.uuid4().hex}"
                good = held.where(in_months(left)).where(~F.coalesce(F.col(LANDING).isin(*names), F.lit(False)))
                good.write.partitionBy(*MONTH_KEYS).parquet(staged) if not good.isEmpty() else good.write.parquet(staged)
                journal.begin(spark, root, REPLACE, left, staged)
                for entry in journal.unfinished(spark, root, REPLACE):
                    _copied(spark, root, entry)
    for name in names:
        log.warning("%s: landing %s died; what it left is gone", root, name)
        journal.end(spark, root, name, LAND, journal.VOID)
    return names


def _land(
    spark: SparkSession, trips: DataFrame, root: str, rebalance: bool, files: DataFrame | None = None, written: DataFrame | None = None
) -> DataFrame:
    """Append trips that have source, year and month, note them as landed, and return the notes.

    ``written`` is what is written, where that differs from ``trips`` in being watched.

    1. What each source has for each month is counted (of the raw rows only their pickup time is read),
       and noted with the name of the landing.
    2. The landing is noted as begun, with its months. 3. The rows are written, each with the landing's name.
    4. The landing is noted as done. Dying in between leaves an unfinished entry; see :func:`repair`.
    """
    name = uuid.uuid4().hex
    counts = trips.groupBy("source", *MONTH_KEYS).agg(F.count(F.lit(1)).alias("rows")).withColumn("landing", F.lit(name))
    if files is not None:
        counts = counts.join(files.select("source", "bytes", "modified"), "source", "left")
    counts.coalesce(1).write.mode("append").parquet(_landed_path(root))
    own = _landed_notes(spark, root).where(F.col("landing") == name).select("source", *MONTH_KEYS, "rows")
    months = [(row.year, row.month) for row in own.select(*MONTH_KEYS).distinct().collect()]
    journal.begin(spark, root, LAND, months, name=name)
    written = (trips if written is None else written).drop("source")
    if rebalance:
        # the landing's name is added behind the shuffle
        written = written.hint("rebalance", *MONTH_KEYS)
    write_layer(written.withColumn(LANDING, F.lit(name)), root, WriteOptions(mode="append"))
    journal.end(spark, root, name, LAND)
    return own


def _watched(raw: DataFrame, lost: dict[str, Column]) -> tuple[DataFrame, Observation | None]:
    """``raw`` with a count of the values that conforming makes NULL, taken by the job that writes it."""
    if not lost:
        return raw, None
    watch = Observation()
    return raw.observe(watch, *[F.count_if(condition).alias(column) for column, condition in lost.items()]), watch


def _tell(name: str, watch: Observation | None) -> None:
    counts = {column: n for column, n in watch.get.items() if n} if watch is not None else {}
    if counts:
        log.warning("%s: values that became NULL: %s", name, counts)


def land_bronze(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    month: tuple[int, int] | None = None,
    source: str | None = None,
) -> DataFrame:
    """Append raw trips to bronze and return the rows landed: source, year, month, rows.

    A ``source`` is landed once: it is skipped, and the answer empty, where the layer has a note of it. No row
    is left out because its month holds other rows. The month of a row is that of its pickup, or
    ``month = (year, month)`` for a file that is filed under one nominal month, which then also is its
    source unless another is named. Without either the rows are landed whenever they are given.
    What a landing that died has left is taken out first, so a retry stores every row once.
    """
    repair(spark, root)
    if source is None:
        source = f"frame-{uuid.uuid4().hex}" if month is None else f"{month[0]}-{month[1]:02d}"
    if not landed(spark, root).where(F.col("source") == source).isEmpty():
        return spark.createDataFrame([], LANDED)
    watched, watch = _watched(raw, lost_in_conforming(raw))

    def placed(raw: DataFrame) -> DataFrame:
        trips = conform(raw)
        if month is None:
            trips = with_months(trips)
        else:
            trips = trips.withColumns({"year": F.lit(month[0]), "month": F.lit(month[1])})
        return trips.withColumn("source", F.lit(source))

    notes = _land(spark, placed(raw), root, rebalance=month is None, written=placed(watched))
    _tell(source, watch)
    return notes


def _merged(one: StructType, other: StructType) -> StructType | None:
    """Both schemas in one, names without regard to case; None where they give a column two types."""
    fields = {field.name.lower(): field for field in one.fields}
    for field in other.fields:
        held = fields.setdefault(field.name.lower(), field)
        if held.dataType != field.dataType:
            return None
    return StructType([StructField(field.name, field.dataType) for field in fields.values()])


def schema_groups(spark: SparkSession, paths: Sequence[str], base: str | None = None) -> list[tuple[StructType, list[str]]]:
    """Files grouped so that one schema reads all of a group, each column as the files store it.

    The footers of many files are read and merged by one job. Where types differ the files, in order of their paths,
    are halved, so the number of jobs goes with how often the schema changes along the paths; groups
    that agree are then put together. Under ``base`` folders are partitions, which are columns too.
    """
    reader = spark.read.option("mergeSchema", True)
    if base is not None:
        reader = reader.option("basePath", base)
    groups: list[tuple[StructType, list[str]]] = []
    todo = [sorted(paths)]
    while todo:
        some = todo.pop()
        try:
            schema = reader.parquet(*some).schema
        except (PySparkException, Py4JJavaError) as error:
            if len(some) == 1 or not _conflicting(error):
                raise
            todo += [some[: len(some) // 2], some[len(some) // 2 :]]
            continue
        for number, (held, files) in enumerate(groups):
            both = _merged(held, schema)
            if both is not None:
                groups[number] = both, files + some
                break
        else:
            groups.append((schema, some))
    return groups


def land_files(spark: SparkSession, path: str, root: str, months: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """Land the raw files under ``path`` that are not in bronze yet; one row per file and month of rows.

    Folders of any name and depth are looked into; it is an error where there is no file. A file is known by its full
    path, so files of one name in two folders are two sources; one that was landed and has another size or
    time since is left alone, and told in the log. Files are conformed in groups of one schema, so they may
    differ in their columns and types while plan and jobs grow with the number of schemas. ``months`` gives
    files that are filed under a nominal month, by name or by path; rows of others go to the month of their
    pickup. All new files go into one job. A retry stores every row once; see :func:`repair`.
    """
    repair(spark, root)
    listed = listed_files(spark, path, recursive=True).select(
        F.col("_metadata.file_path").alias("source"), "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")
    )
    done = landed(spark, root).select("source").distinct()
    before = _landed_notes(spark, root).where("bytes IS NOT NULL").select("source", F.col("bytes").alias("b"), F.col("modified").alias("m")).distinct()
    changed = listed.join(done, "source", "left_semi").join(before, "source").where("bytes <> b OR modified <> m")
    for row in changed.select("source").distinct().limit(20).collect():
        log.warning("%s: changed since it was landed, left alone", row.source)
    fresh = [row.path for row in listed.join(done, "source", "left_anti").select("path").collect()]
    if not fresh:
        if listed.isEmpty():
            raise ValueError(f"no raw files under {path}")
        return spark.createDataFrame([], LANDED)
    groups = []
    for schema, files in schema_groups(spark, fresh):
        raw = spark.read.schema(schema).parquet(*files).withColumn("source", F.col("_metadata.file_path"))
        watched, watch = _watched(raw, lost_in_conforming(raw))
        groups.append((files, conform(raw), conform(watched), watch))

    def placed(frames: Iterable[DataFrame]) -> DataFrame:
        trips = with_months(reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), frames))
        if not months:
            return trips
        name = F.element_at(F.split("source", "/"), -1)
        named = spark.createDataFrame([(file, *month) for file, month in months.items()], "given string, y int, m int")
        trips = trips.join(F.broadcast(named), (F.col("given") == F.col("source")) | (F.col("given") == name), "left")
        nominal = {key: F.when(F.col("given").isNull(), F.col(key)).otherwise(F.col(own)) for key, own in (("year", "y"), ("month", "m"))}
        return trips.withColumns(nominal).drop("given", "y", "m")

    notes = _land(
        spark, placed(raw for _, raw, _, _ in groups), root, rebalance=True, files=listed, written=placed(watched for _, _, watched, _ in groups)
    )
    for files, _, _, watch in groups:
        _tell(files[0] if len(files) == 1 else f"{files[0]} and {len(files) - 1} more", watch)
    return notes


def scan_counts(spark: SparkSession, root: str, year: int, month: int) -> DataFrame:
    """Row counts of one month, of the whole layer, and of the layer with merged schemas."""
    whole = spark.read.parquet(root)
    merged = read_parquet(spark, [root])
    one_month = read_layer(spark, root, year, [month])

    def counted(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("trip_count")).select(F.lit(name).alias("scan"), "trip_count")

    return counted("month", one_month).union(counted("all", whole)).union(counted("merged", merged))


def require_rows(df: DataFrame) -> DataFrame | None:
    """``df``, or None where it holds no row. Stops at the first row found."""
    return None if df.isEmpty() else df
