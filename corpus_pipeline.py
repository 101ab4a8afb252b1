"""Documents to a training mix: quality, near duplicates, benchmark leaks, source weights, shards.

Each stage takes (spark, docs, sf_dir), works on all rows of the one before and returns the columns of
``documents``; the last adds shard and slot. Stages are written as Parquet and read again, so each has a
short lineage and a lost executor costs its own tasks only.

All stages read null texts as empty ones, keep null ids and further columns as they are, take texts of any length
whole, and give an empty table for an empty one. Where a stage says nothing else, rows that repeat each other fare alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterline.llm.batches import bound_batches
from meterline.llm.decontaminate import without_leaks
from meterline.llm.mixing import mix
from meterline.llm.neardup import without_near_duplicates
from meterline.llm.quality import of_quality
from meterline.llm.sharding import shuffle_to_shards
from meterline.sources.scratch import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality scorer rejects go, and with them null, empty and blank texts."""
    bound_batches(spark)
    return of_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: the row of the least id, one of those that repeat it."""
    bound_batches(spark)
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; empty texts and those without words hold none."""
    bound_batches(spark)
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for, from not at all to three times.

    A null source is a source of its own; rows that tie in id and text are taken equally often.
    """
    return mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in uniformly random shards and slots; repeats of a document are dealt out like others."""
    bound_batches(spark)
    return shuffle_to_shards(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: the classifier, signatures, alignments and random draws have no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
