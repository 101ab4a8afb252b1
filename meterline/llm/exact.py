"""Exact deduplication by skew-safe combining, in DataFrame operations only.

1. *Locally*: Spark's partial aggregation leaves one row per text and task.
2. *Salted merge*: those rows are merged by (digest, salt, text), so that a text with a third of all
   rows is spread over ``salts`` tasks.
3. *Globally*: the salt winners of a text, at most ``salts`` rows, are merged by (digest, text).

The text itself is a grouping key at every stage, so rows are merged only where whole contents agree,
whatever their digests. One row per text (digest, winner, size) goes to the shared folder. Rows find
their winner by digest; only where two contents share a digest (never seen with SHA-256; tests
shorten it) those rows are matched by content too.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.operators.lookup import attach_rows
from meterline.settings import JoinBounds
from meterline.sources.scratch import stored

WHITE = " \t\n\x0b\f\r"
LAST_ID = Decimal(2**63 - 1)
PLACES = Decimal(10**20)


def normalised(text: Column) -> Column:
    """Text without ASCII white space; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for character in WHITE:
        out = F.replace(out, F.lit(character), F.lit(""))
    return out


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _rank(length: Column, doc_id: Column) -> Column:
    """Longer first, then the smaller id, null last: one number, which hash aggregation can hold."""
    place = F.lit(LAST_ID) + 1 - doc_id.cast("decimal(19,0)")
    return length.cast("decimal(10,0)") * F.lit(PLACES) + F.coalesce(place, F.lit(Decimal(0)))


def _ranked_id(rank: Column) -> Column:
    place = rank % F.lit(PLACES)
    return F.when(place > 0, (F.lit(LAST_ID) + 1 - place).cast("long"))


def _ranked_length(rank: Column) -> Column:
    return F.floor(rank / F.lit(PLACES)).cast("long")


def merge_texts(rows: DataFrame, salts: int) -> DataFrame:
    """(doc_id, length, digest, content) to one row per content: digest, content, best rank, size."""
    salted = rows.select(
        "digest",
        (F.spark_partition_id() % salts).alias("salt"),
        "content",
        _rank(F.col("length"), F.col("doc_id")).alias("rank"),
    )
    winners = salted.groupBy("digest", "salt", "content").agg(
        F.max("rank").alias("rank"), F.count(F.lit(1)).alias("size")
    )
    return winners.groupBy("digest", "content").agg(F.max("rank").alias("rank"), F.sum("size").alias("size"))


def group_equal(
    df: DataFrame,
    salts: int = 64,
    digest: Callable[[Column], Column] = sha256,
    bounds: JoinBounds = JoinBounds(),
) -> DataFrame:
    """For each row of ``df`` (doc_id, text) the row that stays of those with an equal text.

    Texts are equal when they agree after ASCII white space is deleted; null is the empty text, so all
    null, empty and blank texts are one group. The row with the most code points stays, of those the
    smallest id; a null id comes last. Rows that repeat the winner's id and length are all marked kept.
    An empty table gives no rows; columns other than doc_id and text are not read. Texts are compared whole, of any length.

    Returns doc_id, keep_id, group_size, kept, digest.
    """
    rows = df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length(F.coalesce("text", F.lit(""))).alias("length"),
        normalised(F.col("text")).alias("content"),
    )
    rows = rows.withColumn("digest", digest(F.col("content")))
    merged = merge_texts(rows, salts)
    winners = stored(merged.select("digest", "rank", "size"), "texts")
    shared = winners.groupBy("digest").count().where("count > 1").select("digest")
    slim = rows.select("doc_id", "length", "digest")
    alone = winners if shared.isEmpty() else winners.join(shared, "digest", "left_anti")
    # digests of large groups are split off by their size, so that no task gets all rows of one
    found = attach_rows(slim, alone, ["digest"], alone.select("digest", F.col("size").alias("times")), bounds)
    if alone is not winners:
        apart = merged.join(shared, "digest", "left_semi")
        found = found.where("rank IS NOT NULL").unionByName(rows.join(apart, ["digest", "content"]).drop("content"))
    return found.select(
        "doc_id",
        _ranked_id(F.col("rank")).alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("doc_id").eqNullSafe(_ranked_id(F.col("rank"))) & (F.col("length") == _ranked_length(F.col("rank")))).alias(
            "kept"
        ),
        "digest",
    )


def op6_exact(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return group_equal(documents).withColumnRenamed("digest", "text_sha256")


OP6_SQL = r"""
WITH rows AS (
    SELECT doc_id, coalesce(text, '') AS full_text,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY content) AS group_size,
       doc_id = first_value(doc_id) OVER best AS kept,
       sha256(content) AS text_sha256
FROM rows
WINDOW best AS (PARTITION BY content ORDER BY length(full_text) DESC, doc_id)
"""
