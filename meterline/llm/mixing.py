"""Mixing sources to target weights with hash-threshold histograms; no document is sorted.

A document's place in its source is a 60-bit hash of its id and text. The words of each source are
summed by the leading bits of that place. Where the running sum crosses the source's budget lies the
boundary bucket; only its documents are summed again by the next bits, until the threshold is known
to the last bit. Rows are then filtered against one threshold per source. A larger budget moves the
threshold up, so smaller mixes are subsets of larger ones, and reruns agree.

Null ids and texts count as empty, a null source is a source of its own. Rows that agree in id and text
share a place and are taken alike. An empty table gives no rows. Only doc_id, text and source are read;
columns that the result adds replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.sources.scratch import stored

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
DIGIT_BITS = 12
DIGITS = 5
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place(doc_id: Column, text: Column) -> Column:
    """60 bits from the MD5 of id and text."""
    joined = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long")


def with_places(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "size": word_count(F.col("text")),
            "place": place(F.col("doc_id"), F.col("text")),
            # a string for every source, so that null joins like the others
            "source_key": F.when(F.col("source").isNull(), "null").otherwise(F.concat(F.lit("="), "source")),
        }
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source_key, source_size) to the same with target. There are as many rows as sources.

    All sources together get the sum of all sizes, each by its weight; weights repeat along the
    sources in code point order, null last. A source whose share is above ``most`` times its size
    stops there. In order of that limit per weight, the level shared by the others is the first one
    that does not exceed the limit of the source at hand.
    """
    everything = Window.partitionBy()
    named = Window.orderBy(F.col("source_key") == "null", "source_key")
    ordered = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source_key") == "null", "source_key")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    weighed = sizes.withColumns(
        {
            "limit": most * F.col("source_size"),
            "weight": F.element_at(
                F.array(*map(F.lit, weights)), ((F.row_number().over(named) - 1) % len(weights) + 1).cast("int")
            ),
        }
    )
    left_size = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = weighed.withColumns({"level": left_size / left_weight, "rank": F.row_number().over(ordered)})
    first_open = F.min(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct("rank", "level")))
    return levels.withColumn("common", first_open.over(everything).getField("level")).select(
        "source_key",
        "source_size",
        F.least(
            F.col("limit").cast("double"), F.coalesce(F.col("common"), F.lit(0.0)) * F.col("weight")
        ).alias("target"),
    )


def thresholds(slim: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` (source_key, budget, ...) with the place below which documents are taken.

    A document is taken while half of it at least lies within the budget, so the words taken differ
    from the budget by half of what stands at the threshold: one document, or all rows that tie in id and text.
    """
    found = plan.withColumns({"below": F.lit(0).cast("long"), "threshold": F.lit(0).cast("long")})
    for level in range(DIGITS):
        shift = DIGIT_BITS * (DIGITS - 1 - level)
        boundary = found.select("source_key", "budget", "below", "threshold")
        inside = slim.join(boundary, "source_key").where(
            F.shiftright("place", shift + DIGIT_BITS) == F.col("threshold")
        )
        sums = inside.groupBy("source_key", "budget", "below", F.shiftright("place", shift).alias("bucket")).agg(
            F.sum("size").alias("words")
        )
        running = F.sum("words").over(Window.partitionBy("source_key").orderBy("bucket"))
        sums = sums.withColumn("upto", F.col("below") + running)
        # on the last level a bucket is one place, of which half is enough
        reach = F.col("upto") - F.col("words") / 2 if level == DIGITS - 1 else F.col("upto")
        crossing = F.min(F.when(reach > F.col("budget"), F.struct("bucket", (F.col("upto") - F.col("words")).alias("sum"))))
        step = sums.groupBy("source_key").agg(
            crossing.alias("crossing"), (F.max("bucket") + 1).alias("end"), F.max("upto").alias("all")
        )
        # without documents in the boundary bucket its lower end is the threshold
        found = found.join(step, "source_key", "left").withColumns(
            {
                "below": F.coalesce("crossing.sum", "all", "below"),
                "threshold": F.coalesce("crossing.bucket", "end", F.shiftleft("threshold", DIGIT_BITS)),
            }
        )
        found = stored(found.drop("crossing", "end", "all"), "threshold")
    return found


def plan_mix(slim: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Per source its size, target, whole copies of each document, and threshold of one copy more."""
    sizes = slim.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = targets(sizes, weights, most).withColumn("whole", whole.cast("long"))
    plan = plan.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    return thresholds(slim, stored(plan, "targets"))


def _with_copies(placed: DataFrame, plan: DataFrame) -> DataFrame:
    more = F.when(F.col("place") < F.col("threshold"), 1).otherwise(0)
    return placed.join(plan, "source_key").withColumn("copies", F.col("whole") + more)


def mix(df: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The rows of the mix: each row of ``df`` as often as it is taken, columns unchanged."""
    slim = stored(with_places(df).select("source_key", "size", "place"), "places")
    plan = plan_mix(slim, weights, most).select("source_key", "whole", "threshold")
    keys = with_places(df.select(F.struct("*").alias("row"), "doc_id", "text", "source"))
    taken = _with_copies(keys, plan).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    slim = stored(with_places(documents).select("doc_id", "source_key", "size", "place"), "places")
    return _with_copies(slim, plan_mix(slim)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


OP7_SQL = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, source,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           ('0x' || md5(doc_id::VARCHAR || ':' || md5(coalesce(text, '')))[1:15])::BIGINT AS place
    FROM documents
),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
    FROM docs GROUP BY source
),
-- each round shares what is left among the sources not yet full
rounds AS (
    SELECT 0 AS round, NULL::DOUBLE AS level, NULL::BIGINT AS filled
    UNION ALL
    SELECT round + 1, next.level, next.filled
    FROM rounds, LATERAL (
        SELECT shared.level, (SELECT count(*) FROM sources WHERE shared.level * weight > 3 * source_size) AS filled
        FROM (
            SELECT ((SELECT sum(source_size) FROM sources)
                    - coalesce(sum(3 * source_size) FILTER (WHERE rounds.level * weight > 3 * source_size), 0))
                   / sum(weight) FILTER (WHERE rounds.level IS NULL OR rounds.level * weight <= 3 * source_size) AS level
            FROM sources
        ) AS shared
    ) AS next
    WHERE round < 40 AND (rounds.filled IS NULL OR next.filled > rounds.filled OR round = 1)
),
wanted AS (
    SELECT source, source_size,
           least(3.0 * source_size, (SELECT max_by(level, round) FROM rounds WHERE level IS NOT NULL) * weight)::DOUBLE AS target
    FROM sources
),
placed AS (
    SELECT doc_id, size, source_size, target, floor(target / source_size) AS whole,
           sum(size) OVER (PARTITION BY docs.source ORDER BY place) - size / 2 AS reach
    FROM docs JOIN wanted ON docs.source IS NOT DISTINCT FROM wanted.source
)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN reach <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""
