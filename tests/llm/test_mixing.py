import pytest
from pyspark.sql import functions as F

from meterline.llm import mixing


def water(sizes):
    """Targets by sharing the excess again and again."""
    weights = [(5, 2, 1)[n % 3] for n in range(len(sizes))]
    full, total = set(), sum(sizes)
    while True:
        rest = total - sum(3 * sizes[n] for n in full)
        weight = sum(weights[n] for n in range(len(sizes)) if n not in full)
        level = rest / weight if weight else 0
        more = {n for n in range(len(sizes)) if n not in full and level * weights[n] > 3 * sizes[n]}
        if not more:
            return [3 * sizes[n] if n in full else level * weights[n] for n in range(len(sizes))]
        full |= more


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 5, 0, 900, 3, 7], [0, 0], [5], [1, 1, 1, 1, 1, 1, 10**6]])
def test_targets(spark, sizes):
    frame = spark.createDataFrame([(f"={n:03d}", size) for n, size in enumerate(sizes)], "source_key string, source_size long")
    found = [row.target for row in mixing.targets(frame).orderBy("source_key").collect()]
    assert found == pytest.approx(water(sizes))
    assert sum(found) == pytest.approx(sum(sizes))


def test_null_source_is_last(spark):
    frame = spark.createDataFrame([("null", 9), ("=z", 9), ("=a", 9)], "source_key string, source_size long")
    found = {row.source_key: row.target for row in mixing.targets(frame).collect()}
    assert found["=a"] > found["=z"] > found["null"]


def test_thresholds_are_exact_and_nested(spark):
    slim = spark.range(4000).select(
        F.lit("=a").alias("source_key"),
        (F.col("id") % 9).alias("size"),
        mixing.place(F.col("id"), F.lit("x")).alias("place"),
    ).cache()
    rows = sorted((row.place, row.size) for row in slim.collect())
    before = -1
    for budget in (0.0, 3.5, 100.0, 7777.0, 15_000.0, 10.0**9):
        plan = spark.createDataFrame([("=a", budget)], "source_key string, budget double")
        found = mixing.thresholds(slim, plan).first().threshold
        total, end = 0, None
        for place, size in rows:
            if total + size / 2 > budget:
                end = place
                break
            total += size
        taken = sum(place < found for place, _ in rows)
        assert taken == (len(rows) if end is None else sum(place < end for place, _ in rows))
        assert found >= before
        before = found


def test_places_that_tie_are_taken_alike(spark):
    slim = spark.range(100).selectExpr("'=a' AS source_key", "1L AS size", "id % 2 AS place")
    plan = spark.createDataFrame([("=a", 30.0)], "source_key string, budget double")
    assert mixing.thresholds(slim, plan).first().threshold == 1


def test_rows_of_the_mix(odd_documents, no_documents):
    mixed = mixing.mix(odd_documents)
    assert mixed.columns == odd_documents.columns
    assert mixed.exceptAll(odd_documents.union(odd_documents).union(odd_documents)).isEmpty()
    again = mixing.mix(odd_documents)
    assert mixed.exceptAll(again).isEmpty() and again.exceptAll(mixed).isEmpty()
    assert mixing.mix(no_documents).count() == 0


def test_words_come_near_the_target(spark, sf_dir, documents):
    source = {row.doc_id: row.source for row in documents.collect()}
    rows = mixing.op7_mixing(spark, sf_dir).collect()
    for name in set(source.values()):
        same = [row for row in rows if source[row.doc_id] == name]
        assert abs(sum(row.taken for row in same) - same[0].target) <= max(row.size for row in same)
    assert all(row.taken <= 3 * row.size for row in rows)
