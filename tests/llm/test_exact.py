from pyspark.sql import functions as F

from meterline.llm import exact
from meterline.settings import JoinBounds


def groups(df, **more):
    return sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept) for r in exact.group_equal(df, **more).collect())


def test_longest_then_smallest_id_stays(spark):
    df = spark.createDataFrame(
        [(5, "a b"), (3, "ab"), (4, "a  b"), (2, "a \tb"), (9, None), (8, ""), (7, " \n"), (1, "AB"), (2**62, "x"), (-3, "x")],
        "doc_id long, text string",
    )
    assert groups(df) == sorted(
        [
            (5, 2, 4, False), (3, 2, 4, False), (4, 2, 4, False), (2, 2, 4, True),
            (9, 7, 3, False), (8, 7, 3, False), (7, 7, 3, True), (1, 1, 1, True), (2**62, -3, 2, False), (-3, -3, 2, True),
        ]
    )


def test_contents_decide_where_digests_collide(documents):
    def short(text):
        return F.substring(F.sha2(text, 256), 1, 1)

    assert groups(documents) == groups(documents, digest=short, salts=3)


def test_other_white_space_counts(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "a b")], "doc_id long, text string")
    assert {size for _, _, size, _ in groups(df)} == {1}


def test_odd_rows(odd_documents, no_documents):
    found = exact.group_equal(odd_documents).collect()
    assert len(found) == odd_documents.count()
    copies = [row for row in found if row.doc_id in (1, 7)]
    assert {(row.keep_id, row.group_size) for row in copies} == {(1, 3)}
    assert [row.kept for row in copies if row.doc_id == 1] == [True, True]
    assert exact.group_equal(no_documents).count() == 0


def test_one_text_with_a_third_of_the_rows(spark):
    df = spark.range(0, 3000, 1, 12).selectExpr("id AS doc_id", "CASE id % 3 WHEN 0 THEN 'hot text' ELSE concat('t', id) END AS text")
    row = exact.group_equal(df, salts=4).where("doc_id = 999").first()
    assert (row.keep_id, row.group_size, row.kept) == (0, 1000, False)


def test_a_group_with_most_rows_is_spread(spark):
    """Without any adaptive setting, the tasks of the last join are about even."""
    docs = spark.range(0, 40_000, 1, 8).selectExpr("id AS doc_id", "IF(id % 3 = 0, concat('text ', id), 'one text') AS text")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = exact.group_equal(docs, bounds=JoinBounds(hot_keys=100))
        sizes = sorted(row["count"] for row in found.groupBy(F.spark_partition_id()).count().collect())
        assert sum(sizes) == 40_000 and sizes[-1] < 2 * sizes[len(sizes) // 2]
        assert found.where("group_size > 1").agg(F.min("keep_id"), F.max("keep_id"), F.count("*")).first()[:] == (1, 1, 26_666)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
