import subprocess
import sys
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from meterline.llm import neardup, quality
from meterline.sources.scratch import stored


def test_stages_work_on_what_is_left(spark, sf_dir, documents):
    docs, counts = documents, [documents.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == documents.columns
        assert docs.exceptAll(documents.union(documents).union(documents)).isEmpty()
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == docs.count() and last.columns == [*documents.columns, "shard", "slot"]


def test_decisions_are_those_of_the_operators(spark, sf_dir, documents):
    kept = {row.doc_id for row in quality.score(documents).where("kept").collect()}
    docs = stored(corpus_pipeline.quality(spark, documents, sf_dir), "quality")
    assert {row.doc_id for row in docs.collect()} == kept
    first = {row.doc_id for row in neardup.near_duplicates(docs).where("kept").collect()}
    assert {row.doc_id for row in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()} == first


def rows_of(df):
    return Counter((row.doc_id, row.text, row.row, row.source) for row in df.select("doc_id", "text", "row", "source").collect())


def test_odd_rows_fare_as_the_operators_say(spark, sf_dir, odd_documents, no_documents):
    """Each stage by itself on nulls, empty and long texts, repeated rows and clashing columns; and on none."""
    docs = rows_of(odd_documents)
    good = Counter((row.doc_id, row.quality) for row in quality.score(odd_documents).where("kept").collect())
    kept = rows_of(corpus_pipeline.quality(spark, odd_documents, sf_dir))
    assert sum(kept.values()) == sum(good.values()) and kept <= docs and not any((text or "").strip() == "" for _, text, *_ in kept)

    unique = rows_of(corpus_pipeline.near_duplicates(spark, odd_documents, sf_dir))
    first = {(row.doc_id, row.text_key) for row in neardup.near_duplicates(odd_documents).where("kept").collect()}
    assert unique <= docs and len(first) == sum(unique.values()) == 7

    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").limit(1).collect()
    leak = odd_documents.limit(1).withColumns({"doc_id": F.lit(77).cast("long"), "text": F.lit(f"so: {items[0].text} and on")})
    clean = rows_of(corpus_pipeline.decontamination(spark, odd_documents.unionByName(leak), sf_dir))
    assert clean == docs

    mixed = rows_of(corpus_pipeline.mixing(spark, odd_documents, sf_dir))
    assert set(mixed) <= set(docs) and all(n <= 3 * docs[row] for row, n in mixed.items()) and mixed
    assert corpus_pipeline.mixing(spark, odd_documents, sf_dir).columns == odd_documents.columns

    dealt = corpus_pipeline.sharding(spark, odd_documents.drop("shard", "slot"), sf_dir).collect()
    assert Counter((row.doc_id, row.text, row.row, row.source) for row in dealt) == docs
    slots = Counter(row.shard for row in dealt)
    assert sorted((row.shard, row.slot) for row in dealt) == sorted((k, n) for k, size in slots.items() for n in range(size))

    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_documents, sf_dir).count() == 0


def test_other_queries_do_not_need_the_subpackage():
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None; sys.modules['meterline.llm'] = None;"
        "import __spark_entry__ as e; names = e.queries();"
        "assert 'm02_hourly_patterns' in names and not any(n.startswith('op') or n == 'pipeline' for n in names)"
    )
    subprocess.run([sys.executable, "-c", code], check=True)
