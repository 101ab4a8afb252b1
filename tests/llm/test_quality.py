import numpy as np
import pytest

from meterline.llm import quality


def test_label_model_recovers_accuracies():
    """Three labellers of known accuracy, each for faults of its own, that often do not vote."""
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.7
    right_on_bad, right_on_good = np.array([0.9, 0.8, 0.7, 0.85]), np.array([0.97, 0.95, 0.99, 0.9])
    right = rng.random((20_000, 4)) < np.where(good[:, None], right_on_good, right_on_bad)
    vote = np.where(right == good[:, None], 1, -1) * (rng.random((20_000, 4)) < 0.8)
    pattern, count = np.unique((vote + 1) @ 3 ** np.arange(4), return_counts=True)
    probability, prior, accuracy = quality.estimate(pattern, count.astype(float), labellers=4)
    assert prior == pytest.approx(0.7, abs=0.03)
    assert accuracy[:, 0] == pytest.approx(right_on_bad, abs=0.06)
    assert accuracy[:, 1] == pytest.approx(right_on_good, abs=0.04)
    assert len(probability) == len(pattern)


def test_held_out_accuracy(spark):
    """The labels are not used in training."""
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels = labels.withColumnRenamed("quality", "quality_1")
    found = quality.op5_quality(spark, sf_dir).join(labels, "doc_id").collect()
    good, bad = [r for r in found if r.quality_1], [r for r in found if not r.quality_1]
    assert sum(row.kept for row in good) / len(good) > 0.97
    assert sum(not row.kept for row in bad) / len(bad) > 0.9


def test_reruns_and_partitions_do_not_matter(documents):
    first = {row.doc_id: row.quality for row in quality.score(documents).collect()}
    again = {row.doc_id: row.quality for row in quality.score(documents.repartition(7)).collect()}
    assert first == again


def test_a_small_training_sample(documents):
    weights = quality.train(documents, rows=40)
    assert weights.shape == (quality.BUCKETS + 1,) and np.count_nonzero(weights) > 10


def test_odd_rows(odd_documents, no_documents):
    found = quality.score(odd_documents)
    assert found.count() == odd_documents.count()
    assert {row.quality for row in found.where("doc_id IN (2, 3, 4)").collect()} == {0.0}
    kept = quality.of_quality(odd_documents)
    assert kept.columns == odd_documents.columns
    assert kept.where("doc_id IN (2, 3, 4)").isEmpty()
    assert quality.score(no_documents).count() == quality.of_quality(no_documents).count() == 0
