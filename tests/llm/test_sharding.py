import numpy as np
import pytest

from meterline.llm import sharding


@pytest.mark.parametrize("size", [1, 2, 3, 16, 17, 1000, 65_537])
def test_bijection(size):
    assert sorted(sharding.permuted(np.arange(size), size, 11)) == list(range(size))


def test_bijection_of_a_huge_range_looks_uniform():
    size = 10**13
    slots = sharding.permuted(np.arange(20_000), size, 5)
    assert len(set(slots)) == 20_000 and slots.min() >= 0 and slots.max() < size
    counts = np.histogram(slots, bins=10, range=(0, size))[0]
    assert abs(counts - 2000).max() < 250


def test_matrix_has_both_margins():
    rows, shards = [10, 0, 7, 300, 1], [80, 80, 79, 79]
    matrix = sharding.communication_matrix(rows, shards)
    assert matrix.sum(axis=1).tolist() == rows and matrix.sum(axis=0).tolist() == shards
    assert (matrix >= 0).all()


def test_tabulated_law_agrees_with_the_drawn_one(monkeypatch):
    rng = np.random.default_rng(3)
    drawn = [sharding.hypergeometric(rng, 5000, 95_000, 2000) for _ in range(3000)]
    monkeypatch.setattr(sharding, "DRAWN_BY_NUMPY", 1)
    tabulated = [sharding.hypergeometric(rng, 5000, 95_000, 2000) for _ in range(3000)]
    assert np.mean(drawn) == pytest.approx(np.mean(tabulated), abs=1)
    assert np.std(drawn) == pytest.approx(np.std(tabulated), rel=0.1)
    assert {sharding.hypergeometric(rng, 3, 2, 4) for _ in range(50)} == {2, 3}
    assert sharding.hypergeometric(rng, 3, 0, 2) == 2
    # above what numpy can draw
    assert 0 <= sharding.hypergeometric(rng, 10**12, 10**12, 10**6) <= 10**6


def test_query(spark, sf_dir, documents):
    rows = sharding.op4_sharding(spark, sf_dir).collect()
    assert sorted(row.doc_id for row in rows) == sorted(row.doc_id for row in documents.collect())
    by_shard = {}
    for row in rows:
        by_shard.setdefault(row.shard, []).append(row.slot)
    assert sorted(by_shard) == list(range(24))
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1


def test_rows_keep_their_columns_and_repeats(odd_documents, no_documents):
    out = sharding.shuffle_to_shards(odd_documents, shards=4, file_rows=5, block_rows=2)
    same = [name for name in odd_documents.columns if name not in ("shard", "slot")]
    assert out.columns == [*same, "shard", "slot"]
    assert out.select(same).exceptAll(odd_documents.select(same)).isEmpty()
    assert out.count() == odd_documents.count()
    assert sharding.shuffle_to_shards(no_documents).count() == 0


def test_a_row_may_come_anywhere(spark):
    """Over many seeds each row comes to each shard about equally often."""
    starts = [sharding.first_arrivals(sharding.communication_matrix([6, 6], [4, 4, 4], seed)) for seed in range(600)]
    hits = np.zeros((12, 3))
    for seed, first in enumerate(starts):
        for partition in range(2):
            shard, _ = sharding.placed(partition, np.arange(6), first, seed)
            hits[6 * partition + np.arange(6), shard] += 1
    assert abs(hits - 200).max() < 65
