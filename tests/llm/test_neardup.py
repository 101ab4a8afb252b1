import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import graph, neardup
from meterline.llm.darts import signatures
from meterline.llm.shingles import grams, hashed, words
from tests.llm.conftest import prose


def shingles(text):
    ws = words(text)
    return {tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))} if ws else set()


def classes_by_force(texts: dict) -> dict:
    """Least id of each class, comparing all pairs."""
    sets, parent = {n: shingles(text) for n, text in texts.items()}, {n: n for n in texts}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            union = len(sets[a] | sets[b])
            if words(texts[a]) == words(texts[b]) or union and len(sets[a] & sets[b]) / union >= 0.8:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in texts}


def edited(text, seed, changes):
    draw, ws = random.Random(seed), text.split()
    for _ in range(changes):
        ws[draw.randrange(len(ws))] = f"new{draw.randrange(10**9)}"
    return " ".join(ws)


def classes(df):
    return {row.doc_id: row.class_id for row in neardup.near_duplicates(df).collect()}


def test_classes_are_those_of_all_pairs(documents):
    assert classes(documents) == classes_by_force({row.doc_id: row.text for row in documents.collect()})


def test_a_large_group_and_chains(spark):
    """Hundreds of copies of one text with a few words changed, and texts that are alike in a chain only."""
    base, texts = prose(5, 200), {}
    for n in range(300):
        texts[n] = edited(base, n, n % 4)
    chain = prose(6, 200)
    for n in range(300, 312):
        texts[n] = chain = edited(chain, n, 3)
    for n in range(312, 330):
        texts[n] = prose(1000 + n, 200)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(8)
    assert classes(df) == classes_by_force(texts)


def test_a_passage_and_its_repetitions(spark):
    """Repeated shingles count once: each passage is alike to the same passage over and over."""
    texts = {}
    for n in range(12):
        for k, times in enumerate((1, 16, 256)):
            texts[3 * n + k] = " ".join([prose(2000 + n, 200)] * times)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(8)
    expected = classes_by_force(texts)
    assert set(expected.values()) == {3 * n for n in range(12)}
    assert classes(df) == expected


def test_comparisons_grow_with_the_number_of_nodes(spark):
    """Half of the words are those of all: the group shares buckets, but few of its texts are alike."""
    base = prose(5, 200)
    counts = []
    for size in (60, 240):
        members = [(b, n) for b in range(30) for n in range(size)]
        frame = spark.createDataFrame(members, "bucket long, node long").withColumn("label", F.col("node"))
        counts.append(neardup._leader_pairs(frame, 0).union(neardup._leader_pairs(frame, 1)).count())
    assert counts[1] < 5 * counts[0]
    texts = {n: edited(base.rsplit(" ", 60)[0] + " " + prose(n // 4, 60), n, 1) for n in range(120)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert classes(df) == classes_by_force(texts)


def test_many_classes_in_crowded_buckets(spark):
    """Pairs of similarity 0.81, while texts of different pairs have 0.78 and meet in the same buckets."""
    base, texts = prose(5, 172)[:-1], {}
    for n in range(240):
        texts[n] = f"{base} {prose(7000 + n % 120, 4)[:-1]} {prose(8000 + n, 20)}"
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(8)
    expected = classes_by_force(texts)
    assert len(set(expected.values())) == 120
    assert classes(df) == expected


def test_filtered_pairs_hold_all_that_are_alike(spark, monkeypatch):
    """Whatever the sizes of sets, and with shingles that are dealt out to several tasks."""
    monkeypatch.setattr(neardup, "SPLIT", 7)
    draw, sets = random.Random(4), {}
    for n in range(150):
        size = draw.choice([1, 2, 4, 5, 9, 10, 30, 40])
        sets[n] = set(range(size)) ^ set(draw.sample(range(60), draw.randrange(3)))
    sets = {n: {x * 70_000_001 % 2**32 for x in found} for n, found in sets.items() if found}
    rows = [(n, bytearray(np.array(sorted(found), "<u4").tobytes())) for n, found in sets.items()]
    frame = spark.createDataFrame(rows, "node long, shingles binary")
    labelled = frame.select("node", (F.col("node") % 50).alias("label"))
    pairs = {(row.a, row.b) for row in neardup._filtered_pairs(labelled, frame).collect()}
    alike = {
        (a, b) for a in sets for b in sets
        if a < b and a % 50 != b % 50 and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8
    }
    assert alike <= pairs and len(alike) > 100


def test_repeated_rows_have_one_set(spark, monkeypatch):
    """200 rows of one text and 200 of a near one: two sets, one link."""
    sizes, of_sets, verified = [], neardup._sets_of, neardup._verified
    monkeypatch.setattr(neardup, "_sets_of", lambda *a: sizes.append((out := of_sets(*a)).count()) or out)
    monkeypatch.setattr(neardup, "_verified", lambda *a: sizes.append((out := verified(*a)).count()) or out)
    base = prose(41, 300)
    rows = [(1, base)] * 200 + [(2, edited(base, 1, 2))] * 200
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert {(row.doc_id, row.class_id, row.class_size) for row in neardup.near_duplicates(df).collect()} == {(1, 1, 400), (2, 1, 400)}
    assert sizes == [2, 1]


def test_pairs_compared_do_not_grow_with_the_square(spark, monkeypatch):
    """Copies of one text, each with other edits, so that no two are alike though all meet in buckets."""
    compared, verified = [], neardup._verified
    monkeypatch.setattr(neardup, "_verified", lambda pairs, sets: compared.append(pairs.distinct().count()) or verified(pairs, sets))
    base, counts = prose(5, 200), []
    for size in (100, 400):
        texts = {n: edited(base, n, 16) for n in range(size)}
        df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(8)
        compared.clear()
        found = classes(df)
        counts.append(sum(compared))
        if size == 100:
            assert found == classes_by_force(texts)
    assert counts[1] < 8 * counts[0]


def test_parity_sketches_bound_the_difference():
    draw = np.random.default_rng(3)
    for _ in range(50):
        a, b = (np.unique(draw.integers(0, 3000, draw.integers(1, 2000))).astype(np.uint32) for _ in range(2))
        bits = int(np.bitwise_count(neardup.parity(a) ^ neardup.parity(b)).sum())
        assert bits <= len(np.setxor1d(a, b)) and (bits - len(np.setxor1d(a, b))) % 2 == 0


def test_signatures_agree_as_often_as_weighted_sets_do():
    rng = np.random.default_rng(2)
    elements = rng.integers(0, 2**63, 400).astype(np.uint64)
    a, b = rng.uniform(0.2, 6, 400), rng.uniform(0.2, 6, 400)
    a[:100], b[300:] = 0, 0
    expected = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    both = np.concatenate([elements[a > 0], elements[b > 0]])
    weights = np.concatenate([a[a > 0], b[b > 0]])
    owner = np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
    x, y = signatures(both, weights, owner, 2, 2000)
    assert (x == y).mean() == pytest.approx(expected, abs=0.05)
    alone = signatures(elements[a > 0], a[a > 0], np.zeros((a > 0).sum(), int), 1, 2000)
    assert (alone[0] == x).all()


def test_signature_of_any_size():
    for n in (0, 1, 3, 50_000):
        out = signatures(np.arange(1, n + 1, dtype=np.uint64), np.ones(n), np.zeros(n, int), 1, 64)
        assert (out != 0).all() == (n > 0)


def test_short_texts_are_one_gram():
    value, text, start = grams(*hashed([words("a b"), [], words("a b c d e f"), words("a b")]), 5)
    assert text.tolist() == [0, 2, 2, 3] and start.tolist() == [0, 0, 1, 0] and value[0] == value[3] != value[1]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(40)] + [(n, n + 1) for n in range(100, 130)]
    found = {row.a: row.b for row in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {n: n for edge in edges for n in edge}
    for _ in parent:
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert found == {n: least for n, least in parent.items() if n != least}


def test_odd_rows(odd_documents, no_documents):
    found = neardup.near_duplicates(odd_documents).collect()
    assert len(found) == odd_documents.count()
    assert {row.class_id for row in found if row.doc_id in (1, 7, 8)} == {1}
    assert {row.class_id for row in found if row.doc_id in (2, 3, 4, 10)} == {2}
    assert all(row.class_id < 0 for row in found if row.doc_id is None)
    kept = neardup.without_near_duplicates(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = sorted(row.doc_id or 0 for row in kept.collect())
    assert ids == sorted([1, 2, 5, 6, 0, 0, 9])
    assert neardup.near_duplicates(no_documents).count() == 0
    assert neardup.without_near_duplicates(no_documents).count() == 0
