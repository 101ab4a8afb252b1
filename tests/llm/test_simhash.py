import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from meterline.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {n: n + 32 for n in range(65, 91)}


def plain_fingerprint(text):
    words = WORD.findall((text or "").translate(UPPER))
    grams = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    counts = [0] * 64
    for gram in grams:
        h = xxhash.xxh64_intdigest(gram.encode(), 42)
        for k in range(64):
            counts[k] += h >> k & 1
    return sum((2 * n > len(grams)) << k for k, n in enumerate(counts))


def components_by_force(points):
    """Least place of each place's component, over all pairs."""
    points, least = np.array(points, dtype=np.uint64), np.arange(len(points))
    near = np.bitwise_count(points[:, None] ^ points) <= 2
    while True:
        new = np.array([least[row].min() for row in near])
        if (new == least).all():
            return least.tolist()
        least = new


def expected_rows(rows):
    prints = [plain_fingerprint(text) for _, text in rows]
    distinct = sorted(set(prints))
    root = dict(zip(distinct, components_by_force(distinct)))
    least = {}
    for (doc_id, _), p in zip(rows, prints):
        if doc_id is not None:
            least[root[p]] = min(doc_id, least.get(root[p], doc_id))
    return [(doc_id, f"{p:016x}", least.get(root[p])) for (doc_id, _), p in zip(rows, prints)]


def test_query_equals_all_pairs(spark, sf_dir):
    rows = [(row.doc_id, row.text) for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = simhash.op12_simhash(spark, sf_dir).collect()
    assert Counter(map(tuple, found)) == Counter(expected_rows(rows))
    assert len({row.component_id for row in found}) < len(rows)


@pytest.mark.parametrize("words", [0, 1, 2, 3, 4, 255, 256, 257, 258, 600, 255 * 256 + 2, 255 * 256 + 3])
def test_fingerprints_of_any_length(words):
    draw = random.Random(words)
    text = " \n".join(draw.choice(["Ää", "B", "ccC", "日", "\xa0d"]) + str(draw.randrange(40)) for _ in range(words))
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def clustered(seed, count, spread):
    """Random points, dense balls, chains and a few hundred neighbours of each other."""
    draw = np.random.default_rng(seed)
    points = set(draw.integers(0, 2**63, count, dtype=np.uint64).tolist())
    for centre in draw.integers(0, 2**63, 6, dtype=np.uint64).tolist():
        for _ in range(spread):
            point = centre
            for bit in draw.integers(0, 64, draw.integers(0, 7)).tolist():
                point ^= 1 << bit
            points.add(point)
    point = 7
    for bit in draw.integers(0, 64, 100).tolist():
        point ^= 1 << bit
        points.add(point)
    return np.array(sorted(points), dtype=np.uint64)


@pytest.mark.parametrize("seed", range(4))
def test_links_join_all_that_are_near(seed):
    points = clustered(seed, 1500, 150)
    found = simhash.stars(len(points), *simhash.links_within(points))
    assert found.tolist() == components_by_force(points)


def test_points_that_no_radius_parts():
    """All points within two bits of one."""
    points = np.array(sorted({0, *(1 << k for k in range(64)), *(1 << j | 1 << k for j in range(64) for k in range(j))}), np.uint64)
    a, b = simhash.links_within(points)
    assert (simhash.stars(len(points), a, b) == 0).all()
    a, b = simhash.midpoint_links(points)
    assert (np.bitwise_count(points[a] ^ points[b]) <= 2).all() and (simhash.stars(len(points), a, b) == 0).all()


@pytest.mark.parametrize("shard_size, sample_size", [(300, 4096), (60, 65536)])
def test_shards_of_any_size(spark, shard_size, sample_size):
    points = clustered(9, 2000, 120)
    frame = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "point long")
    found = {row.a: row.b for row in simhash.linked_points(frame, 2, shard_size, sample_size).collect()}
    signed = points.view(np.int64).tolist()
    root = components_by_force(points)
    groups = {}
    for p, r in zip(signed, root):
        groups.setdefault(r, []).append(p)
    assert found == {p: min(own) for own in groups.values() for p in own if p != min(own)}


def test_dense_shards(spark):
    points = np.array([1 << j | 1 << k for j in range(40) for k in range(j)] + [2**40 + 2**50, 2**60 - 1], np.uint64)
    frame = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "point long")
    links = {(row.a, row.b) for row in simhash._links_of_dense(frame).collect()}
    place = {int(p): n for n, p in enumerate(points.view(np.int64))}
    a, b = (np.array([place[link[side]] for link in links]) for side in (0, 1))
    assert simhash.stars(len(points), a, b).tolist() == components_by_force(points)
    found = {row.a: row.b for row in simhash.linked_points(frame, 2, 50, 4096).collect()}
    assert len(found) == sum(n != least for n, least in enumerate(components_by_force(points)))


def test_odd_rows(odd_documents, no_documents):
    rows = [(row.doc_id, row.text) for row in odd_documents.collect()]
    found = [(row.doc_id, f"{row.point % 2**64:016x}", row.component_id) for row in simhash.near_copies(odd_documents).collect()]
    assert Counter(found) == Counter(expected_rows(rows))
    assert simhash.near_copies(no_documents).count() == 0
