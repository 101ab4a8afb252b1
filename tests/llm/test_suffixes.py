import hashlib
import random

import numpy as np
import pytest

from meterline.llm import suffixes
from tests.llm.conftest import prose


def by_force(texts, length):
    """What is left of each text, from the set of all its strings."""
    times = {}
    for text in texts:
        for k in range(len(text) - length + 1):
            piece = text[k : k + length]
            times[piece] = times.get(piece, 0) + 1
    out = []
    for text in texts:
        gone = bytearray(len(text))
        for k in range(len(text) - length + 1):
            if times[text[k : k + length]] > 1:
                gone[k : k + length] = b"\x01" * length
        runs = sum(flag and not (k and gone[k - 1]) for k, flag in enumerate(gone))
        out.append((len(text), sum(gone), runs, bytes(b for b, flag in zip(text, gone) if not flag)))
    return out


def cut(spark, texts):
    df = spark.createDataFrame([(n, text) for n, text in enumerate(texts)], "doc_id long, text string")
    rows = suffixes.cut(df.repartition(3)).orderBy("doc_id").collect()
    return [(row.n_bytes, row.n_removed, row.n_spans, bytes(row.kept)) for row in rows]


def corpus(seed):
    """Passages in several texts, whole and cut short, next to each other and within one text; copies; runs."""
    draw = random.Random(seed)

    def noise(n, letters="abcdefé 日"):
        return "".join(draw.choice(letters) for _ in range(n))

    passages = [noise(draw.randint(30, 500)) for _ in range(6)]
    texts = []
    for _ in range(40):
        text = noise(draw.randint(0, 80))
        for _ in range(draw.randint(0, 3)):
            passage = draw.choice(passages)
            a = draw.choice([0, 0, draw.randrange(len(passage))])
            text += passage[a : draw.choice([None, None, draw.randrange(len(passage) + 1)])] + noise(draw.randint(0, 60))
        texts.append(text)
    return texts + texts[:3] + ["ab" * 300, "x" * 700, "", noise(40) + "x" * 150, "ab" * 90]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("slot", [4, 16])
def test_against_brute_force(spark, monkeypatch, seed, slot):
    monkeypatch.setattr(suffixes, "LENGTH", 100)
    monkeypatch.setattr(suffixes, "GRAM", 32)
    monkeypatch.setattr(suffixes, "SLOT", slot)
    texts = corpus(seed)
    assert cut(spark, texts) == by_force([text.encode() for text in texts], 100)


def test_pieces_of_long_texts(spark, monkeypatch):
    for name, value in {"LENGTH": 100, "GRAM": 32, "PIECE": 130, "TOGETHER": 500}.items():
        monkeypatch.setattr(suffixes, name, value)
    texts = corpus(9)
    assert cut(spark, texts) == by_force([text.encode() for text in texts], 100)


def test_every_string_has_one_sample_position_chosen_by_content():
    rng = np.random.default_rng(4)
    shared = rng.integers(0, 4, 900, dtype=np.uint8)
    data = np.concatenate([rng.integers(0, 4, 333, dtype=np.uint8), shared, rng.integers(0, 4, 77, dtype=np.uint8), shared])
    start, strings, behind, rank, _ = suffixes.sample(data, np.array([0, len(data)]))
    assert strings.sum() == len(data) - suffixes.LENGTH + 1
    at = {int(s) + k: (int(b) - k, int(r)) for s, n, b, r in zip(start, strings, behind, rank) for k in range(n)}
    assert all(0 <= offset <= suffixes.LENGTH - suffixes.GRAM for offset, _ in at.values())
    for k in range(len(shared) - suffixes.LENGTH + 1):
        assert at[333 + k] == at[333 + 900 + 77 + k]


def test_query_columns(spark, sf_dir, documents):
    texts = {row.doc_id: row.text.encode() for row in documents.collect()}
    expected = dict(zip(texts, by_force(list(texts.values()), 400)))
    for row in suffixes.op10_suffixes(spark, sf_dir).collect():
        size, removed, runs, kept = expected[row.doc_id]
        assert tuple(row)[1:] == (size, removed, runs, hashlib.sha256(kept).hexdigest())


def test_odd_rows(odd_documents, no_documents):
    found = suffixes.cut(odd_documents).collect()
    assert len(found) == odd_documents.count()
    assert {row.n_removed == row.n_bytes > 0 for row in found if row.doc_id in (1, 7)} == {True}
    assert {row.n_bytes for row in found if row.doc_id in (2, 3)} == {0}
    assert [row.n_removed for row in found if row.doc_id in (5, None)] == [0, 0, 0]
    assert suffixes.cut(no_documents).count() == 0


def test_repeated_rows_keep_the_list_of_one(spark, monkeypatch):
    """500 rows of one text gather as many spans as two."""
    sizes, text = [], prose(77, 900)
    merged = suffixes.merged
    seen = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(suffixes, "merged", lambda starts, ends: (seen.add(len(starts)), merged(starts, ends))[1])
    for rows in (2, 500):
        df = spark.createDataFrame([(1, text)] * rows, "doc_id long, text string").repartition(8)
        before = seen.value
        found = suffixes.cut(df).collect()
        assert len(found) == rows and all(row.n_removed == row.n_bytes and row.n_spans == 1 for row in found)
        sizes.append((seen.value - before) // rows)
    assert sizes[0] == sizes[1]
