import random

import numpy as np
import pytest

from meterline.llm import decontaminate as d
from meterline.llm.shingles import hashed, hashed_texts, words
from tests.llm.conftest import prose


def smith_waterman(item, text):
    """The table cell by cell."""
    best, table = 0, np.zeros((len(item) + 1, len(text) + 1), dtype=int)
    for i in range(1, len(item) + 1):
        for j in range(1, len(text) + 1):
            match = d.MATCH if item[i - 1] == text[j - 1] else d.MISMATCH
            table[i, j] = max(0, table[i - 1, j - 1] + match, table[i - 1, j] + d.GAP, table[i, j - 1] + d.GAP)
            best = max(best, table[i, j])
    return best


@pytest.mark.parametrize("seed", range(20))
def test_alignment(seed):
    rng = np.random.default_rng(seed)
    item, text = rng.integers(0, 5, 12).astype(np.uint64), rng.integers(0, 5, 30).astype(np.uint64)
    score, _, start, end = d.align(item, text)
    assert round(score * d.MATCH * len(item)) == smith_waterman(item, text)
    assert smith_waterman(item, text[start:end]) == smith_waterman(item, text)


def leaks(spark, texts, items):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    frame = spark.createDataFrame(list(items.items()), "item_id long, text string")
    return {(row.doc_id, row.item_id): row for row in d.find_leaks(docs, frame).collect()}


def by_force(texts, items):
    """All documents against all items, whole."""
    out = {}
    for i, item in items.items():
        flat, _ = hashed_texts([item])
        for n, text in texts.items():
            found, _ = hashed_texts([text])
            score, common, *_ = d.align(flat, found) if len(flat) and len(found) else (0, 0, 0, 0)
            if score >= 1 - 1e-9 or score >= d.LEAKED and common >= d.LEAST_MATCHED:
                out[n, i] = score
    return out


def test_words_of_chunks_are_those_of_texts(documents):
    odd = [None, "", " ", "ΣΑΣ ΣΑΣ. Σ", "a\x1cb\x85c d　e", "İstanbul ǅ ﬁ", "x_1 2-3\n\n4\t5\x0b6", "日本 é̀ ß"]
    texts = [row.text for row in documents.collect()] + odd
    flat, edges = hashed_texts(texts)
    listed = [words(text) for text in texts]
    assert np.diff(edges).tolist() == [len(ws) for ws in listed]
    pairs = set(zip(flat.tolist(), [word for ws in listed for word in ws], strict=True))
    assert len(pairs) == len({h for h, _ in pairs}) == len({word for _, word in pairs})


def test_short_items_are_matched_whole(spark):
    items = {0: "blue green red", 1: "one two three four five six seven", 2: "single", 3: "blue blue green"}
    texts = {
        0: "so Blue, GREEN red it is", 1: "blue green and red", 2: "one two three four five six 7 seven", 3: "a single one",
        4: "x one two three four five six seven y blue blue green", 5: "nothing here",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = d.find_leaks(docs, spark.createDataFrame(list(items.items()), "item_id long, text string"))
    assert {(row.doc_id, row.item_id) for row in found.collect()} == set(by_force(texts, items)) == {(0, 0), (4, 1), (3, 2), (4, 3)}


def changed(text, share, seed):
    draw, ws = random.Random(seed), text.split()
    for k in range(len(ws)):
        if draw.random() < share:
            ws[k] = f"other{draw.randrange(10**6)}"
    draw = draw.randrange(len(ws) - 1)
    return " ".join(ws[:draw] + ["extra"] + ws[draw + 1 :])


def planted():
    items = {n: prose(500 + n, 30) for n in range(12)}
    texts = {n: prose(n, 300) for n in range(40)}
    for n in range(12):
        texts[100 + n] = f"{prose(200 + n, 50)} {items[n].upper()} {prose(300 + n, 50)}"
        texts[200 + n] = f"{prose(200 + n, 50)} {changed(items[n], 0.12, n)} {prose(300 + n, 50)}"
    return texts, items


def test_planted_copies_and_edits_are_found_and_nothing_else(spark):
    texts, items = planted()
    found = leaks(spark, texts, items)
    assert found.keys() == by_force(texts, items).keys() >= {(100 + n, n) for n in range(12)}
    assert {n for n, _ in found} <= set(range(100, 212))
    # two of the edited copies lost so many words that aligning whole texts does not reach the score either
    assert sum(n >= 200 for n, _ in found) == 10
    assert all(found[100 + n, n].score == 1.0 and found[100 + n, n].first_word == 50 for n in range(12))


def test_same_leaks_as_aligning_everything(spark, sf_dir, documents):
    items = {row.item_id: row.text for row in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    texts = {row.doc_id: row.text for row in documents.collect()}
    found = {(row.doc_id, row.item_id) for row in d.op2_decontamination(spark, sf_dir).collect()}
    assert found == by_force(texts, items).keys()


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    texts, items = planted()
    whole = leaks(spark, texts, items).keys()
    monkeypatch.setattr(d, "BLOCK_WORDS", 100)
    assert leaks(spark, texts, items).keys() == whole


def test_items_of_common_grams_only(spark):
    """Every document holds the item, so none of its grams is rare."""
    item = prose(7, 25)
    texts = {n: f"{prose(n, 40)} {item} {prose(n + 500, 40)}" for n in range(60)}
    assert leaks(spark, texts, {1: item}).keys() == {(n, 1) for n in texts}


def regularly(text, every, insert):
    """Every n-th word replaced, or an extra word after every n-th."""
    out = []
    for k, word in enumerate(text.split()):
        at_turn = k % every == every - 1
        out += [word, f"extra{k}"] if insert and at_turn else [f"other{k}"] if at_turn else [word]
    return " ".join(out)


def test_regular_edits_are_found(spark):
    """No four words in a row are left, in some no three, and the alignment still accepts most."""
    items = {n: prose(500 + n, 15 + 5 * n) for n in range(9)}
    texts = {n: prose(n, 300) for n in range(10)}
    kinds = [(2, True), (3, True), (4, True), (1, True), (3, False), (4, False), (5, False)]
    for n, item in items.items():
        for k, kind in enumerate(kinds):
            texts[100 * (k + 1) + n] = f"{prose(200 + n, 50)} {regularly(item, *kind)} {prose(300 + n, 50)}"
    expected = by_force(texts, items)
    for k in (0, 1, 2, 5, 6):
        assert sum(n // 100 == k + 1 for n, _ in expected) >= 8
    assert leaks(spark, texts, items).keys() == expected.keys()


def test_edited_copies_of_an_item_in_many_documents(spark):
    """All words of the item are common, and each edited copy has four in a row at one place only."""
    item = prose(7, 30)
    texts = {n: f"{prose(n, 5)} {item} {prose(n + 5000, 5)}" for n in range(1100)}
    for first in range(27):
        ws = item.split()
        for k in [*range(first - 1, -1, -4), *range(first + 4, 30, 4)]:
            ws[k] = f"other{k}"
        texts[2000 + first] = f"{prose(first + 9000, 20)} {' '.join(ws)} {prose(first + 9500, 20)}"
    expected = by_force(texts, {1: item}).keys()
    assert len(expected) > 1115
    assert leaks(spark, texts, {1: item}).keys() == expected


def test_odd_rows(spark, odd_documents, no_documents):
    text = odd_documents.where("doc_id = 7").first().text
    items = spark.createDataFrame(
        [(1, text[:300], "x"), (1, text[:300], "x"), (None, text[:200], "y"), (3, None, None), (4, "", None), (5, "a b", None)],
        "item_id long, text string, words string",
    )
    found = d.find_leaks(odd_documents, items)
    assert {row.doc_id for row in found.collect()} == {1, 7, 8}
    left = d.without_leaks(odd_documents, items)
    assert left.columns == odd_documents.columns
    assert {row.doc_id for row in left.collect()} == {2, 3, 4, 5, 6, 9, 10, None}
    assert d.find_leaks(no_documents, items).count() == 0
    assert d.find_leaks(odd_documents, items.limit(0)).count() == 0
    assert d.without_leaks(odd_documents, items.limit(0)).count() == odd_documents.count()
