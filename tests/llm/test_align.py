import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meterline.llm import align
from meterline.sources.scratch import stored


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path(align.VOCABULARY_A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(align.VOCABULARY_B))


def plain(text, tokenizers):
    """Whole texts through both libraries, ends met one by one."""
    a, b = tokenizers
    if not text:
        return None
    byte = align._byte_of_character()
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_bytes = [bytes(byte[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b_ids, b.id_to_piece(b_ids))]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return None
    b_at, at, end = {}, 0, 0
    for j, token in enumerate(b_bytes):
        end += len(token)
        b_at[end] = j + 1
    groups, links, i0, j0 = [], [], 0, 0
    for i, token in enumerate(a_bytes):
        at += len(token)
        if at in b_at:
            groups.append((a_ids[i0 : i + 1], b_ids[j0 : b_at[at]]))
            links.append((a_ids[i], b_ids[b_at[at] - 1]))
            i0, j0 = i + 1, b_at[at]
    return a_ids, b_ids, groups, links


def expected_rows(texts, tokenizers):
    found = [plain(text, tokenizers) for text in texts]
    counts = Counter(link for one in found if one for link in one[3])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(n, best.get(b, 0))
    rows = []
    for one in found:
        if one is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = one
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((
            len(a), len(b), len(groups), len(links), sum(counts[k] == best[k[1]] for k in links),
            sum(counts[k] for k in links), hashlib.sha256(written.encode()).hexdigest(),
        ))
    return rows


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def found_rows(df):
    linked = stored(align.digests(align.align(df)), "linked")
    return align.with_link_counts(linked, align.link_counts(linked))


def test_query_equals_plain_encoding(spark, sf_dir, tokenizers):
    docs = {row.doc_id: row.text for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = {row.doc_id: tuple(row[c] for c in COLUMNS) for row in align.op11_token_alignment(spark, sf_dir).collect()}
    assert found == dict(zip(docs, expected_rows(docs.values(), tokenizers)))


ODD = [
    None, "", " ", "  ", "a  b", " a b ", "a\nb\n\n c", "\n", "▁x y", "x ▁", "it's they'll 're", "<s> x </s> <|endoftext|> <unk>",
    "日本語 テキスト é̀ ß 𝒳", "a  b", "a  b", "a　 b  c \u0085 d", "a  b  c", "﻿a b", "a\u0000b \u0001", "a\tb \t c",
    "1234567 89 0", "x" * 5000, "«¡Hola!» ¿qué? …", "ﬁ Ａ é é", "\x1f a \x1c b\x1d c", "🙂🙂 🙂", "a ​ b", "a​ b ᠎ c",
]


def test_odd_texts(spark, tokenizers):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    found = [tuple(row[c] for c in COLUMNS) for row in found_rows(df).orderBy("doc_id").collect()]
    assert found == expected_rows(ODD, tokenizers)


def test_mixed_white_space(spark, tokenizers):
    draw = random.Random(3)
    marks = [" ", "  ", "\n", "\t", " ", "　", " ", " ", "é", "ü ", ", ", "'s ", "a", "word", "B", "7", "…", "▁" * 0, "\x85", "\x1f"]
    texts = ["".join(draw.choice(marks) for _ in range(draw.randrange(1, 60))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = [tuple(row[c] for c in COLUMNS) for row in found_rows(df).orderBy("doc_id").collect()]
    assert found == expected_rows(texts, tokenizers)


@pytest.mark.parametrize("seed", range(20))
def test_cuts_are_the_common_ends(seed):
    draw = np.random.default_rng(seed)
    a_ends, b_ends, a_edges, b_edges, end = [], [], [0], [0], 0
    for _ in range(draw.integers(1, 12)):
        size = int(draw.integers(1, 3000))
        for ends, edges, share in ((a_ends, a_edges, draw.random()), (b_ends, b_edges, draw.random())):
            inner = np.flatnonzero(draw.random(size - 1) < share) + 1 if size > 1 else []
            ends.extend([*(end + np.array(inner, int)), end + size])
            edges.append(len(ends))
        end += size
    a_ends, b_ends = np.array(a_ends), np.array(b_ends)
    a, b = align.shared_cuts(a_ends, b_ends, np.array(a_edges), np.array(b_edges))
    assert a_ends[a].tolist() == b_ends[b].tolist() == np.intersect1d(a_ends, b_ends).tolist()


def test_a_long_stretch_without_cuts():
    a_ends, b_ends = np.append(2 * np.arange(1, 50_000), 100_001), np.append(2 * np.arange(1, 50_000) + 1, 100_001)
    a, b = align.shared_cuts(a_ends, b_ends, np.array([0, len(a_ends)]), np.array([0, len(b_ends)]))
    assert a.tolist() == [len(a_ends) - 1] and b.tolist() == [len(b_ends) - 1]


def test_pairs_stay_below_the_bound(spark, documents):
    linked = align.digests(align.align(documents))
    assert 0 < align.link_counts(linked).count() < align.pair_bound(align.Pair()) < 2_000_000


def test_odd_rows(odd_documents, no_documents, tokenizers):
    rows = odd_documents.select("doc_id", "text").collect()
    found = found_rows(odd_documents).collect()
    expected = expected_rows([row.text for row in rows], tokenizers)
    assert Counter((row.doc_id, *[row[c] for c in COLUMNS]) for row in found) == Counter((row.doc_id, *e) for row, e in zip(rows, expected))
    assert found_rows(no_documents).count() == 0


def test_groups_are_given(spark):
    row = align.align(spark.createDataFrame([(1, "Hello wonderful world")], "doc_id long, text string")).first()
    assert row.a_ends[-1] == len(row.a_ids) and row.b_ends[-1] == len(row.b_ids) and len(row.a_ends) == len(row.b_ends) >= 3
    assert align.align(spark.createDataFrame([(1, "x")], "doc_id long, text string")).select(F.size("a_ids")).first()[0] > 0
