import glob
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.orc
import pytest
from tokenizers import Tokenizer

from meterline.llm import tokens

VOCABULARY = public_tokenizers.path(tokens.VOCABULARY)
ODD = [
    "a<|startoftext|>b <|endoftext|> c", "", "  ", "\x1ca b\x1c\x1d", "É é̀ ̀x Σ ΣΑΣ ΣΑΣ. 日本 　 a b   x",
    "don't we're I'VE 's a,'s b.'T c,, d,e .f! ?g (h). i.e.; J'LL,K é,É. x́, ß.", "x" * 5000, "tab\tline\r\nend", "ﬁ ½ Ⅷ 12345",
]


def plain(texts):
    encoded = Tokenizer.from_file(VOCABULARY).encode_batch(list(texts), add_special_tokens=False)
    return [row.ids for row in encoded]


def test_chunks_give_the_ids_of_whole_texts(documents):
    texts = [row.text for row in documents.collect()] + ODD
    flat, counts = tokens.ChunkEncoder(VOCABULARY).encode(texts)
    assert [row.tolist() for row in np.split(flat, np.cumsum(counts)[:-1])] == plain(texts)


def test_a_small_memory_gives_the_same(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    monkeypatch.setattr(tokens, "TOGETHER", 20)
    coder = tokens.ChunkEncoder(VOCABULARY)
    for text in ODD:
        assert coder.encode([text])[0].tolist() == plain([text])[0]


def test_query_against_plain_encoding(spark, sf_dir, documents):
    rows, start = sorted(tokens.op8_tokens(spark, sf_dir).collect()), 0
    texts = sorted((row.doc_id, row.text) for row in documents.collect())
    for row, (doc_id, _), ids in zip(rows, texts, plain(text for _, text in texts), strict=True):
        ids = [*ids, 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(row) == (doc_id, start, len(ids), crc)
        start += len(ids)


@pytest.fixture(scope="module")
def written(spark, documents, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tokens") / "out")
    tokens.write_tokens(documents.repartition(5), path, VOCABULARY)
    return path


def test_files_are_in_order_and_hold_indexes(spark, written, documents):
    ids = []
    for file in sorted(glob.glob(f"{written}/part-*.orc")):
        held = pyarrow.orc.ORCFile(file)
        assert held.nstripes >= 1 and held.row_index_stride == tokens.INDEX_ROWS
        ids += held.read(["doc_id"])["doc_id"].to_pylist()
        assert held.compression == "ZSTD"
    assert ids == sorted(row.doc_id for row in documents.collect())


def test_lookups_are_pushed_to_the_files(spark, written):
    some = tokens.read_tokens(spark, written, [3, 77, 10**9])
    assert sorted(row.doc_id for row in some.collect()) == [3, 77]
    pushed = re.search(r"PushedFilters: \[In\(doc_id, \[([\d,]+)\]\)\]", some._jdf.queryExecution().toString())
    assert set(pushed[1].split(",")) == {"3", "77", "1000000000"}


def rows_scanned(df):
    """Rows that the scan handed on, and the rows found."""
    found = df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value(), found


def test_bloom_filters_tell_that_an_id_is_absent(spark, tmp_path, monkeypatch):
    """Odd ids lie between the stored ones, so minimum and maximum do not tell; the Bloom filter does."""
    docs = spark.range(0, 8000, 2).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    tokens.write_tokens(docs, str(tmp_path / "with"), VOCABULARY)
    assert rows_scanned(tokens.read_tokens(spark, str(tmp_path / "with"), [4001])) == (0, [])
    scanned, found = rows_scanned(tokens.read_tokens(spark, str(tmp_path / "with"), [4002]))
    assert 0 < scanned <= tokens.INDEX_ROWS and [row.doc_id for row in found] == [4002]
    without = {name: value for name, value in tokens.ORC_OPTIONS.items() if "bloom" not in name}
    monkeypatch.setattr(tokens, "ORC_OPTIONS", without)
    tokens.write_tokens(docs, str(tmp_path / "without"), VOCABULARY)
    assert rows_scanned(tokens.read_tokens(spark, str(tmp_path / "without"), [4001]))[0] > 0


def test_stripes_are_read_apart_and_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokens, "ORC_OPTIONS", tokens.ORC_OPTIONS | {"orc.stripe.size": "65536", "orc.stripe.row.count": "1000"})
    docs = spark.range(6000).selectExpr("id AS doc_id", "repeat(concat('some words ', id, ' '), 30) AS text")
    path = str(tmp_path / "stripes")
    tokens.write_tokens(docs.coalesce(1), path, VOCABULARY)
    stripes = [pyarrow.orc.ORCFile(file).nstripes for file in glob.glob(f"{path}/part-*.orc")]
    assert max(stripes) > 1
    rows = tokens.describe_tokens(spark, path).orderBy("doc_id").collect()
    assert [row.start for row in rows] == np.concatenate(([0], np.cumsum([r.n_tokens for r in rows])[:-1])).tolist()


def test_odd_rows(spark, odd_documents, no_documents, tmp_path):
    path = str(tmp_path / "odd")
    tokens.write_tokens(odd_documents, path, VOCABULARY)
    rows = tokens.describe_tokens(spark, path).orderBy("start").collect()
    assert len(rows) == odd_documents.count() and rows[0].doc_id is None
    assert [row.start for row in rows] == np.concatenate(([0], np.cumsum([r.n_tokens for r in rows])[:-1])).tolist()
    assert [row.n_tokens for row in rows if row.doc_id in (2, 3, 4)] == [1, 1, 1]
    tokens.write_tokens(no_documents, str(tmp_path / "none"), VOCABULARY)
    assert tokens.describe_tokens(spark, str(tmp_path / "none")).count() == 0
