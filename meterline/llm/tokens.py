"""Token ids as ORC: written in order of document ids, read back by stripe.

The files use what ORC offers for this: run-length encoded integers, a row index every
``INDEX_ROWS`` rows, and Bloom filters on the document id beside its minimum and maximum. A lookup of
some documents therefore skips files, stripes and row groups by metadata alone, and a full read is
split by stripe.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline.llm.batches import bound_batches, lists, over_batches, worker_memory
from meterline.llm.chunks import Remembered, blocks, tiles
from meterline.sources.scratch import scratch_path, stored

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
INDEX_ROWS = 1000
STRIPE_BYTES = 64 * 1024 * 1024
ROWS_PER_FILE = 1_000_000

ORC_OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.row.index.stride": str(INDEX_ROWS),
    "orc.stripe.size": str(STRIPE_BYTES),
    "orc.compress": "ZSTD",
}
#: a special token of the vocabulary, put between chunks that are encoded in one call
PARTING = "<|startoftext|>"
CHUNKS_PER_CALL = 200
#: bytes of text that are put together from chunks at once
TOGETHER = 4 << 20
#: ids of distinct chunks a worker remembers before it starts anew
REMEMBERED = 1_000_000
_WHITE, _DIGIT, _LETTER = (np.isin(np.arange(256), list(some)) for some in (b"\t\n\r ", b"0123456789", b"abcdefghijklmnopqrstuvwxyz"))
#: ASCII characters that end a run of letters: all but the apostrophe, which letters may follow in one piece
_MARK = np.isin(np.arange(256), list(b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')) | _DIGIT
_ONE_SPACE = bytes(32 if byte in b"\t\n\r" else byte for byte in range(256))
SPECIAL = b"<|"


def chunk_starts(data: np.ndarray, begins: np.ndarray, special: bool = False) -> np.ndarray:
    """Where chunks start in lower-case texts that follow each other: at each text's own start, at white space, at a
    mark or digit right behind an ASCII letter, which ends the run of letters that is encoded by itself, and behind
    each digit, which is a piece of its own. Where a special token may be spelt, at white space only."""
    starting = _WHITE[data]
    if not special:
        starting[1:] |= _MARK[data[1:]] & _LETTER[data[:-1]] | _DIGIT[data[:-1]]
    starting[begins] = True
    return np.flatnonzero(starting)


class ChunkEncoder:
    """Ids of whole texts by a vocabulary that drops white space.

    A piece of such a vocabulary never spans a space, tab or line end, nor a letter and a mark behind it, so the
    ids of a text are those of its chunks between them, one after the other. It knows no upper case, so ASCII
    letters are lowered first, unless a special token may be spelt. Chunks recur, so most are encoded once per
    worker, and ids are gathered for whole blocks of text.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.parting_id = self.tokenizer.token_to_id(PARTING)
        self.remembered = Remembered(self._encode, 1, most=REMEMBERED)

    def _encode(self, chunks: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        ids = list(self._encode_chunks([chunk.decode().strip(" \t\n\r") for chunk in chunks]))
        return [(np.concatenate([np.zeros(0, np.int32), *ids]), np.array([len(own) for own in ids], np.int64))]

    def _encode_chunks(self, chunks: Sequence[str]) -> Iterator[np.ndarray]:
        """Ids of each chunk. Many are encoded in one call, parted by a special token."""
        for start in range(0, len(chunks), CHUNKS_PER_CALL):
            call = chunks[start : start + CHUNKS_PER_CALL]
            ids = np.array(self.tokenizer.encode(PARTING.join(call), add_special_tokens=False).ids, dtype=np.int32)
            ends = np.flatnonzero(ids == self.parting_id)
            if len(ends) != len(call) - 1:  # a chunk spells the special token
                yield from (self._ids(chunk) for chunk in call)
                continue
            yield from (ids[a:b] for a, b in zip(np.append(0, ends + 1), np.append(ends, len(ids))))

    def _ids(self, chunk: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, dtype=np.int32)

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many are of each."""
        raw = [text.encode() for text in texts]
        flat, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for first, last in blocks([len(text) for text in raw], TOGETHER):
            data = b"".join(raw[first:last])
            data = data if SPECIAL in data else data.lower().translate(_ONE_SPACE)
            sizes = np.array([len(text) for text in raw[first:last]], np.int64)
            begins = np.cumsum(sizes) - sizes
            starts = chunk_starts(np.frombuffer(data, np.uint8), begins[sizes > 0], SPECIAL in data)
            rows = self.remembered.rows(tiles(data, starts))
            ids, lengths = self.remembered.tables[0].take(rows)
            ends = np.concatenate(([0], np.cumsum(lengths)))
            flat.append(ids)
            counts.append(np.diff(ends[np.searchsorted(starts, np.append(begins, len(data)))]))
        return np.concatenate(flat), np.concatenate(counts)


def encoder(vocabulary: str) -> ChunkEncoder:
    """One encoder per worker and vocabulary."""
    memory = worker_memory()
    if vocabulary not in memory:
        memory[vocabulary] = ChunkEncoder(vocabulary)
    return memory[vocabulary]


def encode_documents(df: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, text) to (doc_id, ids); rows keep their partition and order. Null counts as empty."""

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, counts = encoder(vocabulary).encode([text or "" for text in batch["text"].to_pylist()])
        offsets = np.concatenate(([0], np.cumsum(counts + 1)))
        ids = lists(np.insert(flat, np.cumsum(counts), end_id), offsets, pa.int32())
        return pa.RecordBatch.from_arrays([batch["doc_id"], ids], ["doc_id", "ids"])

    return over_batches(df.select("doc_id", "text"), encode, "doc_id long, ids array<int>")


def write_tokens(df: DataFrame, path: str, vocabulary: str, end_id: int = END_ID) -> None:
    """Encode ``df`` and write it to ``path`` in ascending order of doc_id, over all its files.

    Null ids come first, rows with one id in order of a hash of their text, and repeated rows next to
    each other. An empty table gives a folder without rows. Other columns are not read.
    """
    keys = ["doc_id", F.xxhash64("text")]
    ordered = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(*keys)
    tokens = encode_documents(ordered.sortWithinPartitions(*keys), vocabulary, end_id)
    tokens.write.options(**ORC_OPTIONS).option("maxRecordsPerFile", ROWS_PER_FILE).orc(path)


def read_tokens(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """The stored ids; those of chosen documents are found by min/max, row index and Bloom filter."""
    tokens = spark.read.schema("doc_id long, ids array<int>").orc(path)
    return tokens if doc_ids is None else tokens.where(F.col("doc_id").isin(*doc_ids))


def ids_crc32(ids: Sequence[int]) -> int:
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())


def describe_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document: where its ids start in the whole sequence, their number and checksum.

    Sums run over one file at a time; a file has ``ROWS_PER_FILE`` rows at most.
    """
    at = [F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long"), F.col("_metadata.file_name")]
    rows = read_tokens(spark, path).select(
        "doc_id", "ids", at[0].alias("part"), at[1].alias("file"), F.monotonically_increasing_id().alias("number")
    )

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, offsets = batch["ids"].values.to_numpy(), batch["ids"].offsets.to_numpy()
        sums = [ids_crc32(ids[a:b]) for a, b in zip(offsets, offsets[1:])]
        names = ["doc_id", "part", "file", "number"]
        return pa.RecordBatch.from_arrays(
            [*[batch[name] for name in names], pa.array(np.diff(offsets), pa.int64()), pa.array(sums, pa.int64())],
            [*names, "n_tokens", "ids_crc32"],
        )

    schema = "doc_id long, part long, file string, number long, n_tokens long, ids_crc32 long"
    slim = stored(over_batches(rows, check, schema), "token-counts")
    files = slim.groupBy("part", "file").agg(F.sum("n_tokens").alias("ids_in_file"))
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("file_start", F.coalesce(F.sum("ids_in_file").over(before), F.lit(0)))
    inside = Window.partitionBy("part", "file").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    running = slim.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return running.join(files, ["part", "file"]).select(
        "doc_id", (F.col("file_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def op8_tokens(spark, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    path = scratch_path(spark, "tokens")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path(VOCABULARY))
    return describe_tokens(spark, path)
