"""Benchmark decontamination: rare words find candidates, Smith-Waterman alignment scores them.

The benchmark is the query set. It is taken in blocks of ``BLOCK_WORDS`` words, which bounds what is
broadcast; each block is held against all documents in two passes.

1. In how many documents does each word of the items occur? Counts are gathered per batch before they
   are shuffled.
2. A copy that reaches ``LEAKED`` matches at least that share of the item's words, within a span of words
   that the score bounds too. So of any words of the item, all but a known number are matched: of its rarest
   ones, the *seeds*, at least ``Block.least`` stand in the span. Counts choose which words are seeds; they
   drop none, so an item of common words, or one copied into every document, costs more but loses nothing.
3. Where so many seeds stand near each other, the words around them are a candidate, unless too few of
   them are words of the item; overlapping ones are merged. Candidates are dealt out anew and aligned with
   their items. No copy that the alignment accepts is missed, however it was edited.

The score is that of the best local alignment of words over that of a whole, unchanged copy: 1 for a
copy, less 1.5 words for a changed word. A quarter of changed words, spread evenly, still reaches
``LEAKED``. Items are matched from ``LEAST_MATCHED`` common words on. An item that has fewer is matched as a
whole only: a copy holds all its words, one after the other.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.batches import bound_batches, over_batches
from meterline.llm.shingles import hashed_texts
from meterline.sources.scratch import stored

BLOCK_WORDS = 1_000_000
LEAKED = 0.6
LEAST_MATCHED = 8
MATCH, MISMATCH, GAP = 2, -1, -1
BITS = 22
#: one seed more, of which one more has to stand near the others, for so many words of an item
SEEDS_MORE = 8
ROUNDING = 1e-6


def least_words(length: int) -> int:
    """How many words of an item are matched in any copy that reaches ``LEAKED``, if nothing else costs."""
    return max(1, int(np.ceil(LEAKED * length - ROUNDING)))


def longest_span(length: int) -> int:
    """Over how many words such a copy may extend: every word it has beside matches costs one."""
    return int(length + MATCH * length * (1 - LEAKED) + ROUNDING)


def _best_cell(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """Score of the best local alignment, and the last word of it in item and window.

    One row per item word; gaps along the window are a running maximum, so rows are whole arrays.
    """
    slope = -GAP * np.arange(len(window) + 1)
    row = np.zeros(len(window) + 1, dtype=np.int64)
    best = (0, 0, 0)
    for i, word in enumerate(item):
        step = np.maximum(row[:-1] + np.where(window == word, MATCH, MISMATCH), row[1:] + GAP)
        row = np.concatenate(([0], np.maximum(step, 0)))
        row = np.maximum.accumulate(row + slope) - slope
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), i, j - 1)
    return best


def align(item: np.ndarray, window: np.ndarray) -> tuple[float, int, int, int]:
    """Score from 0 to 1, words in common, and the aligned words of the window (end exclusive)."""
    top, i, j = _best_cell(item, window)
    if not top:
        return 0.0, 0, 0, 0
    _, _, back = _best_cell(item[: i + 1][::-1], window[: j + 1][::-1])
    start = j - back
    common = np.isin(window[start : j + 1], item).sum()
    return top / (MATCH * len(item)), int(common), start, j + 1


@dataclass
class Block:
    """Items of one block: their words, and the seeds (word, item), sorted by word."""

    keys: np.ndarray
    item_words: list[np.ndarray]
    word: np.ndarray
    item: np.ndarray

    @classmethod
    def of(cls, rows) -> Block:
        """All words of items are seeds."""
        item_words = [np.frombuffer(row.words, "<u8") for row in rows]
        word = np.concatenate(item_words) if item_words else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(item_words)), [len(ws) for ws in item_words])
        order = np.argsort(word, kind="stable")
        return cls(np.array([row.item for row in rows], np.int64), item_words, word[order], item[order])

    def parts(self) -> tuple:
        """Plain arrays, as workers without this package can read."""
        return self.keys, self.item_words, self.word, self.item

    def distinct(self) -> np.ndarray:
        return np.unique(self.word)

    @staticmethod
    def least(length: int) -> int:
        """How many seeds stand in any copy."""
        return min(least_words(length), 1 + length // SEEDS_MORE)

    def seeded(self, frequency: dict[int, int]) -> Block:
        """Only the rarest words of each item, as many as make sure of ``least`` in any copy."""
        often = np.array([frequency.get(int(w.astype(np.int64)), 0) for w in self.word], dtype=np.int64)
        order = np.lexsort((self.word, often, self.item))
        firsts = np.searchsorted(self.item[order], np.arange(len(self.keys)))
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order)) - firsts[self.item[order]]
        lengths = [len(ws) for ws in self.item_words]
        wanted = np.array([n - least_words(n) + self.least(n) for n in lengths], dtype=np.int64)
        seed = rank < wanted[self.item]
        # a word that an item has several times is one seed of it
        pairs = np.lexsort((self.item[seed], self.word[seed]))
        word, item = self.word[seed][pairs], self.item[seed][pairs]
        new = np.ones(len(word), dtype=bool)
        new[1:] = (word[1:] != word[:-1]) | (item[1:] != item[:-1])
        return Block(self.keys, self.item_words, word[new], item[new])


class Lookup:
    """Which of many hashes are among few: a bit map sorts out most of them."""

    def __init__(self, wanted: np.ndarray):
        self.wanted = wanted
        self.bits = np.zeros(1 << BITS, dtype=bool)
        self.bits[(wanted >> np.uint64(64 - BITS)).astype(np.int64)] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``values`` that are wanted, and where in ``wanted`` they first stand."""
        maybe = np.flatnonzero(self.bits[(values >> np.uint64(64 - BITS)).astype(np.int64)])
        at = np.searchsorted(self.wanted, values[maybe])
        ok = self.wanted[np.minimum(at, len(self.wanted) - 1)] == values[maybe]
        return maybe[ok], at[ok]


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """Items with a number of their own and their word hashes; items without words are of no use."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, offsets = hashed_texts(batch["text"].to_pylist())
        packed = [flat[a:b].astype("<u8").tobytes() for a, b in zip(offsets, offsets[1:])]
        return pa.RecordBatch.from_arrays([batch["item_id"], pa.array(packed, pa.binary())], ["item_id", "words"])

    items = over_batches(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text"), run, "item_id long, words binary"
    )
    numbered = items.where(F.octet_length("words") > 0).withColumn("item", F.monotonically_increasing_id())
    return stored(numbered, "items")


def word_frequencies(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(word, documents) of the wanted words over all documents."""
    held = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        value, offsets = hashed_texts(batch["text"].to_pylist())
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        at, which = Lookup(held.value).find(value)
        pairs = np.unique(text[at] * len(held.value) + which)  # a word once for each text
        found, count = np.unique(pairs % max(1, len(held.value)), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(held.value[found].astype(np.int64)), pa.array(count.astype(np.int64))], ["word", "documents"]
        )

    counted = over_batches(docs.select("text"), run, "word long, documents long")
    return counted.groupBy("word").agg(F.sum("documents").alias("documents"))


def _windows(begins: np.ndarray, ends: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Spans of words of a text of ``size`` words, merged; both ends ascend."""
    spans: list[list[int]] = []
    for a, b in zip(np.maximum(begins, 0).tolist(), np.minimum(ends, size).tolist()):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = b
        else:
            spans.append([a, b])
    return [(a, b) for a, b in spans]


def _holds_enough(window: np.ndarray, item: np.ndarray) -> bool:
    """Whether some span of the window has as many of the item's words as a copy has."""
    total = np.concatenate(([0], np.cumsum(np.isin(window, item))))
    span = min(len(window), longest_span(len(item)))
    return int((total[span:] - total[: len(total) - span]).max()) >= least_words(len(item))


def candidates(docs: DataFrame, block: Block) -> DataFrame:
    """(doc_id, text_key, item number, first word, words) for each place that may be a copy of an item."""
    held = docs.sparkSession.sparkContext.broadcast(block.parts())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        held_block = Block(*held.value)
        flat, offsets = hashed_texts(batch["text"].to_pylist())
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        at, which = Lookup(held_block.word).find(flat)
        times = np.searchsorted(held_block.word, flat[at], side="right") - which
        hit = np.repeat(at, times)
        item = held_block.item[np.repeat(which - (np.cumsum(times) - times), times) + np.arange(times.sum())]
        order = np.lexsort((item, text[hit]))  # stable: words of a text stay in their order
        item, owner, place = item[order], text[hit][order], hit[order] - offsets[text[hit][order]]
        lengths = [len(ws) for ws in held_block.item_words]
        least, span = (np.array([of(n) for n in lengths], np.int64)[item] for of in (Block.least, longest_span))
        last = np.arange(len(item)) + least - 1  # the seed with which there are enough
        inside = np.flatnonzero(last < len(item))
        until = last[inside]
        inside = inside[
            (item[until] == item[inside]) & (owner[until] == owner[inside]) & (place[until] - place[inside] < span[inside])
        ]
        owner, item, begin, end = owner[inside], item[inside], place[last[inside]] - span[inside] + 1, place[inside] + span[inside]
        cuts = np.flatnonzero((np.diff(owner) != 0) | (np.diff(item) != 0)) + 1
        out = []
        for places in np.split(np.arange(len(owner)), cuts) if len(owner) else []:
            row, number = int(owner[places[0]]), int(item[places[0]])
            a0, size = int(offsets[row]), int(offsets[row + 1] - offsets[row])
            for a, b in _windows(begin[places], end[places], size):
                window = flat[a0 + a : a0 + b]
                if _holds_enough(window, held_block.item_words[number]):
                    out.append((row, number, a, window.astype("<u8").tobytes()))
        rows = pa.array([row for row, *_ in out], pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"].take(rows),
                batch["text_key"].take(rows),
                pa.array([number for _, number, *_ in out], pa.int32()),
                pa.array([a for *_, a, _ in out], pa.int32()),
                pa.array([w for *_, w in out], pa.binary()),
            ],
            ["doc_id", "text_key", "number", "first", "words"],
        )

    return over_batches(
        docs.select("doc_id", "text_key", "text"), run, "doc_id long, text_key long, number int, first int, words binary"
    )


def aligned(found: DataFrame, block: Block) -> DataFrame:
    """Candidates that are leaks, with score, common words and the words they span."""
    held = found.sparkSession.sparkContext.broadcast((block.keys, block.item_words))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, item_words = held.value
        keep, out = [], []
        for n, (number, first, packed) in enumerate(
            zip(batch["number"].to_pylist(), batch["first"].to_pylist(), batch["words"].to_pylist())
        ):
            item = item_words[number]
            score, common, a, b = align(item, np.frombuffer(packed, "<u8"))
            if score >= 1 - ROUNDING or score >= LEAKED and common >= LEAST_MATCHED:
                keep.append(n)
                out.append((int(keys[number]), score, common, first + a, first + b))
        kinds = (pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32())
        columns = [pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)]
        rows = pa.array(keep, pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"].take(rows), batch["text_key"].take(rows), *columns],
            ["doc_id", "text_key", "item", "score", "common_words", "first_word", "end_word"],
        )

    schema = "doc_id long, text_key long, item long, score double, common_words int, first_word int, end_word int"
    return over_batches(found, run, schema)


def find_leaks(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents (doc_id, text) that hold a benchmark item (item_id, text), with their best alignment.

    Words are runs of letters, digits and underscores in lower case. Null and empty texts match nothing;
    null ids are kept. Repeated rows and repeated items each count. Of equally good places in a document
    the first is told. Either table may be empty; other columns are not read.

    Returns doc_id, text_key (a hash of the text), item_id, score, common_words, first_word, end_word.
    """
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    items = benchmark_items(benchmark)
    total = items.agg(F.sum(F.octet_length("words") / 8)).first()[0] or 0
    blocks = max(1, -(-int(total) // BLOCK_WORDS))
    leaks = None
    for number in range(blocks):
        block = Block.of(items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).collect())
        if not len(block.word):
            continue
        often = {row.word: row.documents for row in word_frequencies(docs, block.distinct()).collect()}
        block = block.seeded(often)
        found = aligned(candidates(docs, block).repartition(F.xxhash64("doc_id", "number", "first")), block)
        leaks = found if leaks is None else leaks.unionByName(found)
    if leaks is None:
        return df.sparkSession.createDataFrame(
            [], "doc_id long, text_key long, item_id long, score double, common_words int, first_word int, end_word int"
        )
    order = F.struct("score", -F.col("first_word"), "common_words", "end_word")
    best = leaks.groupBy("doc_id", "text_key", "item").agg(F.max(order).alias("best"))
    return best.join(items.select("item", "item_id"), "item").select(
        "doc_id",
        "text_key",
        "item_id",
        "best.score",
        "best.common_words",
        (-F.col("best.col2")).alias("first_word"),
        "best.end_word",
    )


def without_leaks(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``df`` that hold no benchmark item; columns unchanged."""
    leaks = find_leaks(df, benchmark).select(F.col("doc_id").alias("leaked_id"), F.col("text_key").alias("leaked_key"))
    rows = df.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("key"))
    same = F.col("id").eqNullSafe(F.col("leaked_id")) & (F.col("key") == F.col("leaked_key"))
    return rows.join(leaks.distinct(), same, "left_anti").select("row.*")


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find_leaks(documents, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text_key")
