"""Removal of repeated byte strings by blockwise suffix comparison over a cover sample.

Two suffixes agree in their first ``LENGTH`` bytes or they do not; that is all the order needs to tell.
Comparing every suffix would make a row of every byte, so a *cover sample* is ranked first: a position is
in the sample if its ``GRAM`` bytes hash lowest within some string of ``LENGTH`` bytes. As in a difference
cover, any two equal strings have a sample position at the same distance from their starts; as it is
chosen by content, one position per string is enough, about one in 137 bytes.

1. Sample positions get their rank, the hash of their gram. The strings that owe themselves to one sample
   position start next to each other; together they span its *context*.
2. A suffix bucket is a rank. In most buckets there is one context, once: nothing repeats. A context
   found twice or more is repeated as a whole, and settles all of its strings (the long ties) by rank.
3. Only buckets with different contexts are looked into, each distinct context once, whatever number of
   copies it has. Strings are compared ``SLOT`` at a time, and one by one where that does not tell.
4. Covered bytes are cut out of each text.

Each bucket is merged by Spark's aggregation, partly before the shuffle, so a passage in a third of all
texts takes no more memory than another. Strings are compared by 64-bit hashes inside a bucket, which
is itself one of 2 ** 64. Texts are moved compressed. Long texts are taken in overlapping pieces.
"""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.batches import bound_batches, mixed, over_batches, worker_memory
from meterline.sources.scratch import stored

LENGTH = 400
GRAM = 128
SLOT = 16
PIECE = 1 << 22
TOGETHER = 1 << 19
BASE = 0xD6E8FEB86659FD93
HIGH, LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)


#: a random number for each byte
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) << np.uint64(17))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    memory = worker_memory()
    if len(memory.get("suffix powers", ((),))[0]) < n:
        size = max(n, TOGETHER + PIECE // 8)
        inverse = pow(BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            memory["suffix powers"] = tuple(
                np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, base, np.uint64))))
                for base in (BASE, inverse)
            )
    return memory["suffix powers"]


class Hashed:
    """Hashes of any stretch of a byte string, from running sums."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(BYTE_VALUES[data] * power[: len(data)], out=self.sums[1:])

    def stretch(self, start, length) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.sums[start + length] - self.sums[start]) * self.inverse[start])

    def grams(self, length: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            sums = self.sums[length:] - self.sums[:-length]
            return mixed(sums * self.inverse[: len(sums)])


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def sample(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, ...]:
    """Contexts of texts that follow each other in ``data``; ``begins`` has their starts and the end.

    Returns for each context the first string's start, the number of strings, how far the sample position
    lies behind that start, rank, and hash.
    """
    none = (*[np.zeros(0, np.int64)] * 3, *[np.zeros(0, np.uint64)] * 2)
    if len(data) < LENGTH:
        return none
    hashes = Hashed(data)
    gram = hashes.grams(GRAM)
    key = (gram & HIGH) | np.arange(len(gram), dtype=np.uint64)
    at = (lowest(key, LENGTH - GRAM + 1) & LOW).astype(np.int64)
    inside = np.zeros(len(at) + 1, dtype=np.int32)
    lengths = np.diff(begins)
    full = lengths >= LENGTH
    np.add.at(inside, begins[:-1][full], 1)
    np.add.at(inside, begins[1:][full] - LENGTH + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (at[1:] != at[:-1])
    start = np.flatnonzero(new)
    if not len(start):
        return none
    last = inside.copy()
    last[:-1] &= ~inside[1:] | (at[1:] != at[:-1])
    strings = np.flatnonzero(last) - start + 1
    shape = (strings * LENGTH + at[start] - start).astype(np.uint64)
    context = mixed(hashes.stretch(start, strings + LENGTH - 1) ^ mixed(shape))
    return start, strings, at[start] - start, gram[at[start]], context


def pieces(texts: list[bytes]):
    """Groups of (text number, offset, bytes) of bounded size; pieces of one text overlap."""
    group, size = [], 0
    for number, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - LENGTH + 1), PIECE):
            part = text[offset : offset + PIECE + LENGTH - 1]
            if group and size + len(part) > TOGETHER:
                yield group
                group, size = [], 0
            group.append((number, offset, part))
            size += len(part)
    if group:
        yield group


def _laid_out(group) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(part for _, _, part in group), dtype=np.uint8)
    return data, np.concatenate(([0], np.cumsum([len(part) for _, _, part in group]))).astype(np.int64)


def contexts(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, text) to the contexts of each text: start, strings, behind, rank, context."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [text or b"" for text in batch["text"].cast(pa.binary()).to_pylist()]
        found = [[np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 2]
        for group in pieces(texts):
            data, begins = _laid_out(group)
            start, strings, behind, rank, context = sample(data, begins)
            piece = np.searchsorted(begins, start, side="right") - 1
            number = np.array([n for n, _, _ in group], dtype=np.int64)[piece]
            offset = np.array([o for _, o, _ in group], dtype=np.int64)[piece] - begins[piece]
            found.append([number, start + offset, strings, behind, rank, context])
        number, start, strings, behind, rank, context = (np.concatenate(column) for column in zip(*found))
        rows = pa.array(number)
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"].take(rows),
                batch["text_key"].take(rows),
                pa.array(start.astype(np.int32)),
                pa.array(strings.astype(np.int32)),
                pa.array(behind.astype(np.int32)),
                pa.array(rank.astype(np.int64)),
                pa.array(context.astype(np.int64)),
            ],
            ["doc_id", "text_key", "start", "strings", "behind", "rank", "context"],
        )

    schema = "doc_id long, text_key long, start int, strings int, behind int, rank long, context long"
    return over_batches(docs, run, schema)


def packed(docs: DataFrame) -> DataFrame:
    """The text compressed, for joins that move it."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pack = zstandard.ZstdCompressor(level=6).compress
        data = [pack(text or b"") for text in batch["text"].cast(pa.binary()).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["text_key"], pa.array(data, pa.binary())], ["doc_id", "text_key", "packed"]
        )

    return over_batches(docs, run, "doc_id long, text_key long, packed binary")


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _same_text(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["other_id"]) & (left["text_key"] == right["other_key"])


def _by_text(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows of a text gathered. Rows equal in id and text are one text here, so callers pass each place once."""
    return rows.groupBy(F.col("doc_id").alias("other_id"), F.col("text_key").alias("other_key")).agg(
        *[F.collect_list(column).alias(column) for column in columns]
    )


def _cut_out(texts: DataFrame) -> DataFrame:
    """The bytes of the listed contexts, one row each."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        listed = [batch[name].to_pylist() for name in ("start", "strings", "behind", "rank", "times")]
        rows, out = [], []
        for row, (data, *lists) in enumerate(zip(batch["packed"].to_pylist(), *listed)):
            text = _unpack(data)
            for start, strings, *rest in zip(*lists):
                rows.append(row)
                out.append((start, strings, *rest, text[start : start + strings + LENGTH - 1]))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
        columns = [pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)]
        of_text = [batch[name].take(pa.array(rows, pa.int64())) for name in ("doc_id", "text_key")]
        names = ["doc_id", "text_key", "start", "strings", "behind", "rank", "times", "bytes"]
        return pa.RecordBatch.from_arrays([*of_text, *columns], names)

    schema = "doc_id long, text_key long, start int, strings int, behind int, rank long, times int, bytes binary"
    return over_batches(texts, run, schema)


def _slots(cut_out: DataFrame) -> DataFrame:
    """``SLOT`` neighbouring strings of a context at a time, counted from the sample position.

    What all of them share is their core, what they span together their hull, if the context has them all. If
    the hull is repeated, so are all of them; if not even the core is, none is.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [[np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, bool)]]
        columns = [batch[name].to_pylist() for name in ("bytes", "strings", "behind")]
        for row, (data, strings, behind) in enumerate(zip(*columns)):
            hashes = Hashed(np.frombuffer(data, dtype=np.uint8))
            slot = np.arange((behind - strings + 1) // SLOT, behind // SLOT + 1)
            core = hashes.stretch(behind - SLOT * slot, LENGTH - SLOT + 1)
            full = (SLOT * slot > behind - strings) & (SLOT * slot + SLOT - 1 <= behind)
            first = np.where(full, behind - SLOT * slot - SLOT + 1, 0)
            hull = hashes.stretch(first, np.where(full, LENGTH + SLOT - 1, 0))
            shape = mixed((slot + 1).astype(np.uint64))
            found.append([np.full(len(slot), row), slot, mixed(core ^ shape), mixed(hull ^ shape), full])
        row, slot, core, hull, full = (np.concatenate(column) for column in zip(*found))
        rows = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [
                *[batch[name].take(rows) for name in ("number", "rank", "times")],
                pa.array(slot.astype(np.int32)),
                pa.array(core.astype(np.int64)),
                pa.array(hull.astype(np.int64), mask=~full),
            ],
            ["number", "rank", "times", "slot", "core", "hull"],
        )

    return over_batches(cut_out, run, "number long, rank long, times int, slot int, core long, hull long")


def _strings(cut_out: DataFrame) -> DataFrame:
    """Every string of the listed slots of each context: its place there, hash, and how often it counts."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [[np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]]
        columns = [batch[name].to_pylist() for name in ("bytes", "strings", "behind", "slot", "counted")]
        for row, (data, strings, behind, slots, counted) in enumerate(zip(*columns)):
            hashes = Hashed(np.frombuffer(data, dtype=np.uint8))
            place = (behind - SLOT * np.array(slots)[:, None] - np.arange(SLOT)).reshape(-1)
            times = np.repeat(counted, SLOT)
            there = (place >= 0) & (place < strings)
            place, times = place[there], times[there]
            found.append([np.full(len(place), row), place, times, hashes.stretch(place, LENGTH)])
        row, place, times, string = (np.concatenate(column) for column in zip(*found))
        rows = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [
                *[batch[name].take(rows) for name in ("number", "rank")],
                pa.array(place.astype(np.int32)),
                pa.array(times.astype(np.int32)),
                pa.array(string.astype(np.int64)),
            ],
            ["number", "rank", "place", "counted", "string"],
        )

    return over_batches(cut_out, run, "number long, rank long, place int, counted int, string long")


def _telling(docs: DataFrame) -> DataFrame:
    """Contexts of buckets with more than one occurrence: how often each occurs (2 stands for more), and
    whether its bucket has other contexts."""
    found = stored(contexts(docs), "contexts")
    kinds = found.groupBy("rank", "context").agg(F.count(F.lit(1)).alias("times"))
    buckets = kinds.groupBy("rank").agg(F.count(F.lit(1)).alias("kinds"), F.sum("times").alias("total"))
    telling = kinds.join(buckets.where("total > 1"), "rank").select(
        "rank", "context", F.least("times", F.lit(2)).cast("int").alias("times"), (F.col("kinds") > 1).alias("mixed")
    )
    return stored(found.join(telling, ["rank", "context"]), "telling-contexts")


def _mixed_contexts(docs: DataFrame, telling: DataFrame) -> DataFrame:
    """Bytes of the contexts that meet others in their bucket, each distinct one once."""
    several = telling.where("mixed")
    once = several.where("times = 1").unionByName(several.where("times > 1").dropDuplicates(["rank", "context"]))
    lists = _by_text(once, "start", "strings", "behind", "rank", "times")
    texts = packed(docs)
    cut_out = _cut_out(texts.join(lists, _same_text(texts, lists)).drop("other_id", "other_key"))
    return stored(cut_out.withColumn("number", F.monotonically_increasing_id()), "mixed-contexts")


def _judged_slots(cut_out: DataFrame) -> DataFrame:
    """Slots with a repeated core: whether the hull is repeated too, and which slot speaks for its hull."""
    slots = stored(_slots(cut_out.select("number", "rank", "times", "bytes", "strings", "behind")), "slots")
    cores = slots.groupBy("rank", "core").agg(F.sum("times").alias("often")).where("often > 1")
    hulls = slots.where("hull IS NOT NULL").groupBy("rank", "hull").agg(
        F.sum("times").alias("hull_often"), F.min("number").alias("speaker")
    )
    judged = slots.join(cores, ["rank", "core"]).join(hulls.where("hull_often > 1"), ["rank", "hull"], "left")
    return stored(
        judged.select(
            "number",
            "slot",
            "rank",
            "core",
            "times",
            F.col("speaker").isNotNull().alias("whole"),
            F.coalesce(F.col("speaker") == F.col("number"), F.lit(False)).alias("speaks"),
        ),
        "judged-slots",
    )


def _single_strings(cut_out: DataFrame, judged: DataFrame) -> DataFrame:
    """(number, place) of repeated strings in slots that are not repeated as a whole.

    Such a string may also lie in slots that are; one of these speaks for all with the same hull.
    """
    torn = judged.where("NOT whole")
    speakers = judged.where("speaks").join(torn.select("rank", "core").distinct(), ["rank", "core"], "left_semi")
    wanted = torn.select("number", "slot", F.col("times").alias("counted")).unionByName(
        speakers.select("number", "slot", F.lit(2).alias("counted"))
    )
    lists = wanted.groupBy("number").agg(F.collect_list("slot").alias("slot"), F.collect_list("counted").alias("counted"))
    strings = stored(_strings(cut_out.join(lists, "number")), "strings")
    again = strings.groupBy("rank", "string").agg(F.sum("counted").alias("often")).where("often > 1")
    single = strings.where("counted = 1").join(again, ["rank", "string"], "left_semi")
    return stored(single.select("number", "place"), "repeated-strings")


def _release(docs: DataFrame) -> None:
    """Let Spark remove the shuffle files of finished phases.

    It does so once nothing refers to them, which it learns when the driver's memory is next collected.
    """
    gc.collect()
    docs.sparkSession.sparkContext._jvm.System.gc()


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, end) that together cover the repeated bytes; spans may overlap.

    Each phase ends in a table; what it shuffled is then no longer needed.
    """
    telling = _telling(docs)
    _release(docs)
    cut_out = _mixed_contexts(docs, telling)
    _release(docs)
    judged = _judged_slots(cut_out)
    _release(docs)
    single = _single_strings(cut_out, judged)
    _release(docs)
    last = F.col("start") + F.col("strings") + LENGTH - 1
    spans = telling.where("times > 1").select("doc_id", "text_key", "start", last.alias("end"))
    places = cut_out.where("times = 1").select("number", "doc_id", "text_key", "start", "behind")
    first = F.col("start") + F.col("behind") - SLOT * F.col("slot") - (SLOT - 1)
    of_slots = judged.where("whole").join(places, "number").select(
        "doc_id", "text_key", first.alias("start"), (first + LENGTH + SLOT - 1).alias("end")
    )
    begin = F.col("start") + F.col("place")
    of_strings = single.join(places, "number").select(
        "doc_id", "text_key", begin.alias("start"), (begin + LENGTH).alias("end")
    )
    return spans.unionByName(of_slots).unionByName(of_strings)


def merged(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans."""
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, ends)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def cut(df: DataFrame) -> DataFrame:
    """(doc_id, text) to doc_id, n_bytes, n_removed, n_spans and kept, the bytes left.

    A byte goes if it lies in ``LENGTH`` bytes that also start elsewhere, in another text or the same one.
    Null counts as empty. Repeated rows are texts like others, so each repeats the other; null ids are
    kept. An empty table gives no rows; other columns are not read. What is left need not be UTF-8.
    """
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    # repeated rows have the same spans: a set holds each once, no more than the text has bytes
    lists = repeated_spans(docs).groupBy(F.col("doc_id").alias("other_id"), F.col("text_key").alias("other_key"))
    lists = lists.agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    texts = packed(docs)
    both = texts.join(lists, _same_text(texts, lists), "left").select("doc_id", "packed", "spans.start", "spans.end")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for data, starts, ends in zip(*(batch[name].to_pylist() for name in ("packed", "start", "end"))):
            text = _unpack(data)
            runs = merged(starts or [], ends or [])
            edges = [0, *[edge for span in runs for edge in span], len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out.append((len(text), len(text) - len(kept), len(runs), kept))
        columns = [pa.array([row[k] for row in out], kind) for k, kind in enumerate((pa.int64(),) * 3 + (pa.binary(),))]
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        )

    return over_batches(both, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op10_suffixes(spark, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    kept = cut(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
