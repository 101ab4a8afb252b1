"""Alignment of the tokens of two tokenizers by the byte offsets where tokens of both end.

1. Each text is encoded by both. Neither lets a token span the start of a word (a space between two
   characters that are no white space), so the ids of a text are those of its words, one after the other,
   and a worker encodes each distinct word once.
2. Divide and conquer at shared cuts, for all texts of a block in step: every interval of tokens looks for
   a common end near its middle, by bisecting the other side's ends for those of its middle tokens, and
   farther outward where these are none. It is cut there, and both halves go on. An interval without
   a common end inside is a leaf, a group.
3. The two tokens that end with a group are linked. Links are counted over the corpus by their pair of ids.
   Of two tokens that end together one is the end of the other, so the vocabularies alone bound
   the number of pairs (:func:`pair_bound`), and their table of counts may be broadcast.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.batches import bound_batches, lists, over_batches, worker_memory
from meterline.llm.chunks import Remembered, blocks, stretches, tiles
from meterline.sources.scratch import stored

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
#: bytes of text that are aligned in step
TOGETHER = 1 << 20
#: pairs of ids are numbered ``a * PAIR_BASE + b``
PAIR_BASE = 1 << 15


def _byte_of_character() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: itself if printable, else the next free one."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + n): b for n, b in enumerate(rest)}}


class ByteLevel:
    """Ids and token bytes of a byte-level vocabulary. Strings of special tokens are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte = _byte_of_character()
        special = self.tokenizer.get_added_tokens_decoder()
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for token, number in self.tokenizer.get_vocab().items():
            self.bytes[number] = token.encode() if number in special else bytes(byte[c] for c in token)

    def encode(self, words: Sequence[bytes]) -> list[list[int]]:
        found = self.tokenizer.encode_batch([word.decode() for word in words], add_special_tokens=False)
        return [one.ids for one in found]


class Pieces:
    """Ids and token bytes of a sentence-piece vocabulary, which puts the space before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = range(self.model.get_piece_size())
        names = self.model.id_to_piece(list(size))
        self.bytes = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(n) else name.replace("▁", " ").encode()
            for n, name in zip(size, names)
        ]

    def encode(self, words: Sequence[bytes]) -> list[list[int]]:
        return self.model.encode([word[1:].decode() for word in words], num_threads=1)


@dataclass(frozen=True)
class Pair:
    """Two vocabulary files."""

    a: str = public_tokenizers.path(VOCABULARY_A)
    b: str = public_tokenizers.path(VOCABULARY_B)


class PairEncoder:
    """Ids of words by both tokenizers, and whether the second gives back the word's bytes."""

    def __init__(self, pair: Pair):
        self.a, self.b = ByteLevel(pair.a), Pieces(pair.b)
        if len(self.b.bytes) > PAIR_BASE:
            raise ValueError(f"the second vocabulary has more than {PAIR_BASE} ids")
        self.lengths = [np.array([len(token) for token in x.bytes], np.int64) for x in (self.a, self.b)]
        self.remembered = Remembered(self._encode, 3)

    def _encode(self, words: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        out, same = [], np.ones(len(words), np.int32)
        for side in (self.a, self.b):
            ids = side.encode(words)
            for n, (word, own) in enumerate(zip(words, ids)):
                if b"".join([side.bytes[i] for i in own]) != word:
                    same[n] = 0
            lengths = np.array([len(own) for own in ids], np.int64)
            out.append((np.array([i for own in ids for i in own], np.int32), lengths))
        return [*out, (same, np.ones(len(words), np.int64))]


def _pair_encoder(pair: Pair) -> PairEncoder:
    memory = worker_memory()
    if pair not in memory:
        memory[pair] = PairEncoder(pair)
    return memory[pair]


def pair_bound(pair: Pair) -> int:
    """The most pairs of ids that can be linked: a token and another that is its end, or the same bytes."""
    sides = [ByteLevel(pair.a).bytes, Pieces(pair.b).bytes]
    total = 0
    for one, other in (sides, sides[::-1]):
        ids_of: dict[bytes, int] = {}
        for token in other:
            ids_of[token] = ids_of.get(token, 0) + 1
        total += sum(ids_of.get(token[k:], 0) for token in one for k in range(len(token)))
    return total


#: last bytes of white space beyond ASCII: U+0085, U+00A0; U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000
_WIDE_SPACES = [b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80\xa8", b"\xe2\x80\xa9", b"\xe2\x80\xaf", b"\xe2\x81\x9f", b"\xe3\x80\x80"]
_WIDE_SPACES += [b"\xe2\x80" + bytes([0x80 + k]) for k in range(11)]


def word_starts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where words start in texts that follow each other: at each text's own start, and at spaces between
    two characters that are no white space."""
    white = np.zeros(256, bool)
    white[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
    spaces = np.flatnonzero(data == 32)
    spaces = spaces[(spaces > 0) & (spaces < len(data) - 1)]
    spaces = spaces[~white[data[spaces - 1]] & ~white[data[spaces + 1]]]
    beside = spaces[(data[spaces - 1] >= 0x80) | (data[spaces + 1] >= 0xC2)]
    if len(beside):
        padded = np.concatenate((np.zeros(3, np.uint8), data, np.zeros(3, np.uint8)))
        near = np.zeros(len(beside), bool)
        for wide in _WIDE_SPACES:
            for offset in (3 - len(wide), 4):  # ends before the space, or starts behind it
                hit = np.ones(len(beside), bool)
                for k, byte in enumerate(wide):
                    hit &= padded[beside + offset + k] == byte
                near |= hit
        spaces = np.setdiff1d(spaces, beside[near], assume_unique=True)
    return np.union1d(spaces, begins[:-1])


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, a_edges: np.ndarray, b_edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the last tokens of all groups, on either side, in order.

    ``a_ends`` and ``b_ends`` are the ascending byte offsets where tokens end, of texts one after the other;
    text n has the tokens from ``edges[n]`` to ``edges[n + 1]``, and both sides end with it.
    """
    cut_a, cut_b = np.zeros(len(a_ends), bool), np.zeros(len(b_ends), bool)
    some = a_edges[1:] > a_edges[:-1]
    a0, a1, b0, b1 = a_edges[:-1][some], a_edges[1:][some], b_edges[:-1][some], b_edges[1:][some]
    cut_a[a1 - 1], cut_b[b1 - 1] = True, True
    while True:
        # a token that is alone on its side has no end inside
        open_ = (a1 - a0 > 1) & (b1 - b0 > 1)
        a0, a1, b0, b1 = a0[open_], a1[open_], b0[open_], b1[open_]
        if not len(a0):
            return np.flatnonzero(cut_a), np.flatnonzero(cut_b)
        at_a, at_b = _near_middle(a_ends, b_ends, a0, a1)
        found = at_a >= 0
        a0, a1, b0, b1, at_a, at_b = (x[found] for x in (a0, a1, b0, b1, at_a, at_b))
        cut_a[at_a], cut_b[at_b] = True, True
        a0, a1 = np.concatenate((a0, at_a + 1)), np.concatenate((at_a + 1, a1))
        b0, b1 = np.concatenate((b0, at_b + 1)), np.concatenate((at_b + 1, b1))


def _near_middle(a_ends: np.ndarray, b_ends: np.ndarray, a0: np.ndarray, a1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each interval of tokens the common end that is nearest its middle, as numbers of both tokens; -1 for none.

    The middle token's end is bisected for first, then those of twice as many around it, and so on.
    """
    at_a, at_b = np.full(len(a0), -1), np.full(len(a0), -1)
    last = a1 - 2  # the end of the interval's last token is no cut inside
    middle = (a0 + last) // 2
    left, near, width = np.arange(len(a0)), 0, 1
    while len(left):
        # offsets near, ..., near + width - 1 to both sides, as far as the interval goes
        low, high = a0[left], last[left]
        before = np.maximum(0, np.minimum(width, middle[left] - near - low + 1)) if near else np.zeros(len(left), np.int64)
        behind = np.maximum(0, np.minimum(width, high - middle[left] - near + 1))
        tried = np.concatenate((stretches(middle[left] - near - before + 1, before), stretches(middle[left] + near, behind)))
        of = np.concatenate((np.repeat(np.arange(len(left)), before), np.repeat(np.arange(len(left)), behind)))
        place = np.searchsorted(b_ends, a_ends[tried])
        hit = np.flatnonzero(b_ends[np.minimum(place, len(b_ends) - 1)] == a_ends[tried])
        # the nearest one is written last
        hit = hit[np.argsort(-np.abs(tried[hit] - middle[left[of[hit]]]), kind="stable")]
        at_a[left[of[hit]]], at_b[left[of[hit]]] = tried[hit], place[hit]
        near, width = near + width, 2 * width
        inside = (middle[left] - near >= low) | (middle[left] + near <= high)
        left = left[(at_a[left] < 0) & inside]
    return at_a, at_b


def _aligned(texts: Sequence[str | None], encoder: PairEncoder) -> tuple[np.ndarray, ...]:
    """Ids, numbers of tokens per text and groups' last tokens of both sides, for texts taken in step."""
    spaced = [b" " + text.encode() if text else b"" for text in texts]
    data = b"".join(spaced)
    begins = np.concatenate(([0], np.cumsum([len(text) for text in spaced]))).astype(np.int64)
    starts = word_starts(np.frombuffer(data, np.uint8), begins[np.append(np.diff(begins) > 0, True)])
    starts = starts[starts < len(data)]
    rows = encoder.remembered.rows(tiles(data, starts))
    of_text = np.searchsorted(begins, starts, side="right") - 1
    same, _ = encoder.remembered.tables[2].take(rows)
    good = np.ones(len(texts), bool)
    good[of_text[same == 0]] = False
    rows, of_text = rows[good[of_text]], of_text[good[of_text]]
    sides = []
    for table, lengths in zip(encoder.remembered.tables, encoder.lengths):
        ids, counts = table.take(rows)
        per_text = np.bincount(of_text, counts, len(texts)).astype(np.int64)
        sides.append((ids, np.cumsum(lengths[ids]), np.concatenate(([0], np.cumsum(per_text)))))
    (a, a_ends, a_edges), (b, b_ends, b_edges) = sides
    return a, b, a_edges, b_edges, *shared_cuts(a_ends, b_ends, a_edges, b_edges)


def align(df: DataFrame, pair: Pair = Pair()) -> DataFrame:
    """(doc_id, text) to doc_id, a_ids, b_ids, and a_ends and b_ends: behind how many tokens each group ends.

    Texts that are null, empty, or that the second tokenizer does not give back byte by byte have empty lists.
    A row is aligned by itself, so repeated rows and null ids are kept as they are, and an empty table
    gives no rows; other columns are not read. Texts are encoded and aligned whole, of any length.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder, texts, found = _pair_encoder(pair), batch["text"].to_pylist(), []
        for first, last in blocks([4 * len(text or "") for text in texts], TOGETHER):
            a, b, a_edges, b_edges, a_cuts, b_cuts = _aligned(texts[first:last], encoder)
            groups = np.searchsorted(a_cuts, a_edges)
            of = np.repeat(np.arange(last - first), np.diff(groups))
            found.append((a, b, a_cuts + 1 - a_edges[of], b_cuts + 1 - b_edges[of], np.diff(a_edges), np.diff(b_edges), np.diff(groups)))
        a, b, a_cuts, b_cuts, n_a, n_b, n_groups = (np.concatenate(column) for column in zip(*found))
        edges = [np.concatenate(([0], np.cumsum(n))) for n in (n_a, n_b, n_groups)]
        kind = pa.int32()
        columns = [lists(a, edges[0], kind), lists(b, edges[1], kind), lists(a_cuts, edges[2], kind), lists(b_cuts, edges[2], kind)]
        return pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"])

    ids = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return over_batches(ids, run, "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>")


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values one after the other, and where those of each row begin."""
    edges = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy()[edges[0] : edges[-1]], edges - edges[0]


class Written:
    """Groups as text: ids in decimal, ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self):
        self.size_a, self.size_b = 0, 0

    def table(self, a: np.ndarray, b: np.ndarray) -> pa.StringArray:
        size_a, size_b = int(a.max(initial=-1)) + 1, int(b.max(initial=-1)) + 1
        if size_a > self.size_a or size_b > self.size_b:
            self.size_a, self.size_b = max(size_a, self.size_a), max(size_b, self.size_b)
            out = [f"{n}{mark}" for n in range(self.size_a) for mark in ",|"]
            self.strings = pa.array(out + [f"{n}{mark}" for n in range(self.size_b) for mark in ",;"])
        return self.strings

    def write(self, a, b, a_last, b_last, a_edges, b_edges) -> tuple[memoryview, np.ndarray]:
        """The text of all rows one after the other, a ``;`` behind each group, and where each row begins."""
        table = self.table(a, b)
        order = np.zeros(len(a) + len(b), np.int32)
        a_sizes, b_sizes = (np.diff(np.concatenate(([-1], last))) for last in (a_last, b_last))
        ends_a, ends_b = np.zeros(len(a), np.int32), np.zeros(len(b), np.int32)
        ends_a[a_last], ends_b[b_last] = 1, 1
        order[np.arange(len(a)) + np.repeat(b_last + 1 - b_sizes, a_sizes)] = 2 * a + ends_a
        order[np.arange(len(b)) + np.repeat(a_last + 1, b_sizes)] = 2 * (self.size_a + b) + ends_b
        text = table.take(pa.array(order))
        _, offsets, data = text.buffers()
        places = np.frombuffer(offsets, np.int32)[: len(text) + 1]
        return memoryview(data) if data is not None else memoryview(b""), places[a_edges + b_edges]


def _global_ends(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Ids, row edges and numbers of last tokens, counted over the whole batch; and the rows' first groups."""
    (a, a_edges), (b, b_edges) = _flat(batch["a_ids"]), _flat(batch["b_ids"])
    (a_ends, groups), (b_ends, _) = _flat(batch["a_ends"]), _flat(batch["b_ends"])
    of = np.repeat(np.arange(batch.num_rows), np.diff(groups))
    return a, b, a_edges, b_edges, a_ends + a_edges[of] - 1, b_ends + b_edges[of] - 1, groups, of


def digests(aligned: DataFrame) -> DataFrame:
    """What :func:`align` gives to counts, a digest of the groups, and the distinct linked pairs with their number."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        memory = worker_memory()
        writer = memory.setdefault("written groups", Written())
        a, b, a_edges, b_edges, a_last, b_last, groups, of = _global_ends(batch)
        data, places = writer.write(a, b, a_last, b_last, a_edges, b_edges)
        sums = [hashlib.sha256(data[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(places, places[1:])]
        pairs = a[a_last].astype(np.int64) * PAIR_BASE + b[b_last]
        rows_and_pairs, times = np.unique((of.astype(np.int64) << 32) | pairs, return_counts=True)
        edges = np.searchsorted(rows_and_pairs, np.arange(batch.num_rows + 1, dtype=np.int64) << 32)
        n_groups = pa.array(np.diff(groups))
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                pa.array(np.diff(a_edges)),
                pa.array(np.diff(b_edges)),
                n_groups,
                n_groups,  # one link for each common end
                pa.array(sums),
                lists((rows_and_pairs & 0xFFFFFFFF).astype(np.int32), edges, pa.int32()),
                lists(times.astype(np.int32), edges, pa.int32()),
            ],
            ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
        )

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<int>"
    return over_batches(aligned, run, schema)


def link_counts(linked: DataFrame) -> DataFrame:
    """(pairs, times) to pair and count: how many links of the corpus hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            (pair, _), (times, _) = _flat(batch["pairs"]), _flat(batch["times"])
            pairs, where = np.unique(np.concatenate((pairs, pair)), return_inverse=True)
            counts = np.bincount(where, np.concatenate((counts, times)), len(pairs)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "links"])

    found = linked.select("pairs", "times").mapInArrow(run, "pair long, links long")
    return found.groupBy("pair").agg(F.sum("links").alias("links"))


def with_link_counts(linked: DataFrame, counts: DataFrame) -> DataFrame:
    """Add n_best (links whose count is the highest that their second id has) and count_sum."""
    table = counts.orderBy("pair").toArrow()  # no more rows than pair_bound
    pairs, links = table["pair"].to_numpy(), table["links"].to_numpy()
    highest = np.zeros(PAIR_BASE, np.int64)
    np.maximum.at(highest, pairs % PAIR_BASE, links)
    held = linked.sparkSession.sparkContext.broadcast((pairs, links, links == highest[pairs % PAIR_BASE]))
    kept = [name for name in linked.columns if name not in ("pairs", "times")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known, links, best = held.value
        (pair, edges), (times, _) = _flat(batch["pairs"]), _flat(batch["times"])
        place = np.searchsorted(known, pair)
        sums = [np.concatenate(([0], np.cumsum(times * x))) for x in ((best[place], links[place]) if len(pair) else (times, times))]
        n_best, count_sum = (pa.array(x[edges[1:]] - x[edges[:-1]]) for x in sums)
        return pa.RecordBatch.from_arrays([*[batch[name] for name in kept], n_best, count_sum], [*kept, "n_best", "count_sum"])

    fields = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in linked.select(*kept).schema)
    return over_batches(linked, run, f"{fields}, n_best long, count_sum long")


def op11_token_alignment(spark, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    linked = stored(digests(align(spark.read.parquet(f"{sf_dir}/documents.parquet"))), "linked")
    return with_link_counts(linked, link_counts(linked))
