"""Words and word shingles of texts as 64-bit hashes, for whole Arrow batches at once."""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash

from meterline.llm.batches import mixed, worker_memory
from meterline.llm.chunks import Remembered, blocks, stretches
from meterline.llm.suffixes import Hashed

WORD = re.compile(r"\w+")
REMEMBERED = 200_000
BASE = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores, in lower case. Null has none."""
    return WORD.findall(text.lower()) if text else []


def hashed(listed: Sequence[Sequence[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts one after the other, and where each text begins (and the last ends)."""
    known = worker_memory().setdefault("word hashes", _Hashes())
    if len(known) > REMEMBERED:
        known.clear()
    offsets = np.concatenate(([0], np.cumsum([len(ws) for ws in listed]))).astype(np.int64)
    flat = np.fromiter(map(known.__getitem__, chain.from_iterable(listed)), dtype=np.uint64, count=int(offsets[-1]))
    return flat, offsets


#: bytes of text whose words are hashed together
TOGETHER = 4 << 20
_APART = np.array([byte < 128 and not WORD.match(chr(byte)) for byte in range(256)])
#: the one letter whose lower case depends on what stands beyond the word
_SIGMA = "Σ".encode()


def _hash_words_of(runs: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the words of runs that hold characters beyond ASCII."""
    listed = [[word.encode() for word in words(run.decode())] for run in runs]
    flat = list(chain.from_iterable(listed))
    lengths = np.fromiter(map(len, flat), np.int64, len(flat))
    hashes = Hashed(np.frombuffer(b"".join(flat), np.uint8)).stretch(np.cumsum(lengths) - lengths, lengths)
    return [(hashes, np.fromiter(map(len, listed), np.int64, len(listed)))]


def hashed_texts(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of whole texts one after the other, and where each text begins (and the last ends).

    The words are those of :func:`words`; their hashes are other ones than those of :func:`hashed`. They come from
    running sums over the bytes of a block of texts, so no list of words is made. Only runs with characters beyond
    ASCII are looked through for words one by one, each distinct one once per worker.
    """
    wide_runs = worker_memory().setdefault("wide runs", Remembered(_hash_words_of, 1, np.uint64))
    raw = [text.encode() if text else b"" for text in texts]
    # the lower case of this letter depends on what stands beyond the word
    raw = [text.decode().lower().encode() if _SIGMA in text else text for text in raw]
    flat, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for first, last in blocks([len(text) for text in raw], TOGETHER):
        data = b"\n".join(raw[first:last]).lower()
        array = np.frombuffer(data, np.uint8)
        edges = np.flatnonzero(np.diff(np.concatenate(([True], _APART[array], [True])).view(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        hashes, lengths = Hashed(array).stretch(starts, ends - starts), np.ones(len(starts), np.int64)
        beyond = np.concatenate(([0], np.cumsum(array >= 128)))
        wide = np.flatnonzero(beyond[ends] > beyond[starts])
        runs = pa.array([data[a:b] for a, b in zip(starts[wide].tolist(), ends[wide].tolist())], pa.binary())
        found, lengths[wide] = wide_runs.tables[0].take(wide_runs.rows(runs)) if len(wide) else (np.zeros(0, np.uint64), 0)
        values, before = np.repeat(hashes, lengths), np.concatenate(([0], np.cumsum(lengths)))
        values[stretches(before[wide], lengths[wide])] = found
        begins = np.cumsum([0, *[len(text) + 1 for text in raw[first:last]]])
        flat.append(values)
        counts.append(np.diff(before[np.searchsorted(starts, begins)]))
    return np.concatenate(flat), np.concatenate(([0], np.cumsum(np.concatenate(counts))))


def grams(flat: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive words, the text each is of, and the word it starts at.

    A text with fewer words, but at least one, has one gram of them all.
    """
    lengths = np.diff(offsets)
    counts = np.where(lengths == 0, 0, np.maximum(lengths - n + 1, 1))
    text = np.repeat(np.arange(len(lengths)), counts)
    begins = np.concatenate(([0], np.cumsum(counts)))
    start = np.arange(begins[-1]) - begins[text] + offsets[text] if len(text) else np.zeros(0, np.int64)
    out = np.zeros(len(text), dtype=np.uint64)
    if len(text):
        last, short = offsets[text + 1], bool((lengths[lengths > 0] < n).any())
        with np.errstate(over="ignore"):
            for k in range(n):
                at = start + k
                word = np.where(at < last, flat[np.minimum(at, len(flat) - 1)], np.uint64(k)) if short else flat[at]
                out = out * BASE + word
    return mixed(out), text, start - offsets[text]
