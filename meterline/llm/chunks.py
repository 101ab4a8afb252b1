"""Ids of texts put together from the ids of their distinct chunks, over whole Arrow batches.

Texts recur word by word, so a worker encodes a chunk once and afterwards only gathers its ids.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

#: distinct chunks a worker remembers before it starts anew
REMEMBERED = 400_000


def tiles(data: bytes, starts: np.ndarray) -> pa.BinaryArray:
    """Stretches of ``data``, each from one start to the next, the last one to the end."""
    edges = np.append(starts, len(data)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(data)])


def stretches(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, ``lengths`` of them, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def blocks(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows [first, last) of at most ``most`` bytes together, or of one row."""
    first, total = 0, 0
    for row, size in enumerate(sizes):
        if row > first and total + size > most:
            yield first, row
            first, total = row, 0
        total += size
    if len(sizes) > first:
        yield first, len(sizes)


class Ragged:
    """Lists of integers that grow at their end."""

    def __init__(self, kind: np.dtype):
        self.values, self.edges = np.zeros(1024, kind), np.zeros(1, np.int64)

    def extend(self, values: np.ndarray, lengths: np.ndarray) -> None:
        end = int(self.edges[-1])
        if end + len(values) > len(self.values):
            larger = np.zeros(2 * (end + len(values)), self.values.dtype)
            larger[:end] = self.values[:end]
            self.values = larger
        self.values[end : end + len(values)] = values
        self.edges = np.concatenate((self.edges, end + np.cumsum(lengths)))

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of ``rows`` one after the other, and their lengths."""
        lengths = self.edges[rows + 1] - self.edges[rows]
        return self.values[stretches(self.edges[rows], lengths)], lengths


class Remembered:
    """For chunks, rows of tables that ``encode`` has filled: it gets new chunks and returns, for each table,
    all their values and how many are of each chunk."""

    def __init__(
        self,
        encode: Callable[[list[bytes]], Sequence[tuple[np.ndarray, np.ndarray]]],
        tables: int,
        kind=np.int32,
        most: int | None = None,
    ):
        self.encode, self.count, self.kind, self.most = encode, tables, kind, most
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.tables = [Ragged(self.kind) for _ in range(self.count)]

    def rows(self, chunks: pa.BinaryArray) -> np.ndarray:
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) > (self.most or REMEMBERED):
            self.forget()
        fresh = [chunk for chunk in distinct if chunk not in self.known]
        if fresh:
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
            for table, (values, lengths) in zip(self.tables, self.encode(fresh)):
                table.extend(values, lengths)
        places = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        return places[coded.indices.to_numpy()]
