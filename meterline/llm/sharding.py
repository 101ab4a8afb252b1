"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

1. The rows are written once; from then on a file is a partition and a row number names a row, so any
   later task sees the same input however often it is run.
2. The matrix says how many rows of each partition go to each shard. Its rows are drawn one after
   the other, without replacement, from what the shards still have room for (a multivariate
   hypergeometric law), so both the partition sizes and the shard sizes hold exactly.
3. *Permute locally*: a permutation of the partition's row numbers decides which of its rows make up
   those counts.
4. *Exchange*: rows go to (shard, block of slots). Where a row arrives in its shard follows from the
   matrix, without another count.
5. *Permute again*: a keyed bijection of the shard's arrival numbers gives the slot.

The driver sees one number per file. A task holds one permutation of at most ``file_rows`` numbers.
"""

from __future__ import annotations

from math import sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.batches import mixed
from meterline.sources.scratch import scratch_path

SHARDS = 24
SEED = 20240607
FILE_ROWS = 1_000_000
BLOCK_ROWS = 250_000
#: numpy draws exactly below this population; above it the law is tabulated around its mode
DRAWN_BY_NUMPY = 10**9


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` rows, taken without replacement, are among the ``good`` ones."""
    if good + bad < DRAWN_BY_NUMPY:
        return int(rng.hypergeometric(good, bad, draws))
    total = good + bad
    least, most = max(0, draws - bad), min(draws, good)
    mean = draws * good / total
    spread = 12 * sqrt(mean * (bad / total) * max(total - draws, 1) / (total - 1)) + 12
    low, high = max(least, int(mean - spread)), min(most, int(mean + spread) + 1)
    if high <= low:
        return low
    x = np.arange(low, high, dtype=np.float64)  # ratio of the probability of x + 1 to that of x
    steps = np.log((good - x) * (draws - x)) - np.log((x + 1) * (bad - draws + x + 1))
    logs = np.concatenate(([0.0], np.cumsum(steps)))
    weights = np.exp(logs - logs.max())
    return low + int(np.searchsorted(np.cumsum(weights) / weights.sum(), rng.random(), side="right"))


def communication_matrix(partitions: list[int], shards: list[int], seed: int = SEED) -> np.ndarray:
    """Rows of each partition that go to each shard; both margins hold exactly."""
    rng = np.random.default_rng(seed)
    room = list(shards)
    out = np.zeros((len(partitions), len(shards)), dtype=np.int64)
    for p, rows in enumerate(partitions):
        others = sum(room)
        for j, free in enumerate(room):
            others -= free
            taken = hypergeometric(rng, free, others, rows) if rows and free else 0
            out[p, j] = taken
            rows -= taken
            room[j] -= taken
    return out


def permuted(x: np.ndarray, size: int, key: int) -> np.ndarray:
    """A keyed bijection of 0 .. size - 1: a Feistel network over the next even number of bits,
    walked again from where it leaves the range."""
    half = np.uint64(max(1, ((max(size - 1, 1)).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = mixed(np.arange(1, 9, dtype=np.uint64) + np.uint64(key % 2**63))
    out = x.astype(np.uint64, copy=True)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in keys:
            left, right = right, left ^ (mixed(right ^ k) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= np.uint64(size)]
    return out.astype(np.int64)


_LAST: dict[tuple[int, int, int], np.ndarray] = {}


def _local_permutation(seed: int, partition: int, rows: int) -> np.ndarray:
    """Drawn once for the batches of a partition that follow each other in a worker."""
    key = (seed, partition, rows)
    if key not in _LAST:
        _LAST.clear()
        _LAST[key] = np.random.default_rng([seed, 1, partition]).permutation(rows)
    return _LAST[key]


def first_arrivals(matrix: np.ndarray) -> np.ndarray:
    """Rows that earlier partitions send to each shard; in the last line, the shard sizes."""
    return np.vstack([np.zeros((1, matrix.shape[1]), dtype=np.int64), np.cumsum(matrix, axis=0)])


def placed(partition: int, numbers: np.ndarray, starts: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of rows of one partition, by their row numbers."""
    counts = starts[partition + 1] - starts[partition]
    ends = np.cumsum(counts)
    local = _local_permutation(seed, partition, int(ends[-1]))[numbers]
    shard = np.searchsorted(ends, local, side="right")
    arrival = starts[partition][shard] + local - (ends - counts)[shard]
    slot = np.empty(len(local), dtype=np.int64)
    sizes = starts[-1]
    for j in np.unique(shard):
        at = shard == j
        slot[at] = permuted(arrival[at], int(sizes[j]), seed * 1009 + int(j))
    return shard.astype(np.int32), slot


def shuffle_to_shards(
    df: DataFrame, shards: int = SHARDS, seed: int = SEED, file_rows: int = FILE_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``df`` with shard and slot, each shard in order of its slots inside its blocks.

    Shard sizes differ by one row at most, slots of a shard run from 0 without gaps, and any row may
    come to any slot. Only row numbers matter, so nulls, repeated rows and texts of any length are
    rows like others; an empty table gives no rows. Columns named shard or slot are replaced.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "partitions")
    kept = df.drop("shard", "slot")
    kept.write.option("maxRecordsPerFile", file_rows).parquet(path)
    rows = spark.read.schema(kept.schema).parquet(path)
    at = {"file": F.col("_metadata.file_name"), "number": F.col("_metadata.row_index")}
    files = sorted(rows.select(at["file"].alias("file")).groupBy("file").count().collect())
    total = sum(row["count"] for row in files)
    sizes = [total // shards + (j < total % shards) for j in range(shards)]
    matrix = communication_matrix([row["count"] for row in files], sizes, seed)
    starts = spark.sparkContext.broadcast(first_arrivals(matrix))
    names = spark.createDataFrame(
        [(row.file, p) for p, row in enumerate(files)], "file string, partition int"
    )  # one row per file

    @F.pandas_udf("shard int, slot long")
    def destination(partition: pd.Series, number: pd.Series) -> pd.DataFrame:
        shard, slot = np.empty(len(number), dtype=np.int32), np.empty(len(number), dtype=np.int64)
        for p in partition.unique():
            here = (partition == p).to_numpy()
            shard[here], slot[here] = placed(int(p), number.to_numpy()[here], starts.value, seed)
        return pd.DataFrame({"shard": shard, "slot": slot})

    numbered = rows.select(F.struct(*kept.columns).alias("row"), *[c.alias(n) for n, c in at.items()])
    numbered = numbered.join(F.broadcast(names), "file")
    sent = numbered.select("row", destination("partition", "number").alias("to")).select("row", "to.shard", "to.slot")
    blocks = max(shards, sum(-(-size // block_rows) for size in sizes))
    exchanged = sent.repartition(blocks, "shard", F.floor(F.col("slot") / block_rows))
    return exchanged.sortWithinPartitions("shard", "slot").select("row.*", "shard", "slot")


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce("text", F.lit(""))
    slim = documents.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    return shuffle_to_shards(slim).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
