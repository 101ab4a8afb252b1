"""Arrow batches in tasks: helpers of the operators that run Python."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

ROWS_PER_BATCH = 500


def bound_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    """Fewer rows per Arrow batch, for a session whose documents may each be many megabytes long.

    Called by the queries and the pipeline, not by the operators.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def over_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``function`` over each Arrow batch of ``df``; rows keep their order inside a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := function(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """One list per row: ``values[offsets[i]:offsets[i + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def worker_memory() -> dict:
    """A dictionary that lives as long as the Python worker, over the tasks it runs one after another."""
    holder = sys.modules.setdefault("_meterline_worker_memory", types.ModuleType("_meterline_worker_memory"))
    return holder.__dict__
