"""Shared scratch space: lineage is cut there, and only there."""

from __future__ import annotations

import logging
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


def checkpoint_root(spark: SparkSession) -> str:
    """Folder that all executors share.

    That is the folder the session checkpoints to, else the one named in ``spark.checkpoint.dir``.
    A local master, where every task runs on this machine, may leave it unset: then it is a folder
    beside the session's warehouse.
    """
    held = spark.sparkContext.getCheckpointDir()
    if held is not None:
        return held
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is not None:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}-scratch"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """:func:`checkpoint_root`, set for the session where it has none yet."""
    root = checkpoint_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and read it from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared folder, and read from there.

    Files survive a lost executor, are compressed and let later reads choose columns, which a
    checkpoint does not.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame, directory: str | None = None, eager: bool = True) -> tuple[DataFrame, bool]:
    """Checkpoint ``df``, or write it to ``directory`` and read it there, and tell whether that was done.

    Where Spark refuses (an unwritable folder, say) the answer is the input with its lineage and
    ``False``; the refusal is logged. Anything that is not Spark's refusal is raised. The folder the
    session checkpoints to stays as it is; what goes to ``directory`` is written at once.
    """
    try:
        if directory is None:
            ensure_checkpoint_dir(df.sparkSession)
            return df.checkpoint(eager=eager), True
        path = f"{directory.rstrip('/')}/lineage-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path), True
    except (PySparkException, Py4JJavaError) as refusal:
        log.warning("lineage kept: %s", refusal)
        return df, False
