"""The cluster's shared folder: checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a local folder in local mode only."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame as columns in the shared folder: what is read several times, narrower each time, is made once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 200_000


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A summary table to join with: sent to every task only if it is counted small.

    The summary is checkpointed, so counting it does not compute it twice. A larger
    one is joined by shuffle, where Spark splits skewed keys.
    """
    kept = checkpointed(df)
    return F.broadcast(kept) if kept.count() <= rows else kept


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
