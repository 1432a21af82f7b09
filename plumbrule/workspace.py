"""Where intermediate tables go: a folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# Rows up to which a side of a join is broadcast; beyond that it is shuffled.
BROADCAST_ROWS = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local session without one gets a temporary folder."""
    named = spark.sparkContext.getConf().get(CHECKPOINT_SETTING) or spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    made = tempfile.mkdtemp(prefix="plumbrule-")
    spark.conf.set(CHECKPOINT_SETTING, made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/plumbrule/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of `df`: its rows are computed once and survive lost executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` marked for broadcast if it has been counted to be small, else unchanged."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
