"""Shared scratch space, lineage cuts and the size check behind every broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Estimated bytes of a broadcast side.
BROADCAST_BYTES = 64 << 20


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster or the caller names it.

    ``spark.checkpoint.dir``, else the folder of ``setCheckpointDir``.  Only where none is named
    and all runs on one machine, a temporary folder is made, once per session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or spark.conf.get("quotaflow.scratch", None)
    if root is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that the driver and all executors of {master} share")
        root = tempfile.mkdtemp(prefix="quotaflow-")
        spark.conf.set("quotaflow.scratch", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used before."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from the written copy."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint()


def staged(df: DataFrame, name: str = "staged") -> DataFrame:
    """``df`` written once as Parquet, for steps that would each work it out again; they read only their columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: what the fixed types take, and the length of each text."""
    varied = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    size = F.lit(16 + 8 * len(df.columns))
    for name in varied:
        size = size + F.coalesce(F.octet_length(df[name]), F.lit(0))
    return size


def is_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """True if the rows of ``df`` take at most ``limit`` bytes; starts a job.

    A distributed sum (a row limit would move its rows into one task).  Meant for
    input tables and written intermediate ones, where it is cheap.
    """
    return df.agg(F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()[0] <= limit


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it is small, else unchanged; starts a job.

    Unchanged means a shuffle join, in which adaptive execution splits hot keys.
    """
    return F.broadcast(df) if is_small(df, limit) else df
