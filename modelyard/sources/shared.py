"""The shared folder of the cluster: lineage cuts, intermediate tables, stream state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in `spark.checkpoint.dir`.  Only a local session may fall back to a
    temporary folder: elsewhere a folder of one machine would be lost with that machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="modelyard-")
        context.setCheckpointDir(configured)
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so reruns cannot read each other's files."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
