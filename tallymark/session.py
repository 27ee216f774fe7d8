"""Shared folders of the running session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    A folder set on the context counts as well. Without one only local mode
    gets a temporary folder; on a cluster it would be another one on each machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
        root = tempfile.mkdtemp(prefix="spark-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh directory below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder as Parquet, so that readers still prune columns and push filters."""
    path = scratch(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
