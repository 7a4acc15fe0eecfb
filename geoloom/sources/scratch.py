"""A folder for files between steps, which driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir; below a folder of this machine only if that is unset and Spark is local."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"file://{tempfile.gettempdir()}/checkpoints"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in such a folder, read again: later steps neither plan nor run what led to it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
