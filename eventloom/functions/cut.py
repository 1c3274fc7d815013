"""Cutting a plan at a small intermediate result that several steps read."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`, which every executor can reach; only a local master may do without one."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="eventloom-checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """`df` written once to reliable storage and read from there, so losing executors loses nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
