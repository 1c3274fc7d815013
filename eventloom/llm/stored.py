"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a local master without that setting gets a folder of its own (tests)."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="eventloom-"))
        folder = sc.getCheckpointDir()
    return f"{folder.rstrip('/')}/{sc.applicationId}"


class Scratch:
    """A sub-folder for what `stored` writes while the scratch is entered, so that it can be removed as a whole once the
    results that read it have been written. Without one, the application's sub-folder is used and stays until that is
    removed."""

    _entered: list[Scratch] = []

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, f"{shared_folder(spark)}/{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        self._entered.append(self)
        return self

    def __exit__(self, *error) -> None:
        self._entered.remove(self)

    def remove(self) -> None:
        _delete(self.spark, self.path)


#: Spark's setting by which an execution's shuffle files go when it ends, not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """df written once as Parquet to the shared folder and read from there, so that nothing is computed twice and a
    lost executor costs no recomputation. What was shuffled for it is read by nothing else and goes at once."""
    folder = Scratch._entered[-1].path if Scratch._entered else shared_folder(df.sparkSession)
    path = f"{folder}/{uuid.uuid4().hex}"
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.select("*").write.parquet(path)  # a frame of its own: df's may be executed again
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def forget(df: DataFrame) -> None:
    """Removes the files of a stored table that nothing reads any more."""
    for file in df.inputFiles()[:1]:
        _delete(df.sparkSession, file.rsplit("/", 1)[0])
