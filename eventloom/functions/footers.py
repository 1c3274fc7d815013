"""What Parquet files say about themselves, read on the driver without a job."""

from __future__ import annotations

from pyspark.sql import SparkSession


def holds_rows(spark: SparkSession, folder: str) -> bool | None:
    """Whether a file of the folder has a row, from the footers; None if the folder holds files of other formats.

    Footers are read until one counts a row, so a folder of many files costs one read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(conf)
    if not files.exists(place):
        return False
    paths = [status.getPath() for status in files.listStatus(place) if status.isFile() and status.getLen() > 0]
    paths = [path for path in paths if path.getName()[0] not in "_."]
    if not all(path.getName().endswith(".parquet") for path in paths):
        return None
    parquet = jvm.org.apache.parquet.hadoop
    for path in paths:
        reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(path, conf))
        try:
            if reader.getRecordCount() > 0:
                return True
        finally:
            reader.close()
    return False
