"""One small file that names what readers should read, replaced in one step."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.Path(path)
    return jvm, conf, place, place.getFileSystem(conf)


def exists(spark: SparkSession, path: str) -> bool:
    *_, place, files = _place(spark, path)
    return files.exists(place)


def read_pointer(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """What was published last, None before that."""
    *_, place, files = _place(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, value: dict[str, Any]) -> None:
    """Writes the value beside `path` and renames it over it, so that a reader sees the former or this one, whole."""
    jvm, conf, place, files = _place(spark, path)
    beside = jvm.Path(f"{path}.{uuid.uuid4().hex}")
    stream = files.create(beside, True)
    stream.write(bytearray(json.dumps(value, indent=1, sort_keys=True).encode()))
    stream.close()
    how = spark.sparkContext._gateway.new_array(getattr(jvm, "Options$Rename"), 1)
    how[0] = getattr(jvm, "Options$Rename").OVERWRITE
    jvm.FileContext.getFileContext(place.toUri(), conf).rename(beside, place, how)
