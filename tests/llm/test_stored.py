"""Tables that operators store."""

import time

from pyspark.sql import functions as F

from eventloom.llm.stored import CLEANUP, stored


def _shuffle_files(spark) -> set[str]:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {x for x in blocks.split("\n") if "/shuffle_" in x}


def test_what_was_shuffled_for_a_stored_table_goes(spark):
    grouped = spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count()
    setting, before = spark.conf.get(CLEANUP, None), _shuffle_files(spark)
    assert {(r.k, r["count"]) for r in stored(grouped).collect()} == {(k, 143 if k < 6 else 142) for k in range(7)}
    until = time.time() + 10
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and spark.conf.get(CLEANUP, None) == setting
