"""Generated products with soft deletion."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.sources.schema import PRODUCTS


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PRODUCTS).parquet(path)


def _moment(at: datetime) -> Column:
    """A literal that depends on no zone of driver or session."""
    aware = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit((aware - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)))


def live_products(products: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Products not deleted and created in [start, end), moments without a zone being UTC."""
    live = products.filter(F.col("deleted_at").isNull())
    if start is not None:
        live = live.filter(F.col("created_at") >= _moment(start))
    if end is not None:
        live = live.filter(F.col("created_at") < _moment(end))
    return live
