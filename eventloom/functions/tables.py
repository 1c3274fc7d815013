"""Small literal tables for lookups."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_table(spark: SparkSession, columns: Sequence[str], rows: Iterable[Sequence]) -> DataFrame:
    """Lookup table held in the plan itself; its size is that of the argument."""
    structs = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
