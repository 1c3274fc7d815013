"""Ordered per-key work that survives one key holding a large share of all rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECOND = 1_000_000
#: Every key is cut into slices of so much time.
SLICE = 60 * SECOND


def running(
    rows: DataFrame,
    keys: Sequence[str],
    at: str,
    order: Sequence[str],
    values: Sequence[str],
    fold: Callable[[Column], Column],
    merge: Callable[[Column, Column], Column],
    slice_micros: int = SLICE,
) -> DataFrame:
    """Running `fold` (sum, max, ...) of `values` per key in `order`, as `running_<value>`.

    Every key is cut into slices of `at` (micros): each slice is folded on its own, and the fold of
    all earlier slices, one row per slice, is merged in. `rows` must be unique on `keys + order`, so a
    slice has a bounded number of rows whatever its key weighs.
    `merge(carried, here)` sees NULL for an absent part; rows without a key are carried nothing.
    """
    sliced = rows.withColumn("slice", F.floor(F.col(at) / slice_micros).cast("long"))
    within = Window.partitionBy(*keys, "slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    folded = sliced.select("*", *[fold(F.col(v)).over(within).alias(f"here_{v}") for v in values])
    earlier = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # Reading every column, and a generator that no filter on its keys passes, keep this branch identical to the other
    # up to the shuffle that made `rows`, so Spark reuses that shuffle instead of scanning again.
    carry = (
        sliced.groupBy(*keys, "slice")
        .agg(F.bit_xor(F.hash(*rows.columns)).alias("read"), *[fold(F.col(v)).alias(v) for v in values])
        .filter(F.col("read").isNotNull())
        .select(F.struct(*keys, "slice", *[fold(F.col(v)).over(earlier).alias(f"carried_{v}") for v in values]).alias("fold"))
        .select(F.inline(F.array("fold")))
    )
    merged = folded.join(carry, [*keys, "slice"], "left")
    return merged.select(
        *rows.columns,
        *[merge(F.col(f"carried_{v}"), F.col(f"here_{v}")).alias(f"running_{v}") for v in values],
    )
