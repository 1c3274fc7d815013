"""Ratios, reproducible sums of doubles and report texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column, empty: float | None = 0.0) -> Column:
    """part / whole as double; `empty` when the whole is not positive."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(empty).cast("double"))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * F.lit(100.0)


# Doubles are summed as decimals, by size: (below, type). A type holds all 17 digits of its values; below 1e8 it
# holds 20 decimals, and what is smaller than the last of them is below any amount of money or average of counts.
SIZES = ((1e8, "decimal(28,20)"), (1e26, "decimal(38,10)"), (1e37, "decimal(38,0)"))


def exact_parts(value: Column) -> list[Column]:
    """Decimals by size, one of them set; their sums do not depend on the order tasks finish in.

    NaN (above all numbers), infinities and values from 1e37 on are no amounts: they raise."""
    size, (small, large, largest) = F.abs(value), SIZES
    message = F.concat(F.lit("a number to be summed is not finite or too large: "), value.cast("string"))
    huge = F.when(size < largest[0], value.cast(largest[1])).otherwise(F.raise_error(message).cast(largest[1]))
    inside = F.when((size >= small[0]) & (size < large[0]), value.cast(large[1]))
    return [F.when(size < small[0], value.cast(small[1])), inside, F.when(size >= large[0], huge)]


def exact_total(sums: list[Column]) -> Column:
    """The double that sums of exact_parts stand for; 0 without rows."""
    small, large, huge = (F.coalesce(x.cast("double"), F.lit(0.0)) for x in sums)
    return small + large + huge


def exact_sum(value: Column) -> Column:
    """Sum of doubles that does not depend on the order tasks finish in; no rows give 0."""
    return exact_total([F.sum(part) for part in exact_parts(value)])


def exact_avg(value: Column) -> Column:
    """Average of doubles that does not depend on the order tasks finish in."""
    return F.when(F.count(value) > 0, exact_sum(value) / F.count(value))


def percent_text(part: Column, whole: Column) -> Column:
    """`12.3%`, or `-` without a positive whole."""
    value = F.round(part.cast("double") / whole.cast("double") * 100.0, 1)
    return F.when(whole > 0, F.format_string("%.1f%%", value)).otherwise(F.lit("-"))


def change_text(current: Column, previous: Column) -> Column:
    """`+12.3%`, `-12.3%`, `0%`; `NEW` or `-` when there was nothing before."""
    raw = (current - previous).cast("double") / previous.cast("double") * 100.0
    value = F.round(raw, 1)
    return (
        F.when(previous == 0, F.when(current > 0, F.lit("NEW")).otherwise(F.lit("-")))
        .when(current > previous, F.format_string("+%.1f%%", value))
        .when(current < previous, F.format_string("%.1f%%", value))
        .otherwise(F.lit("0%"))
    )


def grouped_text(value: Column) -> Column:
    return F.format_number(value, 0)
