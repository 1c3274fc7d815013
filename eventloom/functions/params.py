"""Typed reads from the `event_params` bag.

A single parameter is filtered out of the bag; several are read by `with_params`, which goes over the bag once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.sql import quoted


def param_sql(key: str, slot: str) -> str:
    """First value of `key` in `slot`, NULL when the key is absent."""
    return f"get(filter(event_params, p -> p.key = {quoted(key)}), 0).value.{slot}"


def string_param(key: str) -> Column:
    return F.expr(param_sql(key, "string_value"))


def int_param(key: str) -> Column:
    return F.expr(param_sql(key, "int_value"))


def double_param(key: str) -> Column:
    return F.expr(param_sql(key, "double_value"))


def number_param(key: str) -> Column:
    """Number from whichever slot holds one: int, then double, then a numeric string."""
    return F.coalesce(
        int_param(key).cast("double"),
        double_param(key),
        string_param(key).try_cast("double"),
    )


#: How to read a parameter's value, a struct of slots.
Read = Callable[[Column], Column]


def text_slot(value: Column) -> Column:
    return value["string_value"]


def int_slot(value: Column) -> Column:
    return value["int_value"]


def number_slots(value: Column) -> Column:
    """As `number_param`."""
    return F.coalesce(value["int_value"].cast("double"), value["double_value"], value["string_value"].try_cast("double"))


def bag_sql(keys: list[str]) -> str:
    """One fold over the bag: a struct with the first value of each key as `k0`, `k1`, ..., wrapped as `v` (a first value
    that is itself missing stays)."""
    slots = "struct<string_value: string, int_value: bigint, double_value: double>"
    start = ", ".join(f"'k{i}', cast(null as struct<v: {slots}>)" for i in range(len(keys)))
    taken = ", ".join(
        f"'k{i}', coalesce(bag.k{i}, case when p.key = {quoted(key)} then named_struct('v', p.value) end)" for i, key in enumerate(keys)
    )
    return f"aggregate(event_params, named_struct({start}), (bag, p) -> named_struct({taken}))"


def with_params(events: DataFrame, keep: list[str], **wanted: tuple[str, Read]) -> DataFrame:
    """Columns `keep` of the events and, by name, the parameters wanted: (key, how to read it)."""
    keys = list(dict.fromkeys(key for key, _ in wanted.values()))
    # The generator keeps the fold from being put into each column that reads it.
    folded = events.select(*keep, F.inline(F.array(F.expr(bag_sql(keys)))))
    return folded.select(*keep, *[read(F.col(f"k{keys.index(key)}.v")).alias(name) for name, (key, read) in wanted.items()])
