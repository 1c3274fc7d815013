"""Aggregates per day that a daily run extends by the days it does not hold yet.

    <path>/days/event_date=yyyyMMdd/run=<id>/*.parquet    one run's aggregate of one day
    <path>/current                                        which run holds each day

A run aggregates the missing days in one job, adds their files and then publishes the new list, so a reader sees the
former state or the new one, and a run that fails changes nothing. A day read again gets files of its own; those
it replaces stay for readers that still hold the former list.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timedelta
from typing import TYPE_CHECKING, Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.pointer import exists, publish, read_pointer
from eventloom.sources.events import EventSource, day_text, each_day
from eventloom.sources.schema import EVENTS

if TYPE_CHECKING:
    from eventloom.context import Ctx

DAY = EVENTS["event_date"]


@dataclass(frozen=True)
class DayStates:
    """`fold` turns events of some days into rows of `schema`, which are aggregates per `event_date`.

    `spread` are columns of the schema over whose hash a day's rows go to `files` files."""

    spark: SparkSession
    path: str
    schema: T.StructType
    fold: Callable[[DataFrame], DataFrame]
    spread: tuple[str, ...]
    files: int = 8

    @property
    def published(self) -> dict[str, Any]:
        return read_pointer(self.spark, f"{self.path}/current") or {"days": {}}

    def publish(self, value: dict[str, Any]) -> None:
        publish(self.spark, f"{self.path}/current", value)

    def extend(
        self, source: EventSource, lo: date, hi: date, again: Iterable[date] = (), state: dict[str, Any] | None = None
    ) -> list[date]:
        """Holds all days of [lo, hi) afterwards; those of `again` are read anew. Returns the days that were read.
        `state` takes the place of what is published."""
        given, state = state, state or self.published
        again = set(again)
        wanted = [day for day in each_day(lo, hi) if day_text(day) not in state["days"] or day in again]
        if not wanted:
            if given:
                self.publish(given)
            return []
        events = source.scan(wanted[0], wanted[-1] + timedelta(days=1))
        if (wanted[-1] - wanted[0]).days >= len(wanted):
            events = events.filter(F.col("event_date").isin(*map(day_text, wanted)))
        run = uuid.uuid4().hex
        file = F.pmod(F.xxhash64(*self.spread), F.lit(self.files))
        folded = self.fold(events).select("event_date", *self.schema.names).repartition("event_date", file)
        folded.withColumn("run", F.lit(run)).write.partitionBy("event_date", "run").mode("append").parquet(f"{self.path}/days")
        held = {day_text(day): run if exists(self.spark, self._folder(day_text(day), run)) else None for day in wanted}
        self.publish(state | {"days": state["days"] | held})
        return wanted

    def _folder(self, day: str, run: str) -> str:
        return f"{self.path}/days/event_date={day}/run={run}"

    def read(self, lo: date | None, hi: date | None) -> DataFrame:
        """Rows of the days [lo, hi) with their `event_date`; without `hi`, up to the last day held."""
        held = self.published["days"]
        if lo is not None and hi is not None:
            missing = [day_text(d) for d in each_day(lo, hi) if day_text(d) not in held]
            if missing:
                raise ValueError(f"days not held: {', '.join(missing)}")
        inside = [d for d in sorted(held) if (lo is None or d >= day_text(lo)) and (hi is None or d < day_text(hi))]
        folders = [self._folder(d, held[d]) for d in inside if held[d]]
        schema = T.StructType([*self.schema, DAY])
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/days")
        return reader.parquet(*folders).select(*schema.names)


# --- events counted per day, user and name


COUNTED = T.StructType([EVENTS["user_pseudo_id"], EVENTS["event_name"], T.StructField("n", T.LongType())])


def counted_days(spark: SparkSession, path: str, files: int = 8) -> DayStates:
    """Events per day, user and name: what funnels, overlaps, tiers and trends over any period are sums of."""

    def fold(events: DataFrame) -> DataFrame:
        return events.groupBy("event_date", "user_pseudo_id", "event_name").agg(F.count(F.lit(1)).alias("n"))

    return DayStates(spark, path, COUNTED, fold, ("user_pseudo_id",), files)


@dataclass(frozen=True)
class CountedEvents(EventSource):
    """Counts in place of events: a row stands for `n` events of one user, name and day. Operators that only count by
    name, user and day take it as a source; parameters and times are gone. `df` is that of the events."""

    states: DayStates = field(kw_only=True)
    weight: str = "n"

    def scan(self, lo: date | None = None, hi: date | None = None) -> DataFrame:
        return self.states.read(lo, hi)

    def listed_days(self, lo: date, hi: date) -> frozenset[str]:
        """Days with events, as the list of days has them; no data is read."""
        held = self.states.published["days"]
        return frozenset(d for d, run in held.items() if run and day_text(lo) <= d < day_text(hi))

    def open_days(self) -> set[date]:
        """Days that had no event when they were read: not finalised, it may be."""
        return {datetime.strptime(d, "%Y%m%d").date() for d, run in self.states.published["days"].items() if not run}


def counted_context(ctx: Ctx, path: str, days: int = 14, again: Iterable[date] = (), files: int = 8) -> Ctx:
    """ctx over counts of both sources under `path`, brought up to its day: `days` before it and today. Only days that
    are not held yet are read, days without finalised events, those of `again`, and today."""
    today = {ctx.as_of, *again}
    intraday = counted_days(ctx.spark, f"{path}/intraday", files)
    daily = counted_days(ctx.spark, f"{path}/daily", files)
    sources = [CountedEvents(source.df, states=states) for source, states in ((ctx.intraday, intraday), (ctx.daily, daily))]
    intraday.extend(ctx.intraday, ctx.ago(days), ctx.as_of + timedelta(days=1), today)
    daily.extend(ctx.daily, ctx.ago(days), ctx.as_of, today | sources[1].open_days())
    return replace(ctx, intraday=sources[0], daily=sources[1])
