"""Day-partitioned event tables and the union that prefers finalised days."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions import footers
from eventloom.sources.schema import EVENTS


def day_text(day: date) -> str:
    return day.strftime("%Y%m%d")


def each_day(lo: date, hi: date) -> list[date]:
    return [lo + timedelta(days=n) for n in range((hi - lo).days)]


def between_days(lo: date | None, hi: date | None) -> list[Column]:
    """Literal bounds on the partition column, so the scan lists only these days."""
    day = F.col("event_date")
    bounds = []
    if lo is not None:
        bounds.append(day >= day_text(lo))
    if hi is not None:
        bounds.append(day < day_text(hi))
    return bounds


@dataclass(frozen=True)
class EventSource:
    """Events in the canonical columns.

    `between` says how a range of days is filtered, for tables whose files are not laid out by
    `event_date` but by some other column of `df`. `table` names a catalog table partitioned by
    `event_date`, `path` a folder laid out by it: their days are then listed without reading data.
    """

    df: DataFrame
    between: Callable[[date | None, date | None], list[Column]] = between_days
    table: str | None = None
    pinned: tuple[date, date, frozenset[str]] | None = None
    #: The column that says how many events a row stands for; None where a row is an event.
    weight: str | None = None
    path: str | None = None

    def scan(self, lo: date | None = None, hi: date | None = None) -> DataFrame:
        """Events of the days [lo, hi)."""
        df = self.df
        for bound in self.between(lo, hi):
            df = df.filter(bound)
        return df.select(*EVENTS.names)

    def days(self, lo: date, hi: date) -> DataFrame:
        """Days with at least one event of any name; reads the partition column only.

        A catalog may list partitions that hold no row, so it only narrows down which days are looked at."""
        found = self.scan(lo, hi)
        if self.table is not None:
            partitions = self.df.sparkSession.sql(f"show partitions {self.table}")
            days = partitions.select(F.regexp_extract("partition", r"event_date=(\d{8})", 1).alias("event_date"))
            for bound in between_days(lo, hi):
                days = days.filter(bound)
            found = found.filter(F.col("event_date").isin([r["event_date"] for r in days.distinct().collect()]))
        return found.select("event_date").distinct()

    def listed_days(self, lo: date, hi: date) -> frozenset[str]:
        """`days` on the driver, at most one per day of the range; as of now, or of the pinned snapshot."""
        if self.pinned is not None and self.pinned[0] <= lo and hi <= self.pinned[1]:
            return frozenset(d for d in self.pinned[2] if day_text(lo) <= d < day_text(hi))
        folders = self._folders(lo, hi)
        held = {day: footers.holds_rows(self.df.sparkSession, folder) for day, folder in folders.items()} if folders is not None else {None: None}
        if None in held.values():  # other formats say nothing about rows, so the data must
            return frozenset(row["event_date"] for row in self.days(lo, hi).collect())
        return frozenset(day for day, rows in held.items() if rows)

    def _folders(self, lo: date, hi: date) -> dict[str, str] | None:
        """Folder by day, for layouts that have one."""
        days = [day_text(day) for day in each_day(lo, hi)]
        if self.path is not None:
            return {day: f"{self.path}/event_date={day}" for day in days}
        if self.table is None:
            return None
        spark, found = self.df.sparkSession, {}
        listed = {row["partition"] for row in spark.sql(f"show partitions {self.table}").collect()}
        for day in days:
            if f"event_date={day}" in listed:
                described = spark.sql(f"describe formatted {self.table} partition (event_date = '{day}')").collect()
                found[day] = next(row["data_type"] for row in described if row["col_name"] == "Location")
        return found

    def pin(self, lo: date, hi: date) -> EventSource:
        """This source with the days of [lo, hi) listed once, for several results that must agree."""
        return replace(self, pinned=(lo, hi, self.listed_days(lo, hi)))


def events_of(events: DataFrame) -> Column:
    """How many events the rows of a group are, be they events or counts of them."""
    return F.sum("n") if "n" in events.columns else F.count(F.lit(1))


def read_events(spark: SparkSession, path: str) -> EventSource:
    """Parquet laid out as `event_date=yyyyMMdd/`."""
    return EventSource(spark.read.schema(EVENTS).parquet(path), path=path.rstrip("/"))


def table_events(spark: SparkSession, table: str) -> EventSource:
    """Catalog table partitioned by `event_date` (string)."""
    return EventSource(spark.table(table), table=table)


def unified(
    daily: EventSource, intraday: EventSource, lo: date, hi: date, include_today: bool = True
) -> DataFrame:
    """Finalised events of [lo, hi) plus intraday events of every day without a finalised one.

    A finalised day hides its intraday twin even when it holds none of the events wanted later,
    because the days are looked up before any event filter. `include_today` lets intraday reach one
    day further than the finalised range.

    The days are listed once per call. Both sides are then scanned for literal days only, so no day
    comes from both, whatever is finalised between planning and running, and the union needs no join.
    """
    last = hi + timedelta(days=1) if include_today else hi
    finalised = daily.listed_days(lo, hi)
    open_days = [day for day in each_day(lo, last) if day_text(day) not in finalised]
    events = daily.scan(lo, hi).filter(F.col("event_date").isin(*sorted(finalised)) if finalised else F.lit(False))
    if not open_days:
        return events
    provisional = intraday.scan(open_days[0], open_days[-1] + timedelta(days=1))
    if (open_days[-1] - open_days[0]).days >= len(open_days):
        provisional = provisional.filter(F.col("event_date").isin(*map(day_text, open_days)))
    return events.unionByName(provisional)
