"""Cumulative ownership of saved voices at one or more cut-off days."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.context import Ctx
from eventloom.functions.numbers import count_where, ratio
from eventloom.functions.params import string_param
from eventloom.operators.segments import USER
from eventloom.sources.events import day_text
from eventloom.sources.states import DayStates
from eventloom.vocab import VOICE_ID


def _daily_saves(ctx: Ctx, events: DataFrame, *days: str) -> DataFrame:
    """Per user and voice (and day): saves, and uses of speech, which have no voice."""
    name = F.col("event_name")
    return (
        events.filter(name.isin(ctx.roles.save, ctx.roles.tts))
        .groupBy(*days, USER, F.when(name == ctx.roles.save, string_param(VOICE_ID)).alias("voice_id"))
        .agg(count_where(name == ctx.roles.save).alias("saves"), count_where(name == ctx.roles.tts).alias("speeches"))
    )


SAVES = T.StructType([
    T.StructField(USER, T.StringType()),
    T.StructField("voice_id", T.StringType()),
    T.StructField("saves", T.LongType()),
    T.StructField("speeches", T.LongType()),
])


@dataclass(frozen=True)
class OwnershipState:
    """What a daily run keeps of all saves so far: one row per user and voice for the days that are settled, and the
    aggregates of the `keep` days since, which can still be read again when a day is finalised or completed late.

    A run reads the new days only and folds those older than `keep` into the settled part."""

    spark: SparkSession
    path: str
    keep: int = 28
    files: int = 8

    def _days(self, ctx: Ctx | None = None) -> DayStates:
        fold = lambda events: _daily_saves(ctx, events, "event_date")
        return DayStates(self.spark, self.path, SAVES, fold, (USER,), self.files)

    def extend(self, ctx: Ctx, again: Iterable[date] = ()) -> list[date]:
        """Brings the state up to `ctx.as_of`; days of `again` are read anew, and everything if one of them is settled.
        Returns the days that were read one by one."""
        days, again = self._days(ctx), set(again)
        state = days.published
        target = ctx.ago(self.keep)
        settled = _day(state.get("settled"))
        start = None
        if settled is None or any(day < settled for day in again):
            settled = target
            run = self._settle(_daily_saves(ctx, ctx.intraday.scan(None, target)))
            start = {"days": {}, "settled": day_text(settled), "base": run}
        read = days.extend(ctx.intraday, settled, ctx.as_of, again, start)
        if settled < target:
            state = days.published
            run = self._settle(self._settled(state).unionByName(days.read(settled, target).select(*SAVES.names)))
            held = {day: run for day, run in state["days"].items() if day >= day_text(target)}
            days.publish({"days": held, "settled": day_text(target), "base": run})
        return read

    def _settle(self, rows: DataFrame) -> str:
        run = uuid.uuid4().hex
        saves = rows.groupBy(USER, "voice_id").agg(F.sum("saves").alias("saves")).filter("saves > 0")
        saves.withColumn("speeches", F.lit(0).cast("long")).write.parquet(f"{self.path}/settled/{run}")
        return run

    def _settled(self, state: dict) -> DataFrame:
        return self.spark.read.schema(SAVES).parquet(f"{self.path}/settled/{state['base']}")

    def saved(self, cutoffs: Mapping[str, date]) -> DataFrame:
        """Saves per user and voice before each cut-off day."""
        days = self._days()
        state = days.published
        settled = _day(state["settled"])
        early = [day for day in cutoffs.values() if day < settled]
        if early:
            raise ValueError(f"settled until {settled}; no snapshot as of {min(early)}")
        late = days.read(settled, max(cutoffs.values()))
        rows = self._settled(state).withColumn("event_date", F.lit("")).unionByName(late)
        before = lambda day: F.coalesce(F.sum(F.when(F.col("event_date") < day_text(day), F.col("saves"))), F.lit(0))
        return rows.filter("saves > 0").groupBy(USER, "voice_id").agg(*[before(day).alias(c) for c, day in cutoffs.items()])

    def speakers(self, lo: date, hi: date) -> DataFrame:
        return self._days().read(lo, hi).filter("speeches > 0").agg(F.count_distinct(USER).alias("n"))


def _day(text: str | None) -> date | None:
    return datetime.strptime(text, "%Y%m%d").date() if text else None


def _snapshots(ctx: Ctx, cutoffs: Mapping[str, date], active_days: int, state: OwnershipState | None) -> DataFrame:
    """One row with the ownership numbers of every cut-off.

    Saves shrink to one row per user and voice, then to one per user. A save without a voice id is a
    voice of its own, so the NULL group of a user contributes its number of saves.
    """
    # The denominator stays that of today whatever the cut-off.
    active = (ctx.ago(active_days), ctx.as_of)
    if state is not None:
        saved, speakers = state.saved(cutoffs), state.speakers(*active)
    else:
        saved = (
            ctx.intraday.scan(None, max(cutoffs.values()))
            .filter(F.col("event_name") == ctx.roles.save)
            .select(USER, "event_date", string_param(VOICE_ID).alias("voice_id"))
            .groupBy(USER, "voice_id")
            .agg(*[count_where(F.col("event_date") < day_text(day)).alias(name) for name, day in cutoffs.items()])
        )
        speakers = ctx.intraday.scan(*active).filter(F.col("event_name") == ctx.roles.tts).agg(F.count_distinct(USER).alias("n"))
    voices = F.col("voice_id").isNull()
    owners = saved.groupBy(USER).agg(*[
        F.sum(F.when(voices, F.col(c)).otherwise((F.col(c) > 0).cast("long"))).alias(c) for c in cutoffs
    ])
    owned = owners.agg(*[
        agg
        for c in cutoffs
        for agg in (
            count_where(F.col(c) > 0).alias(f"{c}_users"),
            F.avg(F.when(F.col(c) > 0, F.col(c))).alias(f"{c}_avg"),
            F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_total"),
        )
    ])
    return owned.withColumn("total_users", speakers.scalar())


def ownership_snapshots(
    ctx: Ctx, cutoffs: Mapping[str, date], active_days: int = 14, state: OwnershipState | None = None
) -> DataFrame:
    """One row per cut-off: owners, active users, owners per active user, mean and total voices.

    From the `state` that daily runs keep, or else from all events up to the last cut-off."""
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("snapshot"),
            F.col(f"{c}_users").alias("voice_users"),
            F.col("total_users"),
            ratio(F.col(f"{c}_users"), F.col("total_users")).alias("voice_users_share"),
            F.coalesce(f"{c}_avg", F.lit(0.0)).alias("avg_voices"),
            F.col(f"{c}_total").alias("total_voices"),
        )
        for c in cutoffs
    ])
    return _snapshots(ctx, cutoffs, active_days, state).select(F.inline(rows))


def voice_ownership(ctx: Ctx, state: OwnershipState | None = None) -> DataFrame:
    return ownership_snapshots(ctx, {"current": ctx.as_of}, state=state)


def voice_ownership_delta(ctx: Ctx, days: int = 7, state: OwnershipState | None = None) -> DataFrame:
    """Ownership today, `days` ago and the change, as one row."""
    both = ownership_snapshots(ctx, {"current": ctx.as_of, "previous": ctx.ago(days)}, state=state)

    def of(snapshot, column):
        return F.max(F.when(F.col("snapshot") == snapshot, F.col(column)))

    one_row = both.agg(
        of("current", "voice_users").alias("voice_users"),
        of("current", "total_users").alias("total_users"),
        of("current", "voice_users_share").alias("voice_users_share"),
        of("current", "avg_voices").alias("avg_voices"),
        of("current", "total_voices").alias("total_voices"),
        of("previous", "voice_users").alias("prev_voice_users"),
        of("previous", "voice_users_share").alias("prev_voice_users_share"),
        of("previous", "avg_voices").alias("prev_avg_voices"),
    )
    return one_row.withColumn(
        "share_delta", F.col("voice_users_share") - F.col("prev_voice_users_share")
    ).withColumn("avg_delta", F.col("avg_voices") - F.col("prev_avg_voices"))
