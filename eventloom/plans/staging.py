"""Each source read once for everything a dashboard shows.

A pass over a source keeps, of each event, what any section reads: the events some section counts, of the days it
counts them, with only the parameters that are read. The result is laid out by day as the sources are, so the operators
take it in their place, and what they read from it is pruned by day, column and event name. Parameter bags, the largest
part of an event, are thereby gone through once and not once per section.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.context import Ctx
from eventloom.functions.cut import shared_folder
from eventloom.operators.paths import counted_steps
from eventloom.sources.events import EventSource, day_text, each_day, read_events
from eventloom.sources.schema import EVENTS
from eventloom.vocab import ACTION, CREDIT_TYPE, CREDITS, FROM_CACHE, FROM_PATH, SESSION_ID, TEMPLATE_ID, VOICE_ID

#: Parameters that sections read.
READ = (ACTION, CREDIT_TYPE, CREDITS, FROM_CACHE, FROM_PATH, SESSION_ID, TEMPLATE_ID, VOICE_ID)


def _intraday_only(ctx: Ctx) -> Column:
    """What is counted from intraday data whether or not the day is finalised."""
    r = ctx.roles
    names = {*r.funnel, *r.exits, *r.upgrades, r.prompt, r.label_adjust, r.description_adjust, r.rate, r.tts, r.generate}
    return F.col("event_name").isin(*sorted(names)) | F.col("event_name").like(r.payment_like)


def _preferring_finalised(ctx: Ctx) -> Column:
    r = ctx.roles
    names = {*r.trend, r.credit, r.generate_success, r.save, r.tts, r.template_click, r.exposure, r.generate}
    return F.col("event_name").isin(*sorted(names)) | counted_steps(r)


def _slim(source: EventSource, ctx: Ctx, days: int, wanted: Column, keys: Iterable[str], folder: str) -> EventSource:
    listed = ", ".join(f"'{key}'" for key in keys)
    events = source.scan(ctx.ago(days), None).filter(wanted)
    bag = F.expr(f"filter(event_params, p -> p.key in ({listed}))").cast(EVENTS["event_params"].dataType).alias("event_params")
    columns = [bag if name == "event_params" else name for name in EVENTS.names]
    events.select(*columns).write.partitionBy("event_date").parquet(folder)
    return read_events(ctx.spark, folder)


def staged(ctx: Ctx, days: int = 14, folder: str | None = None) -> Ctx:
    """ctx over slim copies of its sources: `days` before its day and all days since, for operators that look no further
    back. Which days are finalised is listed once, from the sources, and stays so."""
    folder = folder or f"{shared_folder(ctx.spark)}/staged-{uuid.uuid4().hex}"
    daily = ctx.daily if ctx.daily.pinned else ctx.daily.pin(ctx.ago(days), ctx.as_of)
    finalised = daily.listed_days(ctx.ago(days), ctx.as_of)
    open_days = [day_text(d) for d in each_day(ctx.ago(days), ctx.as_of + timedelta(days=1)) if day_text(d) not in finalised]
    both, day = _preferring_finalised(ctx), F.col("event_date")
    intraday = _slim(ctx.intraday, ctx, days, _intraday_only(ctx) | (day.isin(*open_days) & both), READ, f"{folder}/intraday")
    final = _slim(daily, ctx, days, day.isin(*sorted(finalised)) & both if finalised else F.lit(False), READ, f"{folder}/daily")
    return replace(ctx, intraday=intraday, daily=replace(final, pinned=daily.pinned))
