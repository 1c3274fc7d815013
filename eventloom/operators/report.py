"""The daily funnel report."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.context import Ctx
from eventloom.functions.numbers import change_text, count_where, grouped_text, percent_text
from eventloom.operators.segments import USER
from eventloom.sources.events import between_days, day_text


def funnel_steps(ctx: Ctx) -> dict[str, tuple[str, ...]]:
    roles = ctx.roles
    return {
        "exposure": (roles.exposure,),
        "entry": roles.entries,
        "generate": (roles.generate,),
        "select_voice": (roles.select,),
        "save": (roles.save,),
    }


def _on(day: date) -> Column:
    return reduce(and_, between_days(day, day + timedelta(days=1)))


def _wanted(ctx: Ctx) -> Column:
    return F.col("event_name").isin(*[e for events in funnel_steps(ctx).values() for e in events])


def daily_funnel(ctx: Ctx, day: date) -> DataFrame:
    """Events of one day as one row of five funnel steps; both entry events form one step."""
    return (
        ctx.intraday.scan(day, day + timedelta(days=1))
        .filter(_wanted(ctx))
        .agg(*[count_where(F.col("event_name").isin(*events)).alias(s) for s, events in funnel_steps(ctx).items()])
        .select(F.lit(day_text(day)).alias("event_date"), "*")
    )


def _report_counts(ctx: Ctx, days: dict[str, date], history_days: int) -> DataFrame:
    """One row: the steps of each day, for everybody and for users with a generate in the window.

    The days may lie outside the window; the scan covers both.
    One pass and one shuffle by user; both groups of users and all days are columns of it.
    """
    steps = funnel_steps(ctx)
    since = ctx.ago(history_days)
    in_window = reduce(and_, between_days(since, ctx.as_of))
    per_user = (
        ctx.intraday.scan(min(since, *days.values()), max(ctx.as_of, *[day + timedelta(days=1) for day in days.values()]))
        .filter(_wanted(ctx))
        .groupBy(USER)
        .agg(
            count_where((F.col("event_name") == ctx.roles.generate) & in_window).alias("generates"),
            *[
                count_where(F.col("event_name").isin(*events) & _on(day)).alias(f"{name}_{step}")
                for name, day in days.items()
                for step, events in steps.items()
            ],
        )
    )
    returning = F.col(USER).isNotNull() & (F.col("generates") > 0)
    columns = [f"{name}_{step}" for name in days for step in steps]
    return per_user.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns],
        *[F.coalesce(F.sum(F.when(returning, F.col(c))), F.lit(0)).alias(f"history_{c}") for c in columns],
    )


def history_funnel(ctx: Ctx, day: date, history_days: int = 14) -> DataFrame:
    """`daily_funnel` of users with a generate in the window of `history_days` before `as_of`."""
    counts = _report_counts(ctx, {"day": day}, history_days)
    return counts.select(
        F.lit(day_text(day)).alias("event_date"), *[F.col(f"history_day_{s}").alias(s) for s in funnel_steps(ctx)]
    )


def daily_report(ctx: Ctx, history_days: int = 14) -> DataFrame:
    """Report rows for the day before `as_of`: counts, change from the day before, conversion.

    A step converts from the step above it; the two last rows convert exposures to saves, for
    everybody and for users with a generate in the window.
    """
    steps = list(funnel_steps(ctx))
    counts = _report_counts(ctx, {"day": ctx.ago(1), "before": ctx.ago(2)}, history_days)
    none = F.lit(None).cast("string")

    def row(rank, step, now, before, change, conversion):
        return F.struct(
            F.lit(rank).alias("rank"),
            F.lit(step).alias("step"),
            now.alias("event_count"),
            grouped_text(now).alias("count_text"),
            before.cast("long").alias("previous_count"),
            change.alias("change"),
            conversion.alias("conversion"),
        )

    rows = []
    for i, step in enumerate(steps):
        now, before = F.col(f"day_{step}"), F.col(f"before_{step}")
        conversion = percent_text(now, F.col(f"day_{steps[i - 1]}")) if i else none
        rows.append(row(i + 1, step, now, before, change_text(now, before), conversion))
    for who in ("", "history_"):
        exposed, saved = F.col(f"{who}day_{steps[0]}"), F.col(f"{who}day_{steps[-1]}")
        name = f"overall_{who.rstrip('_') or 'all'}"
        rows.append(row(len(rows) + 1, name, exposed, F.lit(None), none, percent_text(saved, exposed)))
    return counts.select(F.inline(F.array(*rows))).select(F.lit(day_text(ctx.ago(1))).alias("report_date"), "*")
