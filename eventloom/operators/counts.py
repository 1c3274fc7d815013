"""Funnels, set overlaps and daily trends."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.context import Ctx, Period
from eventloom.functions.numbers import count_where, ratio
from eventloom.functions.params import string_param
from eventloom.operators.segments import USER, Measure, Section, run_section
from eventloom.sources.events import between_days, events_of, unified
from eventloom.vocab import FROM_PATH


def event_counts_section(events: Iterable[str], periods: Iterable[Period]) -> Section:
    pairs = [(p, e) for p in periods for e in events]
    return Section(
        rows=lambda c: [
            {
                "period": p.name,
                "event_name": e,
                "event_count": c.events(Measure(p, (e,))),
                "unique_users": c.users(Measure(p, (e,))),
            }
            for p, e in pairs
        ],
        keys=("period", "event_name"),
        keep="event_count > 0",
    )


def event_counts(ctx: Ctx, events: Iterable[str], periods: Iterable[Period]) -> DataFrame:
    """Events and distinct users per period, tier (or `all`) and event; nothing counted, no row."""
    return run_section(ctx, event_counts_section(events, periods))


def funnel_counts(ctx: Ctx) -> DataFrame:
    return event_counts(ctx, ctx.roles.funnel, ctx.periods)


def entry_distribution(ctx: Ctx) -> DataFrame:
    return event_counts(ctx, ctx.roles.entries, ctx.periods)


def exit_distribution(ctx: Ctx) -> DataFrame:
    return event_counts(ctx, ctx.roles.exits, ctx.periods)


def upgrade_period(ctx: Ctx) -> Period:
    return Period("last_7d_open", ctx.ago(7), None)


def upgrade_popup(ctx: Ctx) -> DataFrame:
    """Upgrade dialogue events of the last 7 days and whatever today has so far."""
    return event_counts(ctx, ctx.roles.upgrades, [upgrade_period(ctx)]).drop("period")


def prompt_overlap_section(ctx: Ctx) -> Section:
    def rows(c):
        out = []
        for p in ctx.periods:
            generate, prompt = Measure(p, (ctx.roles.generate,)), Measure(p, (ctx.roles.prompt,))
            out.append({
                "period": p.name,
                "generate_users": c.members(generate),
                "prompt_users": c.members(prompt),
                "generate_with_prompt": c.shared(generate, prompt),
                "generate_count": c.events(generate),
                "prompt_count": c.events(prompt),
            })
        return out

    return Section(rows, ("period",))


def prompt_overlap(ctx: Ctx) -> DataFrame:
    """Users who generate, who adjust the prompt and who do both, per period and tier."""
    return run_section(ctx, prompt_overlap_section(ctx))


def save_overlap_section(ctx: Ctx) -> Section:
    def rows(c):
        out = []
        for p in ctx.periods:
            save, label, text = (
                Measure(p, (name,))
                for name in (ctx.roles.save, ctx.roles.label_adjust, ctx.roles.description_adjust)
            )
            out.append({
                "period": p.name,
                "save_users": c.members(save),
                "with_label_adjust": c.shared(save, label),
                "with_description_adjust": c.shared(save, text),
                "save_count": c.events(save),
                "label_adjust_count": c.events(label),
                "description_adjust_count": c.events(text),
            })
        return out

    return Section(rows, ("period",))


def save_overlap(ctx: Ctx) -> DataFrame:
    """Savers who also adjust labels or the description; adjustment totals cover everybody."""
    return run_section(ctx, save_overlap_section(ctx))


def completion_section(ctx: Ctx) -> Section:
    return Section(
        rows=lambda c: [
            {
                "period": p.name,
                "exposure_users": c.members(Measure(p, (ctx.roles.exposure,))),
                "save_users": c.members(Measure(p, (ctx.roles.save,))),
            }
            for p in ctx.periods
        ],
        keys=("period",),
    )


def completion(ctx: Ctx) -> DataFrame:
    """Users exposed and users who saved, as independent sets."""
    return run_section(ctx, completion_section(ctx))


def payment_section(ctx: Ctx) -> Section:
    def rows(c):
        out = []
        for p in ctx.periods:
            upgrade = Measure(p, (ctx.roles.upgrade_confirm,))
            payment = Measure(p, like=ctx.roles.payment_like)
            out.append({
                "period": p.name,
                "upgrade_users": c.members(upgrade),
                "payment_users": c.members(payment),
                "upgrade_to_payment": c.shared(upgrade, payment),
            })
        return out

    return Section(rows, ("period",))


def payment_conversion(ctx: Ctx) -> DataFrame:
    """Users confirming an upgrade, paying users and users doing both, per period."""
    return run_section(ctx, payment_section(ctx), tiers=False)


def tts_source_share(ctx: Ctx) -> DataFrame:
    """Speech generations and those started from the feature's own page, per period."""
    periods = ctx.periods
    from_feature = F.col("from_path") == ctx.roles.tts_feature_path
    within = {p.name: F.lit(True) for p in periods}
    for p in periods:
        for bound in between_days(p.lo, p.hi):
            within[p.name] = within[p.name] & bound
    events = (
        ctx.intraday.scan(min(p.lo for p in periods), ctx.as_of)
        .filter(F.col("event_name") == ctx.roles.tts)
        .select("event_date", string_param(FROM_PATH).alias("from_path"))
    )
    one_row = events.agg(*[
        agg
        for name, inside in within.items()
        for agg in (count_where(inside).alias(f"{name}_all"), count_where(inside & from_feature).alias(f"{name}_own"))
    ])
    per_period = F.array(*[
        F.struct(F.lit(n).alias("period"), F.col(f"{n}_own").alias("tts_from_feature"), F.col(f"{n}_all").alias("tts_total"))
        for n in within
    ])
    return one_row.select(F.inline(per_period)).withColumn(
        "share", ratio(F.col("tts_from_feature"), F.col("tts_total"))
    )


def trend_daily(ctx: Ctx, tiers: DataFrame, events: Sequence[str] | None = None, days: int = 14) -> DataFrame:
    """Events and distinct users per day, tier (or `all`) and event, finalised days preferred.

    Events shrink to one row per user, day and event before they meet the tiers, so users are rows.
    """
    events = list(events or ctx.roles.trend)
    both = unified(ctx.daily, ctx.intraday, ctx.ago(days), ctx.as_of).filter(F.col("event_name").isin(*events))
    per_user = both.groupBy("event_date", USER, "event_name").agg(events_of(both).alias("n"))
    tiered = per_user.join(tiers.filter(F.col(USER).isNotNull()).select(USER, "tier"), USER, "left")
    counts = tiered.groupBy("event_date", "event_name", "tier").agg(
        F.sum("n").alias("event_count"), F.count(USER).alias("unique_users")
    )
    segments = F.filter(F.array(F.lit("all"), F.col("tier")), lambda t: t.isNotNull())
    return (
        counts.withColumn("tier", F.explode(segments))
        .groupBy("event_date", "tier", "event_name")
        .agg(F.sum("event_count").alias("event_count"), F.sum("unique_users").alias("unique_users"))
        .orderBy("event_date", "tier", "event_name")
    )


def composite(trend: DataFrame, events: Sequence[str]) -> DataFrame:
    """Sum of several events per day and tier, for every day with any row; users of two events count twice."""
    mine = F.col("event_name").isin(*events)
    return (
        trend.groupBy("event_date", "tier")
        .agg(
            F.sum(F.when(mine, F.col("event_count")).otherwise(0)).alias("event_count"),
            F.sum(F.when(mine, F.col("unique_users")).otherwise(0)).alias("unique_users"),
        )
        .orderBy("event_date", "tier")
    )
