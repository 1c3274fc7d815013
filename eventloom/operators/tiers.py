"""User tiers by generates per active day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.context import Ctx
from eventloom.functions.numbers import exact_avg, ratio
from eventloom.functions.tables import literal_table
from eventloom.operators.segments import USER, active_day_masks, days_in, user_profile
from eventloom.sources.events import events_of


def user_tiers(ctx: Ctx) -> DataFrame:
    """Users exposed in the tier window with their tier; who generates unexposed has none."""
    exposed = user_profile(ctx).filter(F.col("exposures") > 0)
    return exposed.select(USER, "avg_daily_generates", "tier")


def tier_stats(tiers: DataFrame) -> DataFrame:
    """Per tier: users, their share and mean generates per active day; tiers without users are absent."""
    by_tier = tiers.groupBy("tier").agg(
        F.count(F.lit(1)).alias("users"), exact_avg(F.col("avg_daily_generates")).alias("avg_generates")
    )
    everyone = F.sum("users").over(Window.partitionBy(F.lit(1)))  # at most one row per tier
    return by_tier.select(
        "tier", "users", everyone.alias("total_users"), ratio(F.col("users"), everyone).alias("share"), "avg_generates"
    )


GENERATE_TIERS = ("high", "mid", "low")


def generate_tier_summary(ctx: Ctx) -> DataFrame:
    """Generating users by tier, exposed or not; the three tiers are always present."""
    rule = ctx.tier_rule
    masks = active_day_masks(rule, ctx.as_of)
    generated = ctx.intraday.scan(ctx.ago(rule.days), ctx.as_of).filter(F.col("event_name") == ctx.roles.generate)
    users = (
        generated.groupBy(USER)
        .agg(events_of(generated).alias("generates"), *[F.expr(f"{mask} as {name}") for name, mask in masks.items()])
        .withColumn("days", F.expr(days_in(masks)))
    )
    avg = F.col("generates").cast("double") / F.col("days").cast("double")
    tier = F.when(avg >= rule.high, "high").when(avg > rule.mid, "mid").otherwise("low")
    summary = users.groupBy(tier.alias("tier")).agg(
        F.count(F.lit(1)).alias("users"),
        exact_avg(avg).alias("avg"),
        F.sum("generates").alias("generates"),
        F.sum("days").alias("days"),
    )
    listed = literal_table(ctx.spark, ["rank", "tier"], enumerate(GENERATE_TIERS))
    everyone = F.sum("users").over(Window.partitionBy(F.lit(1)))  # three rows
    return (
        listed.join(summary, "tier", "left")
        .na.fill(0, ["users", "avg", "generates", "days"])
        .select("rank", "tier", "users", "avg", "generates", "days", ratio(F.col("users"), everyone).alias("share"))
        .orderBy("rank")
        .drop("rank")
    )
