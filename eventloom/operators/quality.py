"""Ratings, credit share, cache hits and the behaviour of users who rate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.context import Ctx, Period
from eventloom.functions.numbers import count_where, exact_parts, exact_total, ratio
from eventloom.functions.params import int_param, number_slots, param_sql, string_param, text_slot, with_params
from eventloom.operators.segments import USER, Measure, Section, run_section
from eventloom.sources.events import between_days, unified
from eventloom.vocab import ACTION, CREDIT_TYPE, CREDITS, DISLIKE, FROM_CACHE, LIKE, VOICES_PER_GENERATE


def _rated(ctx: Ctx, period: Period, *actions: int) -> Measure:
    listed = ", ".join(map(str, actions))
    return Measure(period, (ctx.roles.rate,), where=f"{param_sql(ACTION, 'int_value')} in ({listed})")


def rating_section(ctx: Ctx, days: int = 7) -> Section:
    period = Period(f"last_{days}d", ctx.ago(days), ctx.as_of)

    def rows(c):
        like, dislike = _rated(ctx, period, LIKE), _rated(ctx, period, DISLIKE)
        return [{
            "like": c.events(like),
            "dislike": c.events(dislike),
            "total": c.events(Measure(period, (ctx.roles.rate,))),
            "like_users": c.users(like),
            "dislike_users": c.users(dislike),
        }]

    def derive(df):
        like, dislike = F.col("like"), F.col("dislike")
        return df.select(
            "tier",
            "like",
            "dislike",
            (F.col("total") - like - dislike).alias("unknown"),
            "total",
            "like_users",
            "dislike_users",
            ratio(like, like + dislike).alias("like_rate"),
            ratio(like, F.col("like_users")).alias("avg_like"),
            ratio(dislike, F.col("dislike_users")).alias("avg_dislike"),
        )

    return Section(rows, (), derive=derive)


def rating_summary(ctx: Ctx, days: int = 7) -> DataFrame:
    """Likes, dislikes and other ratings per tier; the like rate leaves the others out."""
    return run_section(ctx, rating_section(ctx, days))


def credit_share(ctx: Ctx, days: int = 7) -> DataFrame:
    """Credits used by the feature and in total, for the last `days` and the same span before.

    One pass over both windows; rows without a readable amount do not count.
    """
    windows = {
        "": Period("current", ctx.ago(days), ctx.as_of),
        "prev_": Period("previous", ctx.ago(2 * days), ctx.ago(days)),
    }
    both = unified(ctx.daily, ctx.intraday, ctx.ago(2 * days), ctx.as_of, include_today=False)
    used = with_params(
        both.filter(F.col("event_name") == ctx.roles.credit),
        ["event_date"],
        credit_type=(CREDIT_TYPE, text_slot),
        credits=(CREDITS, number_slots),
    ).filter(F.col("credits").isNotNull())
    # A sum per window and kind of use, in decimals; both windows and both totals are made of these four rows.
    window = F.when(reduce(and_, between_days(windows[""].lo, None)), "").otherwise("prev_")
    own = F.coalesce(F.col("credit_type") == ctx.roles.credit_feature, F.lit(False))
    summed = used.groupBy(window.alias("window"), own.alias("own")).agg(
        *[F.sum(part).alias(f"part{k}") for k, part in enumerate(exact_parts(F.col("credits")))]
    )

    def total(prefix: str, rows: Column) -> Column:
        mine = (F.col("window") == prefix) & rows
        return exact_total([F.sum(F.when(mine, F.col(f"part{k}"))) for k in range(3)])

    totals = summed.agg(*[
        total(prefix, rows).alias(f"{prefix}{name}")
        for prefix in windows
        for name, rows in (("feature_credits", F.col("own")), ("total_credits", F.lit(True)))
    ])
    share, before = (ratio(F.col(f"{p}feature_credits"), F.col(f"{p}total_credits")) for p in windows)
    return totals.withColumn("share", share).withColumn("prev_share", before).withColumn(
        "share_delta", F.col("share") - F.col("prev_share")
    )


def flag_ratio_daily(ctx: Ctx, event: str, flag: Column, days: int = 14) -> DataFrame:
    """Per day: events, events with `flag` and their ratio; finalised days preferred, today included."""
    return (
        unified(ctx.daily, ctx.intraday, ctx.ago(days), ctx.as_of)
        .filter(F.col("event_name") == event)
        .groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("total"), count_where(flag).alias("hits"))
        .withColumn("hit_ratio", ratio(F.col("hits"), F.col("total")))
        .orderBy("event_date")
    )


def cache_ratio(ctx: Ctx, days: int = 14) -> DataFrame:
    return flag_ratio_daily(ctx, ctx.roles.generate_success, string_param(FROM_CACHE) == "true", days)


def _rating_profile(ctx: Ctx, days: int) -> DataFrame:
    """Per user: generates, saves, likes and rated (liked or disliked) events."""
    roles = ctx.roles
    action = int_param(ACTION)
    name = F.col("event_name")
    rated = name == roles.rate
    return (
        ctx.intraday.scan(ctx.ago(days), ctx.as_of)
        .filter(name.isin(roles.generate, roles.save, roles.rate))
        .groupBy(USER)
        .agg(
            count_where(name == roles.generate).alias("generates"),
            count_where(name == roles.save).alias("saves"),
            count_where(rated & (action == LIKE)).alias("likes"),
            count_where(rated & action.isin(LIKE, DISLIKE)).alias("ratings"),
        )
        .filter(F.col("generates") > 0)
    )


def rater_comparison(ctx: Ctx, days: int = 14, voices: int = VOICES_PER_GENERATE) -> DataFrame:
    """Averages of generating users who rate, beside those of all generating users, and the difference."""
    rates = (F.col("ratings") > 0) & F.col(USER).isNotNull()
    metrics = {
        "avg_generated_voices": F.col("generates") * voices,
        "avg_saved_voices": F.col("saves"),
        "avg_generate_sessions": F.col("generates"),
    }
    one_row = _rating_profile(ctx, days).agg(
        count_where(rates).alias("raters"),
        F.count(F.lit(1)).alias("everyone"),
        *[F.avg(F.when(rates, v)).alias(f"raters_{k}") for k, v in metrics.items()],
        *[F.avg(v).alias(f"everyone_{k}") for k, v in metrics.items()],
    )
    segments = F.array(*[
        F.struct(
            F.lit(segment).alias("segment"),
            F.col(who).alias("total_users"),
            *[F.col(f"{who}_{k}").alias(k) for k in metrics],
            *[(F.col(f"{who}_{k}") - F.col(f"everyone_{k}")).alias(k.replace("avg_", "diff_")) for k in metrics],
        )
        for segment, who in (("rating_users", "raters"), ("all_users", "everyone"))
    ])
    return one_row.select(F.inline(segments))


def like_segments(ctx: Ctx, cuts: Sequence[float] = (0.2, 0.5), days: int = 14) -> DataFrame:
    """Rating users who generate, by likes per generate: <= low, between, >= high."""
    low, high = cuts
    per_generate = F.col("likes").cast("double") / F.col("generates").cast("double")
    rank = F.when(per_generate <= low, 1).when(per_generate < high, 2).otherwise(3)
    label = F.when(F.col("rank") == 1, f"<={low}").when(F.col("rank") == 2, f"({low},{high})").otherwise(f">={high}")
    everyone = F.sum("user_count").over(Window.partitionBy(F.lit(1)))  # three rows
    return (
        _rating_profile(ctx, days)
        .filter((F.col("ratings") > 0) & F.col(USER).isNotNull())
        .groupBy(rank.alias("rank"))
        .agg(F.count(F.lit(1)).alias("user_count"))
        .withColumn("total_users", everyone)
        .orderBy("rank")
        .select(
            label.alias("segment"),
            "user_count",
            "total_users",
            ratio(F.col("user_count"), F.col("total_users")).alias("share"),
        )
    )
