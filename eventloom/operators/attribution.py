"""What happens within a time after an event, and which earlier event an outcome belongs to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.context import Ctx
from eventloom.functions.numbers import count_where, ratio
from eventloom.functions.params import int_slot, string_param, text_slot, with_params
from eventloom.functions.skew import SECOND, SLICE, running
from eventloom.functions.tables import literal_table
from eventloom.operators.segments import USER
from eventloom.sources.events import unified
from eventloom.vocab import FROM_PATH, LANGUAGES, SESSION_ID, TEMPLATE_ID, TEMPLATE_LANG, TEMPLATE_PREFIX

TEN_MINUTES = 600 * SECOND


def interval_counts(
    events: DataFrame,
    anchor: Column,
    follow: Column,
    flag: Column,
    within: int = TEN_MINUTES,
    slice_micros: int = SLICE,
) -> DataFrame:
    """Per (user, time) of an anchor: anchors, and follow-ups in [t, t + within] of the same user.

    No pairs are formed. The follow-ups inside a window are the difference of two running counts,
    one taken just before t and one just after t + within. An anchor without a user has no follow-ups.
    """
    at_once = (
        events.groupBy(USER, "event_timestamp")
        .agg(
            count_where(anchor).alias("anchors"),
            count_where(follow).alias("follows"),
            count_where(follow & flag).alias("flagged"),
        )
    )
    t = F.col("event_timestamp")
    none = F.lit(None).cast("long")

    def point(at, phase, sign, anchor_ts, anchors, follows, flagged):
        return F.struct(
            at.alias("at"), F.lit(phase).alias("phase"), F.lit(sign).alias("sign"), anchor_ts.alias("anchor_ts"),
            anchors.alias("anchors"), follows.alias("follows"), flagged.alias("flagged"),
        )

    # At equal times an opening window comes before the follow-ups and a closing one after them.
    opened = point(t, 0, -1, t, F.col("anchors"), none, none)
    happened = point(t, 1, 0, none, none, F.col("follows"), F.col("flagged"))
    closed = point(t + within, 2, 1, t, F.col("anchors"), none, none)
    empty = F.array().cast(f"array<{_POINT}>")
    points = F.concat(
        F.when(F.col("anchors") > 0, F.array(opened, closed)).otherwise(empty),
        F.when(F.col("follows") > 0, F.array(happened)).otherwise(empty),
    )
    timeline = at_once.select(USER, F.inline(points))

    def add(carried, here):
        return F.coalesce(carried, F.lit(0)) + F.coalesce(here, F.lit(0))

    counted = running(
        timeline, [USER], "at", ["at", "phase"], ["follows", "flagged"], F.sum, add, slice_micros
    )
    known = F.col(USER).isNotNull()
    signed = lambda v: F.sum(F.when(known, F.col("sign") * F.col(v)).otherwise(F.lit(0)))
    return (
        counted.filter(F.col("sign") != 0)
        .groupBy(USER, "anchor_ts")
        .agg(F.max("anchors").alias("anchors"), signed("running_follows").alias("follows"), signed("running_flagged").alias("flagged"))
    )


_POINT = "struct<at:bigint,phase:int,sign:int,anchor_ts:bigint,anchors:bigint,follows:bigint,flagged:bigint>"


def _speech_events(ctx: Ctx, days: int) -> DataFrame:
    return (
        unified(ctx.daily, ctx.intraday, ctx.ago(days), ctx.as_of)
        .filter(F.col("event_name").isin(ctx.roles.save, ctx.roles.tts))
        .select(USER, "event_name", "event_timestamp", string_param(FROM_PATH).alias("from_path"))
    )


def _save_pairs(ctx: Ctx, events: DataFrame, within: int, slice_micros: int) -> DataFrame:
    """`interval_pairs` of the events, also of saves without a user, which have none."""
    name = F.col("event_name")
    counts = interval_counts(
        events,
        name == ctx.roles.save,
        name == ctx.roles.tts,
        F.col("from_path") == ctx.roles.tts_feature_path,
        within,
        slice_micros,
    )
    saves = F.col("anchors")
    return counts.select(
        USER,
        F.col("anchor_ts").alias("save_ts"),
        saves.alias("saves"),
        (saves * F.col("follows")).alias("pairs"),
        (saves * F.col("flagged")).alias("feature_pairs"),
        (saves * (F.col("follows") - F.col("flagged"))).alias("switch_pairs"),
    )


def interval_pairs(ctx: Ctx, days: int = 7, within: int = TEN_MINUTES, slice_micros: int = SLICE) -> DataFrame:
    """Save times with the (save, speech) pairs that start there: all, from the feature, from elsewhere."""
    return _save_pairs(ctx, _speech_events(ctx, days).filter(F.col(USER).isNotNull()), within, slice_micros)


def tts_adoption(ctx: Ctx, days: int = 7, within: int = TEN_MINUTES, slice_micros: int = SLICE) -> DataFrame:
    """How many saves are followed by speech within the interval, and by speech from the feature.

    A save is followed or not once per (user, time); a speech inside two windows counts in both pairs.
    Saves without a user belong to no window but do count as saves.
    """
    per_save = _save_pairs(ctx, _speech_events(ctx, days), within, slice_micros).select(
        "saves",
        (F.col("pairs") > 0).cast("long").alias("any"),
        (F.col("feature_pairs") > 0).cast("long").alias("own"),
        "pairs",
        "feature_pairs",
        "switch_pairs",
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    sums = per_save.agg(
        total("saves").alias("total_saves"),
        total("any").alias("saves_with_tts"),
        total("own").alias("saves_with_feature_tts"),
        total("pairs").alias("tts_pairs"),
        total("feature_pairs").alias("feature_tts_pairs"),
        total("switch_pairs").alias("switch_tts_pairs"),
    )
    return sums.withColumn("adoption_rate", ratio(F.col("saves_with_tts"), F.col("total_saves"))).withColumn(
        "feature_usage_rate", ratio(F.col("saves_with_feature_tts"), F.col("saves_with_tts"))
    )


def asof_attribution(
    events: DataFrame,
    outcome: Column,
    cause: Column,
    label: Column,
    keys: Sequence[str],
    at: str = "event_timestamp",
    slice_micros: int = SLICE,
) -> DataFrame:
    """Distinct outcomes (keys, time) with the label of the last cause at or before them.

    Rows without all keys attribute nothing. The last cause wins even when its label is NULL; of
    causes at the same time the greatest label does.
    """
    is_cause, is_outcome = 0, 1

    def as_step(kind, value):
        return F.struct(F.lit(kind).alias("kind"), value.alias("label"))

    known = events
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    found = F.array(
        F.when(cause, as_step(is_cause, label)), F.when(outcome, as_step(is_outcome, F.lit(None).cast("string")))
    )
    # Repeats at one time add nothing, and without them a second of one key is a bounded group.
    steps = known.select(*keys, at, F.inline(F.array_compact(found))).distinct()
    steps = steps.withColumn(
        "cause", F.when(F.col("kind") == is_cause, F.struct(F.col(at).alias("cause_ts"), "label"))
    )

    def later(carried, here):
        return F.coalesce(here, carried)

    last = running(steps, keys, at, [at, "kind", "label"], ["cause"], F.max, later, slice_micros)
    return last.filter((F.col("kind") == is_outcome) & F.col("running_cause").isNotNull()).select(
        *keys, F.col(at).alias("outcome_ts"), "running_cause.cause_ts", "running_cause.label"
    )


def _template_events(ctx: Ctx, days: int) -> DataFrame:
    roles = ctx.roles
    both = unified(ctx.daily, ctx.intraday, ctx.ago(days), ctx.as_of)
    wanted = both.filter(F.col("event_name").isin(roles.template_click, roles.save, roles.exposure))
    return with_params(
        wanted, [USER, "event_name", "event_timestamp"], session_id=(SESSION_ID, int_slot), template_id=(TEMPLATE_ID, text_slot)
    )


def template_attribution(ctx: Ctx, days: int = 7, slice_micros: int = SLICE) -> DataFrame:
    """Saves with the last template clicked before them in the same session."""
    name = F.col("event_name")
    events = _template_events(ctx, days).filter(name.isin(ctx.roles.template_click, ctx.roles.save))
    return asof_attribution(
        events,
        name == ctx.roles.save,
        name == ctx.roles.template_click,
        F.col("template_id"),
        [USER, "session_id"],
        slice_micros=slice_micros,
    ).select(
        USER,
        "session_id",
        F.col("outcome_ts").alias("save_ts"),
        F.col("cause_ts").alias("click_ts"),
        F.col("label").alias("template_id"),
    )


def template_funnel(ctx: Ctx, days: int = 7, slice_micros: int = SLICE) -> DataFrame:
    """Per clicked template: clicks, clicking users, attributed saves; exposures and saves overall.

    One scan: clicks and saves become counted steps on the line of their user and session, along which the last
    click runs; exposures, and what has no user or session, are counted beside it without a place on the line.
    """
    roles = ctx.roles
    name = F.col("event_name")
    clicked, saved, seen = name == roles.template_click, name == roles.save, name == roles.exposure
    kind = F.when(clicked, 0).when(saved, 1).otherwise(2)
    placed = F.col(USER).isNotNull() & F.col("session_id").isNotNull() & ~seen
    steps = (
        _template_events(ctx, days)
        .select(
            USER,
            F.when(placed, F.col("session_id")).alias("session_id"),
            F.when(placed, F.col("event_timestamp")).alias("at"),
            kind.alias("kind"),
            F.when(clicked, F.col("template_id")).alias("template_id"),
        )
        .groupBy(USER, "session_id", "at", "kind", "template_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    cause = F.when((F.col("kind") == 0) & F.col("at").isNotNull(), F.struct(F.col("at").alias("cause_ts"), "template_id"))
    last = running(
        steps.withColumn("cause", cause), [USER, "session_id"], "at", ["at", "kind", "template_id"], ["cause"], F.max,
        lambda carried, here: F.coalesce(here, carried), slice_micros,
    )
    # A save stands with the template of the last click before it, everything else that is no click with none.
    template = F.when(F.col("kind") == 0, F.col("template_id")).when(F.col("kind") == 1, F.col("running_cause.template_id"))
    per_user = last.withColumn("template_id", template).groupBy("template_id", USER).agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(c) for k, c in enumerate(("clicks", "total_saves", "exposure_count"))],
        count_where((F.col("kind") == 1) & F.col("template_id").isNotNull()).alias("saves"),
    )
    per_template = per_user.groupBy("template_id").agg(
        F.sum("clicks").alias("clicks"),
        count_where((F.col("clicks") > 0) & F.col(USER).isNotNull()).alias("click_users"),
        F.sum("saves").alias("saves"),
        F.sum("exposure_count").alias("exposure_count"),
        F.sum("total_saves").alias("total_saves"),
    )
    everything = Window.partitionBy(F.lit(1))  # as many rows as there are templates
    overall = [F.sum(c).over(everything).alias(c) for c in ("exposure_count", "total_saves")]
    return (
        per_template.select("template_id", "clicks", "click_users", "saves", *overall)
        .filter(F.col("clicks") > 0)
        .orderBy(F.desc("clicks"), "template_id")
    )


def template_detail(
    funnel: DataFrame, languages: dict[str, str] = TEMPLATE_LANG, prefix: str = TEMPLATE_PREFIX
) -> DataFrame:
    """Templates of a known language with their save rate and share of the language's clicks."""
    known = literal_table(funnel.sparkSession, ["template_id", "language"], languages.items())
    detail = funnel.join(F.broadcast(known), "template_id")
    in_language = F.sum("clicks").over(Window.partitionBy("language"))  # as many rows as the lookup lists
    return detail.select(
        "language",
        "template_id",
        F.replace(F.col("template_id"), F.lit(prefix), F.lit("")).alias("name"),
        "clicks",
        "click_users",
        "saves",
        ratio(F.col("saves"), F.col("clicks")).alias("save_click_rate"),
        ratio(F.col("clicks"), in_language).alias("click_share"),
    )


def template_language(
    funnel: DataFrame, languages: dict[str, str] = TEMPLATE_LANG, listed: Sequence[str] = LANGUAGES
) -> DataFrame:
    """Clicks and saves per language; every listed language appears unless nothing was clicked at all."""
    known = literal_table(funnel.sparkSession, ["template_id", "language"], languages.items())
    metrics = ("templates", "clicks", "saves")
    per_language = (
        funnel.join(F.broadcast(known), "template_id", "left")
        .groupBy("language")
        .agg(
            F.count(F.lit(1)).alias("templates"),
            F.sum("clicks").alias("clicks"),
            F.sum("saves").alias("saves"),
            F.max("exposure_count").alias("exposure_count"),
            F.max("total_saves").alias("total_saves"),
        )
    )
    # One row per language and one for unknown templates; the latter only lends its totals.
    one_row = per_language.agg(
        F.max("exposure_count").alias("exposure_count"),
        F.max("total_saves").alias("total_saves"),
        F.collect_list(F.struct("language", *metrics)).alias("found"),
    ).filter(F.col("exposure_count").isNotNull())
    rows = one_row.withColumn("language", F.explode(F.array(*map(F.lit, listed))))
    mine = F.get(F.filter("found", lambda f: f["language"] == F.col("language")), F.lit(0))
    filled = rows.select(
        "language", *[F.coalesce(mine[m], F.lit(0)).alias(m) for m in metrics], "exposure_count", "total_saves"
    )
    return filled.select(
        "*",
        ratio(F.col("clicks"), F.col("exposure_count")).alias("click_rate"),
        ratio(F.col("saves"), F.col("total_saves")).alias("save_rate"),
        ratio(F.col("saves"), F.col("clicks")).alias("save_click_rate"),
    )
