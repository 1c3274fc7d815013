"""What users do after their first exposure when they never generate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.context import Ctx, Roles
from eventloom.functions.numbers import count_where, percent
from eventloom.functions.skew import SECOND
from eventloom.functions.tables import literal_table
from eventloom.operators.segments import USER
from eventloom.sources.events import unified
from eventloom.vocab import EVENT_LABELS

OTHERS = "others"
PARTS = 64


def _events(ctx: Ctx, days: int) -> DataFrame:
    return unified(ctx.daily, ctx.intraday, ctx.ago(days), ctx.as_of).select(USER, "event_name", "event_timestamp")


def non_converters(ctx: Ctx, days: int = 14) -> DataFrame:
    """Users exposed but never generating, with their first exposure; one aggregate instead of an anti join."""
    name = F.col("event_name")
    return (
        _events(ctx, days)
        .filter(name.isin(ctx.roles.exposure, ctx.roles.generate))
        .groupBy(USER)
        .agg(
            F.min(F.when(name == ctx.roles.exposure, F.col("event_timestamp"))).alias("exposure_ts"),
            count_where(name == ctx.roles.generate).alias("generates"),
        )
        # A missing user id matches no generating user.
        .filter(F.col("exposure_ts").isNotNull() & ((F.col("generates") == 0) | F.col(USER).isNull()))
        .select(USER, "exposure_ts")
    )


def exposure_totals(ctx: Ctx, days: int = 14) -> DataFrame:
    """Distinct exposed and distinct generating users and their difference.

    The two sets are independent, so the difference may disagree with `non_converters`.
    """
    name = F.col("event_name")
    per_user = (
        _events(ctx, days)
        .filter(name.isin(ctx.roles.exposure, ctx.roles.generate))
        .groupBy(USER)
        .agg(
            count_where(name == ctx.roles.exposure).alias("exposures"),
            count_where(name == ctx.roles.generate).alias("generates"),
        )
        .filter(F.col(USER).isNotNull())
    )
    totals = per_user.agg(
        count_where(F.col("exposures") > 0).alias("total_exposed"),
        count_where(F.col("generates") > 0).alias("total_generated"),
    )
    return totals.withColumn("non_generated", F.col("total_exposed") - F.col("total_generated"))


def counted_steps(roles: Roles) -> Column:
    """Events that are steps of a path."""
    name = F.col("event_name")
    return ~name.isin(*roles.path_excluded) & (~name.endswith(roles.path_excluded_suffix) | (name == roles.path_kept))


def path_steps(
    ctx: Ctx,
    n: int = 3,
    after: int = SECOND,
    within: int = 1800 * SECOND,
    days: int = 14,
) -> DataFrame:
    """First `n` counted events of every non-converter in (first exposure + after, + within].

    One scan and no join. A user's time is cut into slices as long as `within`, and each slice is folded to its first
    exposure, whether the user generated, and the first `n` counted events of the band behind that exposure. A band
    reaches into the next slice at most, so counted events are sent to their own slice and to the one before. A user's
    slices are then merged: the band of the earliest exposure is the user's, unless any slice saw a generate.
    """
    roles = ctx.roles
    name, t = F.col("event_name"), F.col("event_timestamp")
    exposed, generated = name == roles.exposure, name == roles.generate
    counted = counted_steps(roles)
    here = F.floor(t / within)
    place = lambda at, own: F.struct(at.alias("slice"), F.lit(own).alias("own"))
    tagged = (
        _events(ctx, days)
        .filter(F.col(USER).isNotNull() & (exposed | generated | counted))
        .select(
            USER, "event_name", "event_timestamp", counted.alias("counted"),
            F.inline(F.array_compact(F.array(place(here, True), F.when(counted, place(here - 1, False))))),
        )
    )
    own, band = F.col("own"), Window.partitionBy(USER, "slice")
    since = t - F.col("exposure_ts")
    sliced = tagged.select(
        USER, "slice", "event_name", "event_timestamp", "counted",
        F.min(F.when(own & exposed, t)).over(band).alias("exposure_ts"),
        F.max(own & generated).over(band).alias("generated"),
    ).withColumn("step", F.coalesce(F.col("counted") & (since > after) & (since <= within), F.lit(False)))
    first = F.row_number().over(band.orderBy(F.desc("step"), "event_timestamp", "event_name"))
    folded = sliced.withColumn("place", first).filter(F.col("place") <= n)
    user = Window.partitionBy(USER)
    merged = folded.select(
        USER, "event_name", "event_timestamp", "step", "place", "exposure_ts",
        F.min("exposure_ts").over(user).alias("first_exposure"),
        F.max("generated").over(user).alias("converted"),
    )
    kept = merged.filter(F.col("step") & ~F.col("converted") & (F.col("exposure_ts") == F.col("first_exposure")))
    return kept.select(USER, F.col("place").alias("step"), "event_name", "event_timestamp")


def path_counts(steps: DataFrame) -> DataFrame:
    """Users per sequence of first three steps; later steps are NULL when a user stops earlier."""
    paths = steps.groupBy(USER).agg(*[
        F.max(F.when(F.col("step") == i, F.col("event_name"))).alias(f"step{i}") for i in (1, 2, 3)
    ])
    return (
        paths.groupBy("step1", "step2", "step3")
        .agg(F.count(F.lit(1)).alias("user_count"))
        .orderBy(F.desc("user_count"), "step1", "step2", "step3")
    )


def topk_with_others(
    counts: DataFrame, by: list[str], item: str, count: str, k: int = 3, min_pct: float = 0.0
) -> DataFrame:
    """Per group the `k` largest items and one row `others` for the rest, if any.

    An item whose share, rounded to one decimal, is under `min_pct` joins the others. Percentages are
    of the group. Ties go by name. Items are first ranked within `PARTS` parts of their group, each
    of which passes on its `k` largest and one sum, so a group may have any number of items.
    """
    part = F.pmod(F.xxhash64(item), F.lit(PARTS))
    in_part = Window.partitionBy(*by, "part").orderBy(F.desc("n"), item)
    candidates = (
        counts.groupBy(*by, item)
        .agg(F.sum(count).alias("n"))
        .withColumn("part", part)
        .withColumn("leads", F.row_number().over(in_part) <= k)
        .groupBy(*by, "part", "leads", F.when(F.col("leads"), F.col(item)).alias("item"))
        .agg(F.sum("n").alias("n"))
    )
    group = Window.partitionBy(*(by or [F.lit(1)]))
    ranked = candidates.select(
        *by,
        "item",
        "n",
        F.sum("n").over(group).alias("total"),
        F.row_number().over(group.orderBy(F.desc("leads"), F.desc("n"), "item")).alias("place"),
        "leads",
    )
    pct = percent(F.col("n"), F.col("total"))
    kept = F.col("leads") & (F.col("place") <= k) & (F.round(pct, 1) >= min_pct)
    return (
        ranked.withColumn("kept", kept)
        .groupBy(
            *by,
            F.when(F.col("kept"), F.col("place")).otherwise(k + 1).alias("rank"),
            F.when(F.col("kept"), F.col("item")).otherwise(OTHERS).alias(item),
        )
        .agg(F.sum("n").alias("n"), F.max("total").alias("total"))
        .select(*by, "rank", item, F.col("n").alias(count), pct.alias("pct"))
    )


def _level(rows: DataFrame, by: list[str], item: str, k: int, min_pct: float, below: str | None) -> DataFrame:
    """Per group of `by` its users `n` and the nodes of `item` under it: the `k` largest and one for the rest.

    Rows without the item stop at the group. Percentages are of those that have it. `below` names a column with the
    nodes of the level below, which stay with the node they belong to if that is not among the rest.
    """
    group = Window.partitionBy(*(by or [F.lit(1)]))
    there = F.col(item).isNotNull()
    ranked = rows.select(
        "*",
        F.sum(F.when(there, F.col("n"))).over(group).alias("total"),
        F.row_number().over(group.orderBy(F.desc(there), F.desc("n"), item)).alias("place"),
    )
    pct = percent(F.col("n"), F.col("total"))
    kept = there & (F.col("place") <= k) & (F.round(pct, 1) >= min_pct)
    rank = F.when(there, F.when(kept, F.col("place")).otherwise(k + 1))
    merged = ranked.groupBy(*by, rank.alias("rank"), F.when(kept, F.col(item)).otherwise(OTHERS).alias("name")).agg(
        F.sum("n").alias("n"), F.max("total").alias("total"), *([F.first(F.when(kept, F.col(below)), True).alias("below")] if below else [])
    )
    node = F.struct("rank", F.col("name").alias("event_name"), F.col("n").alias("user_count"), pct.alias("pct"), *(["below"] if below else []))
    return merged.groupBy(*by).agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(F.when(F.col("rank").isNotNull(), node))).alias("nodes"))


def path_tree(
    paths: DataFrame, labels: dict[str, str] = EVENT_LABELS, others_label: str = "其他", min_pct: float = 5.0
) -> DataFrame:
    """The largest first step, its three largest second steps and theirs, each level with `others`.

    Percentages are of the users who get that far on the branch: second steps count users with a
    second step, third steps users with a third. Only third steps have a minimum share.

    Paths are grouped once and folded from the leaves up: each pair of steps keeps its ranked third steps, each first
    step its ranked pairs, and the root its first steps. Only counts per path, never events, reach this operator, and a
    group has as many rows as there are event names.
    """
    prefixes = paths.groupBy("step1", "step2", "step3").agg(F.sum("user_count").alias("n"))
    pairs = _level(prefixes, ["step1", "step2"], "step3", 3, min_pct, None).withColumnRenamed("nodes", "thirds")
    firsts = _level(pairs, ["step1"], "step2", 3, 0.0, "thirds").withColumnRenamed("nodes", "seconds")
    root = _level(firsts, [], "step1", 1, 0.0, "seconds")
    none = F.array().cast("array<struct<depth:int,parent1:string,parent2:string,rank:int,event_name:string,user_count:bigint,pct:double>>")

    def node(depth: int, x: Column, *parents: Column) -> Column:
        above = [p.alias(f"parent{k}") for k, p in enumerate((*parents, F.lit(None).cast("string"), F.lit(None).cast("string"))[:2], 1)]
        return F.struct(F.lit(depth).alias("depth"), *above, *[x[c].alias(c) for c in ("rank", "event_name", "user_count", "pct")])

    def family(x: Column) -> Column:
        """A first step, its second steps and their third steps: 1 + 4 * 5 nodes at most."""
        seconds = F.transform(x["below"], lambda y: F.concat(F.array(node(2, y, x["event_name"])), thirds(x, y)))
        return F.concat(F.array(node(1, x)), F.coalesce(F.flatten(seconds), none))

    def thirds(x: Column, y: Column) -> Column:
        return F.coalesce(F.transform(y["below"], lambda z: node(3, z, x["event_name"], y["event_name"])), none)

    nodes = root.select(F.inline(F.flatten(F.transform("nodes", family))))
    names = literal_table(paths.sparkSession, ["event_name", "label"], [*labels.items(), (OTHERS, others_label)])
    return nodes.join(F.broadcast(names), "event_name", "left").select(
        "depth",
        "parent1",
        "parent2",
        "rank",
        "event_name",
        F.coalesce("label", "event_name").alias("label"),
        "user_count",
        "pct",
    )
