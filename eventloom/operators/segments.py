"""Counts by period and user tier from one pass over the events.

Every count the dashboard needs from intraday data is a column of one per-user aggregate: the tier
of a user and their counts per period come out of the same `groupBy(user)`, so there is no join with
a tier table and distinct users are just users with a positive count. Partial aggregation leaves one
row per user and map task, however many events a user has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.context import SEGMENTS, Ctx, Period, TierRule
from eventloom.functions.sql import between_sql, count_sql, named_sql, quoted

USER = "user_pseudo_id"
BITS = 62


@dataclass(frozen=True)
class Measure:
    """Events with one of `names` (or a name like `like`) meeting the SQL condition `where`, within `period`."""

    period: Period
    names: tuple[str, ...] = ()
    like: str | None = None
    where: str | None = None

    @property
    def key(self) -> tuple:
        """Equal for measures that count the same, whatever their periods are called."""
        return (self.period.lo, self.period.hi, self.names, self.like, self.where)

    def condition(self) -> str:
        parts = [named_sql(self.names, self.like), between_sql(self.period.lo, self.period.hi), self.where]
        return " and ".join(part for part in parts if part)


class Counted:
    """Hands out the per-tier columns of measures and remembers which ones were asked for."""

    def __init__(self):
        self.measures: dict[str, Measure] = {}
        self.totals: dict[str, str] = {}
        self._names: dict[tuple, str] = {}

    def per_user(self, m: Measure) -> str:
        name = self._names.setdefault(m.key, f"m{len(self._names)}")
        self.measures.setdefault(name, m)
        return name

    def _total(self, name: str, value: str) -> str:
        self.totals[name] = value
        return name

    def events(self, m: Measure) -> str:
        mine = self.per_user(m)
        return self._total(f"{mine}_events", f"sum({mine})")

    def users(self, m: Measure) -> str:
        """Distinct non-null users."""
        mine = self.per_user(m)
        return self._total(f"{mine}_users", count_sql(f"{USER} is not null and {mine} > 0"))

    def members(self, m: Measure) -> str:
        """Size of the set of users, in which a missing user id is one member."""
        mine = self.per_user(m)
        return self._total(f"{mine}_members", count_sql(f"{mine} > 0"))

    def shared(self, *ms: Measure) -> str:
        """Users with every one of the measures."""
        mine = [self.per_user(m) for m in ms]
        every = " and ".join(f"{c} > 0" for c in mine)
        return self._total("_".join(mine) + "_shared", count_sql(f"{USER} is not null and {every}"))


@dataclass(frozen=True, eq=False)
class Section:
    """One report table: `rows` maps names to literal keys and to columns taken from `Counted`."""

    rows: Callable[[Counted], list[dict[str, str]]]
    keys: tuple[str, ...]
    keep: str | None = None
    derive: Callable[[DataFrame], DataFrame] = lambda df: df


def active_day_masks(rule: TierRule, as_of: date, active: str = "true") -> dict[str, str]:
    """Bit masks of the days before `as_of` with an `active` row; their bits count distinct days."""
    back = f"datediff(date'{as_of}', to_date(event_date, 'yyyyMMdd')) - 1"
    return {
        f"days{i // BITS}": f"bit_or(case when {active} and {back} between {i} and {i + BITS - 1}"
        f" then shiftleft(1L, {back} - {i}) end)"
        for i in range(0, rule.days, BITS)
    }


def days_in(masks: Iterable[str]) -> str:
    return "cast(" + " + ".join(f"coalesce(bit_count({m}), 0)" for m in masks) + " as bigint)"


def tier_of(avg: str, rule: TierRule) -> str:
    return (
        f"case when {avg} >= {rule.high}D then 'high' when {avg} > {rule.mid}D and {avg} < {rule.high}D then 'mid'"
        f" when {avg} > 0 then 'low' else 'none' end"
    )


def user_profile(ctx: Ctx, counted: Counted | None = None, tiers: bool = True) -> DataFrame:
    """One row per user: the measures and, with `tiers`, the tier inputs over the tier window."""
    measures = dict(counted.measures) if counted else {}
    roles, rule = ctx.roles, ctx.tier_rule
    masks = {}
    if tiers:
        window = Period("tiers", ctx.ago(rule.days), ctx.as_of)
        generated = Measure(window, (roles.generate,))
        masks = active_day_masks(rule, ctx.as_of, generated.condition())
        measures |= {"exposures": Measure(window, (roles.exposure,)), "generates": generated}
    names = tuple(sorted({n for m in measures.values() for n in m.names}))
    likes = sorted({m.like for m in measures.values() if m.like})
    wanted = ([named_sql(names)] if names else []) + [named_sql(like=like) for like in likes]
    ends = [m.period.hi for m in measures.values()]
    events = ctx.intraday.scan(
        min(m.period.lo for m in measures.values()), None if None in ends else max(ends)
    )
    weight = ctx.intraday.weight
    if weight and any(m.where for m in measures.values()):
        raise ValueError("a condition on parameters needs events, not counts of them")
    aggs = {name: count_sql(m.condition(), weight) for name, m in measures.items()} | masks
    profile = events.filter(" or ".join(wanted)).groupBy(USER).agg(*[F.expr(f"{agg} as {n}") for n, agg in aggs.items()])
    if not tiers:
        return profile
    # A missing id never equals itself, so such rows count as exposed but not as generating.
    avg = f"case when {USER} is not null and generates > 0 then double(generates) / double(active_days) else 0D end"
    return (
        profile.selectExpr(USER, *measures, f"{days_in(masks)} as active_days")
        .selectExpr("*", f"{avg} as avg_daily_generates")
        .selectExpr("*", f"case when exposures > 0 then {tier_of('avg_daily_generates', rule)} end as tier")
    )


def tier_totals(ctx: Ctx, counted: Counted, tiers: bool = True) -> DataFrame:
    """One row per tier (and one for users without a tier) with every count asked of `counted`."""
    tier = F.expr(f"case when {USER} is not null then {'tier' if tiers else 'cast(null as string)'} end as tier")
    profile = user_profile(ctx, counted, tiers)
    return profile.groupBy(tier).agg(*[F.expr(f"{value} as {name}") for name, value in counted.totals.items()])


def spread(totals: DataFrame, rows: list[dict[str, str]], section: Section, tiers: bool = True) -> DataFrame:
    """Rows of one section, for all users together and for each tier; tiers nobody is in show zeros."""
    metrics = [c for c in rows[0] if c not in section.keys]

    def struct(row):
        fields = [f"{quoted(n)}, {quoted(v) if n in section.keys else v}" for n, v in row.items()]
        return f"named_struct({', '.join(fields)})"

    listed = f"array({', '.join(map(struct, rows))})"
    mine, keys = "true", list(section.keys)
    if tiers:
        segments = ", ".join(map(quoted, SEGMENTS))
        totals = totals.selectExpr("tier as own", f"explode(array({segments})) as tier", f"{listed} as listed")
        flat = totals.selectExpr("own", "tier", "inline(listed)")
        mine, keys = "tier = 'all' or own <=> tier", [*keys, "tier"]
    else:
        flat = totals.selectExpr(f"inline({listed})")
    out = flat.groupBy(*keys).agg(*[F.expr(f"sum(case when {mine} then `{c}` else 0 end) as `{c}`") for c in metrics])
    if section.keep is not None:
        out = out.filter(section.keep)
    return section.derive(out)


def run_sections(
    ctx: Ctx,
    sections: dict[str, Section],
    tiers: bool = True,
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> dict[str, DataFrame]:
    """All sections from one scan and one shuffle by user.

    `keep` stores the per-tier totals behind them (a handful of rows) when several sections are run.
    """
    counted = Counted()
    rows = {name: s.rows(counted) for name, s in sections.items()}
    totals = keep(tier_totals(ctx, counted, tiers))
    return {name: spread(totals, rows[name], s, tiers) for name, s in sections.items()}


def run_section(ctx: Ctx, section: Section, tiers: bool = True) -> DataFrame:
    return run_sections(ctx, {"only": section}, tiers)["only"]
