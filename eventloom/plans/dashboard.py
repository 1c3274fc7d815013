"""The whole dashboard for one day: all sections, one tidy table of them, one JSON document."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.context import Ctx
from eventloom.functions.cut import cut
from eventloom.functions.pointer import publish, read_pointer
from eventloom.operators import attribution, counts, ownership, paths, quality, tiers
from eventloom.operators.segments import run_sections
from eventloom.plans.staging import staged
from eventloom.vocab import EVENT_LABELS, LANGUAGES, TEMPLATE_LANG, TEMPLATE_PREFIX


#: No section looks further back, but for ownership and the tiers if their rule does.
DAYS = 14


@dataclass(frozen=True)
class Tables:
    """Lookup tables and windows the dashboard takes beside the context."""

    labels: Mapping[str, str] = field(default_factory=lambda: EVENT_LABELS)
    template_languages: Mapping[str, str] = field(default_factory=lambda: TEMPLATE_LANG)
    template_prefix: str = TEMPLATE_PREFIX
    languages: Sequence[str] = LANGUAGES
    adoption_within: int = attribution.TEN_MINUTES
    path_within: int = 1800 * paths.SECOND


def dashboard(ctx: Ctx, tables: Tables = Tables(), owned: ownership.OwnershipState | None = None) -> dict[str, DataFrame]:
    """All sections by name, as the dashboard rounds them.

    Each source is scanned once, into a slim copy that all sections read (`plans/staging.py`). Only ownership goes
    further back: it takes the state that daily runs keep, or else reads the saves of all days.
    Which days are finalised is listed once, so all sections follow one snapshot. What one pass over the intraday events
    can count is counted in one pass. Results several sections read (totals per tier, tiers, trend, templates, path
    counts) are stored once; the rest is lazy.
    """
    source = ctx
    days = max(DAYS, ctx.tier_rule.days)
    ctx = staged(replace(ctx, daily=ctx.daily.pin(ctx.ago(days), ctx.as_of)), days)
    shared_sections = {
        "funnel": counts.event_counts_section(ctx.roles.funnel, ctx.periods),
        "prompt_overlap": counts.prompt_overlap_section(ctx),
        "entry_distribution": counts.event_counts_section(ctx.roles.entries, ctx.periods),
        "save_overlap": counts.save_overlap_section(ctx),
        "rating": quality.rating_section(ctx),
        "upgrade": counts.event_counts_section(ctx.roles.upgrades, [counts.upgrade_period(ctx)]),
        "completion": counts.completion_section(ctx),
        "payment": counts.payment_section(ctx),
        "exit_distribution": counts.event_counts_section(ctx.roles.exits, ctx.periods),
    }
    sections = run_sections(ctx, shared_sections, keep=cut)
    sections["upgrade"] = sections["upgrade"].drop("period")
    sections["payment"] = sections["payment"].filter(F.col("tier") == "all").drop("tier")

    tiered = cut(tiers.user_tiers(ctx))
    trend = cut(counts.trend_daily(ctx, tiered))
    templates = cut(attribution.template_funnel(ctx))
    flow = cut(paths.path_counts(paths.path_steps(ctx, within=tables.path_within)))
    sections |= {
        "user_tiers": tiers.tier_stats(tiered),
        "credit": quality.credit_share(ctx),
        "tts_source": counts.tts_source_share(ctx),
        "trend": trend,
        "entry_composite": counts.composite(trend, ctx.roles.entries),
        "voice_ownership": ownership.voice_ownership_delta(source, state=owned),
        "tts_adoption": attribution.tts_adoption(ctx, within=tables.adoption_within),
        "exposure_totals": paths.exposure_totals(ctx),
        "path_users": flow.agg(F.coalesce(F.sum("user_count"), F.lit(0)).alias("non_gen_with_events")),
        "path_tree": paths.path_tree(flow, dict(tables.labels)),
        "template_language": attribution.template_language(
            templates, dict(tables.template_languages), tables.languages
        ),
        "template_detail": attribution.template_detail(
            templates, dict(tables.template_languages), tables.template_prefix
        ),
        "cache_ratio": quality.cache_ratio(ctx),
    }
    return {name: presented(name, df) for name, df in sections.items()}


# Column -> (factor, decimals) as the dashboard shows it; shares become percentages.
ROUNDING = {
    "user_tiers": {"share": (100, 1), "avg_generates": (1, 2)},
    "rating": {"like_rate": (100, 1), "avg_like": (1, 1), "avg_dislike": (1, 1)},
    "credit": {
        "feature_credits": (1, 1),
        "total_credits": (1, 1),
        "share": (100, 2),
        "prev_feature_credits": (1, 1),
        "prev_total_credits": (1, 1),
        "prev_share": (100, 2),
    },
    "tts_source": {"share": (100, 1)},
    "voice_ownership": {
        "voice_users_share": (100, 1),
        "avg_voices": (1, 2),
        "prev_voice_users_share": (100, 1),
        "prev_avg_voices": (1, 2),
    },
    "tts_adoption": {"adoption_rate": (100, 1), "feature_usage_rate": (100, 1)},
    "path_tree": {"pct": (1, 1)},
    "template_language": {"click_rate": (100, 1), "save_rate": (100, 1), "save_click_rate": (100, 1)},
    "template_detail": {"save_click_rate": (100, 1), "click_share": (100, 1)},
    "cache_ratio": {"hit_ratio": (100, 1)},
}

# Changes are differences of the rounded numbers shown beside them: (now, before, decimals).
CHANGES = {
    "credit": {"share_delta": ("share", "prev_share", 2)},
    "voice_ownership": {
        "share_delta": ("voice_users_share", "prev_voice_users_share", 1),
        "avg_delta": ("avg_voices", "prev_avg_voices", 2),
    },
}


def presented(section: str, df: DataFrame) -> DataFrame:
    if section not in ROUNDING:
        return df
    df = df.withColumns({
        c: F.round(F.col(c) * float(factor), decimals) for c, (factor, decimals) in ROUNDING[section].items()
    })
    if section not in CHANGES:
        return df
    return df.withColumns({
        c: F.round(F.col(now) - F.col(before), decimals)
        for c, (now, before, decimals) in CHANGES[section].items()
    })


# Columns that name a row, by the role they take in the tidy table.
ROW_NAMES = {
    "period": ("period", "event_date"),
    "tier": ("tier",),
    "item": ("event_name", "language", "template_id", "parent1", "parent2"),
}
TEXTS = ("label", "name", "rank", "depth")


def dashboard_rows(sections: Mapping[str, DataFrame]) -> DataFrame:
    """All sections as (section, period, tier, item, metric, value)."""
    tables = []
    for section, df in sections.items():
        named = {role: [c for c in names if c in df.columns] for role, names in ROW_NAMES.items()}
        if section == "path_tree":
            named["item"] = ["parent1", "parent2", "event_name"]
        taken = {c for names in named.values() for c in names}
        metrics = [c for c in df.columns if c not in taken and c not in TEXTS]
        pairs = ", ".join(f"named_struct('metric', '{m}', 'value', double(`{m}`))" for m in metrics)
        roles = [
            f"concat_ws(' > ', {', '.join(names)}) as {role}" if names else f"cast(null as string) as {role}"
            for role, names in named.items()
        ]
        tables.append(df.selectExpr(f"'{section}' as section", *roles, f"inline(array({pairs}))"))
    rows = tables[0]
    for table in tables[1:]:
        rows = rows.unionByName(table)
    return rows


def document(sections: Mapping[str, DataFrame], updated: datetime) -> DataFrame:
    """One row with the dashboard as JSON text: per section a list of records.

    Sections have as many rows as there are periods, tiers and event names, so a list is small.
    """
    parts = None
    for section, df in sections.items():
        records = F.to_json(F.sort_array(F.collect_list(F.struct(*df.columns))), {"ignoreNullFields": "false"})
        part = df.agg(F.concat(F.lit(f'"{section}":'), records).alias("part"))
        parts = part if parts is None else parts.unionByName(part)
    body = F.array_join(F.sort_array(F.collect_list("part")), ",")
    stamp = updated.strftime("%Y-%m-%d %H:%M:%S")
    return parts.agg(F.concat(F.lit(f'{{"update_time":"{stamp}",'), body, F.lit("}")).alias("document"))


def write_dashboard(sections: Mapping[str, DataFrame], path: str, updated: datetime) -> str:
    """A build of all sections as Parquet and of the document, made from these files, as text, under a folder of its own;
    `path/current` then names that folder. A reader sees the former dashboard or this one, never parts of both, and a
    build that fails leaves the former. Returns the folder; those of earlier builds stay until they are removed."""
    folder = f"{updated:%Y%m%d%H%M%S}-{uuid.uuid4().hex}"
    written = {}
    for section, df in sections.items():
        df.write.parquet(f"{path}/{folder}/{section}")
        written[section] = df.sparkSession.read.schema(df.schema).parquet(f"{path}/{folder}/{section}")
    made = document(written, updated)
    made.write.text(f"{path}/{folder}/document")
    publish(made.sparkSession, f"{path}/current", {"folder": folder, "sections": list(sections), "updated": updated.isoformat()})
    return f"{path}/{folder}"


def read_dashboard(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Sections and document (a row of text) of the last build that was published."""
    current = read_pointer(spark, f"{path}/current")
    if current is None:
        raise FileNotFoundError(f"no dashboard has been published under {path}")
    folder = f"{path}/{current['folder']}"
    document_text = spark.read.text(f"{folder}/document").withColumnRenamed("value", "document")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in current["sections"]}, document_text
