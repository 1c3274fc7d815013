import json
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from eventloom.operators import attribution, counts, ownership, paths, quality, tiers
from eventloom.plans.dashboard import dashboard, dashboard_rows, document, presented, read_dashboard, write_dashboard
from eventloom.sources.events import EventSource, unified
from eventloom.vocab import EVENT_LABELS, GA4_ROLES, TEMPLATE_LANG
from fixture_bindings import fx_context
from tests.conftest import SF, one, rows


@pytest.fixture(scope="module")
def sections(spark):
    return dashboard(fx_context(spark, SF), entry.TABLES)


def test_document_is_json_with_every_section(sections):
    text = one(document(sections, datetime(2024, 1, 31, 16, 0)))["document"]
    doc = json.loads(text)
    assert doc.pop("update_time") == "2024-01-31 16:00:00"
    assert set(doc) == set(sections)
    assert {tuple(sorted(r)) for r in doc["user_tiers"]} == {
        ("avg_generates", "share", "tier", "total_users", "users")}
    assert sum(r["users"] for r in doc["user_tiers"]) == doc["user_tiers"][0]["total_users"]
    assert len(doc["completion"]) == 15


def test_sections_are_written(spark, sections, tmp_path):
    few = {name: sections[name] for name in ("user_tiers", "completion")}
    path = str(tmp_path / "board")
    write_dashboard(few, path, datetime(2024, 1, 31))
    read, text = read_dashboard(spark, path)
    assert list(read) == list(few) and read["completion"].count() == 15
    written = json.loads(one(text)["document"])
    assert set(written) == {"update_time", "user_tiers", "completion"}


def test_a_build_that_fails_leaves_the_former_dashboard(spark, sections, tmp_path):
    path = str(tmp_path / "board")
    with pytest.raises(FileNotFoundError):
        read_dashboard(spark, path)
    small = lambda n: {"first": spark.range(n).toDF("n"), "second": spark.range(n).toDF("n")}
    write_dashboard(small(3), path, datetime(2024, 1, 30))
    before, _ = read_dashboard(spark, path)
    broken = {"first": spark.range(5).toDF("n"), "second": spark.range(5).select(F.raise_error(F.lit("half-way")).alias("n"))}
    with pytest.raises(Exception, match="half-way"):
        write_dashboard(broken, path, datetime(2024, 1, 31))
    read, text = read_dashboard(spark, path)
    assert [df.count() for df in read.values()] == [3, 3] and json.loads(one(text)["document"])["update_time"].startswith("2024-01-30")
    write_dashboard(small(4), path, datetime(2024, 2, 1))
    assert [df.count() for df in read_dashboard(spark, path)[0].values()] == [4, 4]
    assert [df.count() for df in before.values()] == [3, 3]  # who has begun to read the former goes on with it


def test_sections_equal_single_operators(spark, sections):
    ctx = fx_context(spark, SF)
    trend = counts.trend_daily(ctx, tiers.user_tiers(ctx))
    templates = attribution.template_funnel(ctx)
    flow = paths.path_counts(paths.path_steps(ctx, within=entry.PATH_WITHIN))
    for name, op in {
        "funnel": counts.funnel_counts(ctx),
        "prompt_overlap": counts.prompt_overlap(ctx),
        "save_overlap": counts.save_overlap(ctx),
        "payment": counts.payment_conversion(ctx),
        "upgrade": counts.upgrade_popup(ctx),
        "rating": quality.rating_summary(ctx),
        "credit": quality.credit_share(ctx),
        "tts_source": counts.tts_source_share(ctx),
        "trend": trend,
        "entry_composite": counts.composite(trend, ctx.roles.entries),
        "tts_adoption": attribution.tts_adoption(ctx, within=entry.WITHIN),
        "exposure_totals": paths.exposure_totals(ctx),
        "path_tree": paths.path_tree(flow, dict(entry.TABLES.labels)),
        "template_language": attribution.template_language(templates, entry.FX_TEMPLATES),
        "cache_ratio": quality.cache_ratio(ctx),
    }.items():
        shown = presented(name, op)
        assert rows(sections[name], *sorted(shown.columns)) == rows(shown, *sorted(shown.columns)), name


class Watched(EventSource):
    """Notes which days are scanned."""

    asked: list = []

    def scan(self, lo=None, hi=None):
        self.asked.append((self.df.columns and id(self.df), lo, hi))
        return super().scan(lo, hi)


def test_each_source_is_scanned_once(spark, tmp_path):
    fx = fx_context(spark, SF)
    ctx = replace(fx, **{n: Watched(getattr(fx, n).df, getattr(fx, n).between) for n in ("intraday", "daily")})
    state = ownership.OwnershipState(spark, str(tmp_path / "owned"), files=1)
    state.extend(fx)
    Watched.asked.clear()
    ctx = replace(ctx, daily=ctx.daily.pin(ctx.ago(30), ctx.as_of))
    Watched.asked.clear()  # without folders by day, listing the finalised days is a job of its own
    made = dashboard(ctx, entry.TABLES, owned=state)
    for df in made.values():
        df.collect()
    assert sorted(source for source, *_ in Watched.asked) == sorted({id(ctx.intraday.df), id(ctx.daily.df)})
    plans = {name: df._jdf.queryExecution().executedPlan().toString() for name, df in made.items()}
    assert [name for name, text in plans.items() if "events.parquet" in text] == []
    whole = dashboard(fx, entry.TABLES)
    for name in made:
        assert rows(made[name], *sorted(made[name].columns)) == rows(whole[name], *sorted(whole[name].columns)), name


def test_rows_hold_every_number(sections):
    tidy = dashboard_rows({"funnel": sections["funnel"]})
    assert tidy.count() == 2 * sections["funnel"].count()


def test_tiers_do_not_exceed_everybody(spark):
    funnel = counts.funnel_counts(fx_context(spark, SF))
    everyone = F.sum(F.when(F.col("tier") == "all", F.col("event_count")).otherwise(0))
    in_tiers = F.sum(F.when(F.col("tier") != "all", F.col("event_count")).otherwise(0))
    bad = funnel.groupBy("period", "event_name").agg((everyone < in_tiers).alias("bad")).filter("bad")
    assert bad.count() == 0


def test_tree_levels_add_up(spark):
    ctx = fx_context(spark, SF)
    counted = paths.path_counts(paths.path_steps(ctx, within=entry.PATH_WITHIN))
    tree = paths.path_tree(counted).collect()
    total = counted.agg(F.sum("user_count")).collect()[0][0]
    assert sum(r["user_count"] for r in tree if r["depth"] == 1) == total
    top = next(r for r in tree if r["depth"] == 1 and r["rank"] == 1)
    reached = counted.filter((F.col("step1") == top["event_name"]) & F.col("step2").isNotNull())
    assert sum(r["user_count"] for r in tree if r["depth"] == 2) == (reached.agg(F.sum("user_count")).collect()[0][0] or 0)


def test_no_day_comes_from_both_sources(spark):
    ctx = fx_context(spark, SF)
    both = unified(ctx.daily, ctx.intraday, ctx.ago(30), ctx.as_of)
    assert both.count() == ctx.intraday.scan(ctx.ago(30), ctx.as_of).count()


def test_tier_shares_add_up(spark):
    stats = tiers.tier_stats(tiers.user_tiers(fx_context(spark, SF)))
    assert abs(stats.agg(F.sum("share")).collect()[0][0] - 1) < 1e-12


def test_fixed_values_are_complete():
    assert len(EVENT_LABELS) == 36
    assert len(TEMPLATE_LANG) == 32
    assert len(GA4_ROLES.funnel) == 8 and len(GA4_ROLES.trend) == 6 and len(GA4_ROLES.path_excluded) == 10
