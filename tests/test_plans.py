"""What the physical plans must and must not hold, on tables laid out by day."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from eventloom.context import Ctx
from eventloom.operators import attribution, counts, paths, tiers
from eventloom.sources.events import read_events, table_events, unified
from eventloom.sources.schema import EVENTS
from fixture_bindings import AS_OF, FX_ROLES, FX_TIERS, fx_context
from tests.conftest import SF, rows

DAY = 86_400_000_000


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def laid_out(spark, tmp_path_factory):
    """The fixture context over Parquet partitioned by day, as in production."""
    folder = tmp_path_factory.mktemp("events")
    fx = fx_context(spark, SF)
    for name, source in (("daily", fx.daily), ("intraday", fx.intraday)):
        source.scan(date(2024, 1, 1), date(2024, 3, 1)).repartition(2, "event_date").write.partitionBy(
            "event_date"
        ).parquet(f"{folder}/{name}")
    daily, intraday = (read_events(spark, f"{folder}/{n}") for n in ("daily", "intraday"))
    return Ctx(intraday, daily, AS_OF, FX_ROLES, FX_TIERS)


def test_partitioned_tables_give_the_same_results(spark, laid_out):
    fx = fx_context(spark, SF)
    for op in (
        counts.funnel_counts,
        lambda ctx: counts.trend_daily(ctx, tiers.user_tiers(ctx)),
        lambda ctx: attribution.template_funnel(ctx, 30),
        lambda ctx: paths.path_steps(ctx, within=3 * DAY),
    ):
        here, there = op(laid_out), op(fx)
        assert rows(here, *sorted(here.columns)) == rows(there, *sorted(here.columns))


def test_funnel_reads_once_and_only_what_it_needs(laid_out):
    text = plan(counts.funnel_counts(laid_out))
    assert text.count("FileScan") == 1
    assert re.search(r"PartitionFilters: \[[^\]]*event_date[^\]]*>= 20240117", text)
    assert "PushedFilters: [In(event_name" in text
    assert "ReadSchema: struct<user_pseudo_id:string,event_name:string>" in text
    assert "Join" not in text and "Expand" not in text


def test_finalised_days_prune_intraday(spark, tmp_path):
    save = "select 'u' user_pseudo_id, 'save' event_name, 1L event_timestamp, null event_params, '{}' event_date"
    for name, day in (("daily", "20240127"), ("intraday", "20240130")):
        row = spark.sql(save.format(day)).select([F.col(f.name).cast(f.dataType) for f in EVENTS])
        row.write.partitionBy("event_date").parquet(str(tmp_path / name))
    unreadable = tmp_path / "intraday" / "event_date=20240127"
    unreadable.mkdir()
    (unreadable / "part-0.parquet").write_bytes(b"not a parquet file")
    daily, intraday = (read_events(spark, str(tmp_path / n)) for n in ("daily", "intraday"))
    events = unified(daily, intraday, date(2024, 1, 17), AS_OF).filter("event_name = 'save'")
    text = plan(events)
    assert text.count("EqualTo(event_name,save)") == 2 and "Join" not in text
    assert rows(events, "event_date") == [("20240127",), ("20240130",)]  # the unreadable day was never opened


def test_partition_days_can_come_from_the_catalog(spark, laid_out):
    laid_out.daily.df.write.partitionBy("event_date").mode("overwrite").saveAsTable("daily_events")
    try:
        source = table_events(spark, "daily_events")
        days = source.days(date(2024, 1, 20), date(2024, 1, 23))
        assert rows(days, "event_date") == [("20240120",), ("20240121",), ("20240122",)]
        assert "ReadSchema: struct<>" in plan(days)
    finally:
        spark.sql("drop table daily_events")


def test_running_operators_scan_each_source_once(laid_out):
    for op in (
        lambda: attribution.interval_pairs(laid_out, 30, DAY),
        lambda: attribution.tts_adoption(laid_out, 30, DAY),
        lambda: attribution.template_attribution(laid_out, 30),
        lambda: attribution.template_funnel(laid_out, 30),
    ):
        text = final_plan(op())
        scans = [line for line in text.splitlines() if "FileScan" in line and "event_timestamp" in line]
        assert len(scans) == 2, text  # finalised and intraday


def test_paths_take_one_scan_and_no_join(laid_out):
    steps = paths.path_steps(laid_out, within=3 * DAY)
    text = plan(steps)
    assert text.count("FileScan") == 2 and "Join" not in text and "Union" in text  # finalised and intraday
    assert "WindowGroupLimit" in text
    text = plan(paths.path_tree(paths.path_counts(steps)))
    assert text.count("FileScan") == 2 and text.count("Join") == 1  # the labels
    assert "BroadcastHashJoin" in text


def test_template_totals_are_no_subqueries(laid_out):
    assert "Subquery" not in plan(attribution.template_funnel(laid_out, 30))


def test_the_bag_is_read_once(spark):
    text = plan(entry.event_param_extract(spark, SF))
    assert text.count("aggregate(event_params") == 1 and "filter(event_params" not in text


def jobs_of(spark, build):
    """Data jobs that run while `build` makes its DataFrame."""
    group = f"probe-{id(build)}"
    spark.sparkContext.setJobGroup(group, "building")
    try:
        build()
        return list(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_a_query_runs_no_job(spark, laid_out):
    """Which days are finalised comes from folders and file footers."""
    for op in (lambda: paths.path_steps(laid_out), lambda: attribution.template_funnel(laid_out, 30), lambda: counts.trend_daily(laid_out, tiers.user_tiers(laid_out))):
        assert jobs_of(spark, op) == []
    days = [r["event_date"] for r in laid_out.daily.days(date(2024, 1, 10), date(2024, 2, 3)).collect()]
    assert laid_out.daily.listed_days(date(2024, 1, 10), date(2024, 2, 3)) == frozenset(days) and len(days) > 10


def test_a_listed_day_holds_a_row(spark, tmp_path):
    row = spark.sql("select 'u' user_pseudo_id, 'save' event_name, 1L event_timestamp, null event_params, '20240110' event_date")
    row = row.select([F.col(f.name).cast(f.dataType) for f in EVENTS])
    row.write.partitionBy("event_date").parquet(str(tmp_path / "t"))
    row.drop("event_date").filter("false").write.parquet(str(tmp_path / "t" / "event_date=20240111"))  # a file without rows
    (tmp_path / "t" / "event_date=20240112").mkdir()  # a folder without files
    source = read_events(spark, str(tmp_path / "t"))
    assert source.listed_days(date(2024, 1, 1), date(2024, 2, 1)) == {"20240110"}
    assert read_events(spark, str(tmp_path / "t" / "event_date=20240110")).listed_days(date(2024, 1, 1), date(2024, 2, 1)) == frozenset()


def test_listed_days_of_a_catalog_table(spark, laid_out):
    laid_out.daily.df.write.partitionBy("event_date").mode("overwrite").saveAsTable("daily_listed")
    try:
        spark.sql("alter table daily_listed add partition (event_date = '20240131')")
        source = table_events(spark, "daily_listed")
        assert jobs_of(spark, lambda: source.listed_days(date(2024, 1, 20), date(2024, 2, 3))) == []
        found = [r["event_date"] for r in source.days(date(2024, 1, 20), date(2024, 2, 3)).collect()]
        assert source.listed_days(date(2024, 1, 20), date(2024, 2, 3)) == frozenset(found)
    finally:
        spark.sql("drop table daily_listed")


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if not re.match(r"dashboard_|op\d+_|pipeline$", n)))
def test_no_python_and_no_products(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for unwanted in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text


def test_timestamp_bounds_reach_the_given_table(spark):
    text = plan(counts.funnel_counts(fx_context(spark, SF)))
    assert "GreaterThanOrEqual(ts,2024-01-17T00:00)" in text and "LessThan(ts,2024-01-31T00:00)" in text
    assert "value" not in text.split("ReadSchema")[1]
