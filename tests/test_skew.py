"""Hot keys: cutting keys into slices of time must not change any result."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom.functions.cut import cut
from eventloom.functions.skew import running
from eventloom.operators import attribution, paths
from fixture_bindings import fx_context
from tests.conftest import SECOND, SF, context, event, micros, rows  # noqa: F401

DAY = 86_400 * SECOND


def crowd(seed):
    """Random events, most of them of one user, many at equal times and across second boundaries."""
    rng = random.Random(seed)
    names = ["save", "tts", "template_click", "exposure", "prompt_click", "page_view"]
    made = []
    for _ in range(600):
        user = rng.choice(["hot"] * 6 + ["a", "b", None])
        at = micros(28) + rng.randrange(0, 40) * 250_000
        name = rng.choice(names)
        extra = {"ga_session_id": rng.choice([1, 1, 1, 2])}
        if name == "template_click" and rng.random() < 0.9:
            extra["templateId"] = rng.choice(["t1", "t2", "t3"])
        if name == "tts":
            extra["from_"] = rng.choice(["/voice/design", "/voice/tts"])
        made.append(event(user, name, at, **extra))
    return made


def value(row, key, slot):
    return next((v[slot] for k, v in row[3] if k == key), None)


@pytest.mark.parametrize("slice_micros", [250_000, SECOND, 3600 * SECOND])
@pytest.mark.parametrize("seed", [1, 2])
def test_interval_pairs_equal_brute_force(context, seed, slice_micros):  # noqa: F811
    events = crowd(seed)
    within = 3 * SECOND
    saves = [e for e in events if e[1] == "save" and e[0]]
    speech = [e for e in events if e[1] == "tts" and e[0]]
    expected = {}
    for s in saves:
        mine = [t for t in speech if t[0] == s[0] and s[2] <= t[2] <= s[2] + within]
        n, pairs, own = expected.get((s[0], s[2]), (0, 0, 0))
        design = sum(value(t, "from", 0) == "/voice/design" for t in mine)
        expected[s[0], s[2]] = (n + 1, pairs + len(mine), own + design)
    got = attribution.interval_pairs(context(events), within=within, slice_micros=slice_micros)
    found = {(r["user_pseudo_id"], r["save_ts"]): (r["saves"], r["pairs"], r["feature_pairs"]) for r in got.collect()}
    assert found == expected


@pytest.mark.parametrize("slice_micros", [250_000, SECOND, 3600 * SECOND])
@pytest.mark.parametrize("seed", [3, 4])
def test_attribution_equals_brute_force(context, seed, slice_micros):  # noqa: F811
    events = crowd(seed)
    expected = {}
    for s in events:
        session = value(s, "ga_session_id", 1)
        if s[1] != "save" or s[0] is None:
            continue
        clicks = [
            (c[2], value(c, "templateId", 0) or "")
            for c in events
            if c[1] == "template_click" and c[0] == s[0] and value(c, "ga_session_id", 1) == session and c[2] <= s[2]
        ]
        if clicks:
            at, template = max(clicks)
            expected[s[0], session, s[2]] = (at, template or None)
    got = attribution.template_attribution(context(events), slice_micros=slice_micros).collect()
    assert len(got) == len(expected)
    assert {
        (r["user_pseudo_id"], r["session_id"], r["save_ts"]): (r["click_ts"], r["template_id"]) for r in got
    } == expected


@pytest.mark.parametrize("within", [5, 2])
def test_paths_equal_brute_force(context, within):  # noqa: F811
    events = crowd(5)
    first = {}
    for e in events:
        if e[1] == "exposure" and e[0]:
            first[e[0]] = min(e[2], first.get(e[0], e[2]))
    expected = []
    for user, at in first.items():
        later = sorted(
            (e[2], e[1])
            for e in events
            if e[0] == user and at + SECOND < e[2] <= at + within * SECOND and e[1] not in ("exposure", "page_view")
        )
        expected += [(user, i + 1, name, when) for i, (when, name) in enumerate(later[:3])]
    got = paths.path_steps(context(events), within=within * SECOND)
    assert rows(got, "user_pseudo_id", "step", "event_name", "event_timestamp") == sorted(expected)


def test_table_results_do_not_depend_on_the_slices(spark):
    ctx = fx_context(spark, SF)
    for op in (
        lambda n: attribution.interval_pairs(ctx, 30, DAY, slice_micros=n),
        lambda n: attribution.template_attribution(ctx, 30, slice_micros=n),
    ):
        plain = op(60 * SECOND)
        assert rows(plain, *plain.columns) == rows(op(DAY), *plain.columns)


def test_running_takes_any_associative_fold(spark):
    df = spark.range(200).selectExpr("id % 2 k", "id * 400000 at", "cast(id * 7 % 31 as long) v")
    got = running(df, ["k"], "at", ["at"], ["v"], F.max, lambda a, b: F.greatest(a, b), slice_micros=3_000_000)
    best = {0: -1, 1: -1}
    for r in sorted(got.collect(), key=lambda r: r["at"]):
        best[r["k"]] = max(best[r["k"]], r["v"])
        assert r["running_v"] == best[r["k"]]


def test_cut_keeps_rows_and_forgets_the_plan(spark):
    df = spark.range(10).groupBy((F.col("id") % 3).alias("k")).count()
    kept = cut(df)
    assert rows(kept, "k", "count") == rows(df, "k", "count")
    assert "Aggregate" not in kept._jdf.queryExecution().executedPlan().toString()
