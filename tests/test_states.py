"""States that daily runs extend must give what a pass over all events gives, whatever the runs were."""

import dataclasses
import random
from datetime import date, timedelta

import pytest

from eventloom.functions.pointer import publish, read_pointer
from eventloom.operators import counts, ownership, tiers
from eventloom.sources.events import EventSource
from eventloom.sources.schema import EVENTS
from eventloom.sources.states import counted_context, counted_days
from tests.conftest import AS_OF, event, micros, one, rows, with_as_of

NAMES = ["exposure", "entry_a", "generate", "select", "save", "tts", "upgrade_popup", "x_payment_success", "upgrade_confirm", "page_view"]


def crowd(seed, n=500, first=-30, last=31):
    rng = random.Random(seed)
    made = []
    for _ in range(n):
        name = rng.choice([*NAMES, "save", "save"])
        voice = {"voice_id": f"v{rng.randrange(4)}"} if name == "save" and rng.random() < 0.7 else {}
        made.append(event(rng.choice(["hot"] * 5 + ["a", "b", "c", None]), name, micros(rng.randint(first, last)), **voice))
    return made


def same(got, want):
    assert rows(got, *sorted(want.columns)) == rows(want, *sorted(want.columns))


def full_and_kept(ctx, state):
    same(ownership.voice_ownership(ctx, state=state), ownership.voice_ownership(ctx))
    same(ownership.voice_ownership_delta(ctx, state=state), ownership.voice_ownership_delta(ctx))


@pytest.mark.parametrize("runs", [[0], [3, 1, 0], [40, 20, 0], [9, 8, 7, 7, 0]])
def test_ownership_for_any_split_of_days(spark, context, tmp_path, runs):
    ctx = context(crowd(len(runs)))
    state = ownership.OwnershipState(spark, str(tmp_path / "owned"), keep=15, files=2)
    for back in runs:
        state.extend(with_as_of(ctx, ctx.ago(back)))
    full_and_kept(ctx, state)
    held = state._days().published
    assert held["settled"] == "20240116" and min(held["days"]) == "20240116"


def test_ownership_reads_only_new_days(spark, context, tmp_path):
    ctx = context(crowd(7))
    state = ownership.OwnershipState(spark, str(tmp_path), keep=15, files=1)
    assert len(state.extend(with_as_of(ctx, ctx.ago(1)))) == 15
    assert state.extend(ctx) == [ctx.ago(1)]
    assert state.extend(ctx) == []
    with pytest.raises(ValueError, match="settled"):
        state.saved({"long_ago": ctx.ago(16)})


@pytest.mark.parametrize("late", [2, 14, 25])
def test_a_day_that_comes_late(spark, context, tmp_path, late):
    """25 days ago is settled: then everything is read again."""
    events = crowd(11)
    day = (AS_OF - timedelta(days=late)).strftime("%Y%m%d")
    before, after = context([e for e in events if e[4] != day]), context(events)
    state = ownership.OwnershipState(spark, str(tmp_path), keep=15, files=1)
    state.extend(with_as_of(before, before.ago(1)))
    state.extend(after)
    stale = one(ownership.voice_ownership(after, state=state))
    state.extend(after, again=[AS_OF - timedelta(days=late)])
    full_and_kept(after, state)
    assert stale["total_voices"] <= one(ownership.voice_ownership(after, state=state))["total_voices"]


def test_a_run_that_fails_changes_nothing(spark, context, tmp_path, monkeypatch):
    ctx = context(crowd(3))
    state = ownership.OwnershipState(spark, str(tmp_path), keep=15, files=1)
    state.extend(with_as_of(ctx, ctx.ago(1)))
    held = state._days().published
    monkeypatch.setattr("eventloom.sources.states.exists", lambda *a: 1 / 0)  # after the files, before the list
    with pytest.raises(ZeroDivisionError):
        state.extend(ctx)
    monkeypatch.undo()
    assert state._days().published == held
    full_and_kept(with_as_of(ctx, ctx.ago(1)), state)
    state.extend(ctx)
    full_and_kept(ctx, state)


OPERATORS = (
    counts.funnel_counts, counts.prompt_overlap, counts.save_overlap, counts.completion, counts.payment_conversion, counts.upgrade_popup,
    tiers.user_tiers, tiers.generate_tier_summary, lambda ctx: counts.trend_daily(ctx, tiers.user_tiers(ctx)),
)


def test_counts_per_day_in_place_of_events(spark, context, tmp_path):
    events = crowd(5, first=10)
    daily = [e for e in events if e[4] < "20240127" or e[4] == "20240128"]
    for back in (1, 0):
        today = AS_OF - timedelta(days=back)
        so_far = [[e for e in source if e[4] <= today.strftime("%Y%m%d")] for source in (events, daily)]
        ctx = with_as_of(context(*so_far), today)
        kept = counted_context(ctx, str(tmp_path), files=2)
        for op in OPERATORS:
            same(op(kept), op(ctx))
    with pytest.raises(ValueError, match="parameters"):
        from eventloom.operators.quality import rating_summary

        rating_summary(kept)


def test_a_day_finalised_late_replaces_its_counts(spark, context, tmp_path):
    events = crowd(6, first=15)
    reclassified = [(u, "select" if n == "generate" else n, at, bag, day) for u, n, at, bag, day in events]
    first = context([e for e in events if e[4] < "20240131"], [e for e in reclassified if e[4] < "20240125"])
    counted_context(with_as_of(first, first.ago(1)), str(tmp_path), files=1)
    then = context(events, [e for e in reclassified if e[4] < "20240129"])
    kept = counted_context(then, str(tmp_path), files=1)
    trend = lambda ctx: counts.trend_daily(ctx, tiers.user_tiers(ctx))
    same(trend(kept), trend(then))


def test_only_new_days_are_scanned(spark, context, tmp_path):
    ctx = context(crowd(8))
    states = counted_days(spark, str(tmp_path), files=1)
    assert len(states.extend(ctx.intraday, ctx.ago(14), ctx.as_of)) == 14
    asked = []

    class Watched(EventSource):
        def scan(self, lo=None, hi=None):
            asked.append((lo, hi))
            return super().scan(lo, hi)

    watched = Watched(ctx.intraday.df)
    assert states.extend(watched, ctx.ago(13), date(2024, 2, 1)) == [AS_OF]
    assert states.extend(watched, ctx.ago(13), date(2024, 2, 1), again=[ctx.ago(3)]) == [ctx.ago(3)]
    assert asked == [(AS_OF, date(2024, 2, 1)), (ctx.ago(3), ctx.ago(2))]
    with pytest.raises(ValueError, match="20240101"):
        states.read(date(2024, 1, 1), ctx.as_of)


def test_states_without_any_event(spark, context, tmp_path):
    ctx = context([])
    kept = counted_context(ctx, str(tmp_path / "counts"))
    assert counts.funnel_counts(kept).count() == 0
    state = ownership.OwnershipState(spark, str(tmp_path / "owned"))
    state.extend(ctx)
    full_and_kept(ctx, state)


def test_pointer_is_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "current")
    assert read_pointer(spark, path) is None
    for value in ({"a": 1}, {"b": "é"}):
        publish(spark, path, value)
        assert read_pointer(spark, path) == value
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["current"]
    assert dataclasses.is_dataclass(EventSource) and EVENTS.names[0] == "user_pseudo_id"
