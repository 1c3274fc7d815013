"""Boundary rows whose outcome the definitions fix."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from eventloom.context import Period
from eventloom.functions.params import int_param, number_param, string_param
from eventloom.operators import attribution, counts, ownership, paths, quality, report, tags, tiers
from eventloom.sources.events import unified
from eventloom.sources.schema import EVENTS
from tests.conftest import MINUTE, SECOND, event, micros, one, rows, with_as_of


def generates(user, per_day):
    return [event(user, "generate", micros(day, us=i)) for day, n in per_day.items() for i in range(n)]


def test_tier_boundaries(context):
    ctx = context(
        [event(u, "exposure", micros(20)) for u in ("four", "half", "between", "idle")]
        + generates("four", {20: 3, 21: 5})
        + generates("half", {20: 1, 21: 2})
        + generates("between", {20: 2})
        + generates("unexposed", {20: 9})
    )
    assert rows(tiers.user_tiers(ctx), "user_pseudo_id", "avg_daily_generates", "tier") == [
        ("between", 2.0, "mid"),
        ("four", 4.0, "high"),
        ("half", 1.5, "low"),
        ("idle", 0.0, "none"),
    ]
    seen = {(r["tier"], r["event_count"], r["unique_users"]) for r in counts.event_counts(
        ctx, ["generate"], [Period("all_days", date(2024, 1, 1), None)]).collect()}
    assert seen == {("all", 22, 4), ("high", 8, 1), ("mid", 2, 1), ("low", 3, 1)}
    summary = {r["tier"]: (r["users"], r["generates"], r["days"]) for r in tiers.generate_tier_summary(ctx).collect()}
    assert summary == {"high": (2, 17, 3), "mid": (1, 2, 1), "low": (1, 3, 2)}


def test_generate_tiers_are_zero_filled(context):
    summary = tiers.generate_tier_summary(context(generates("u", {20: 1})))
    assert [r["tier"] for r in summary.collect()] == ["high", "mid", "low"]
    assert rows(summary.filter("users = 0"), "tier", "avg", "share") == [("high", 0.0, 0.0), ("mid", 0.0, 0.0)]


def test_tier_window_longer_than_one_mask(context):
    from eventloom.context import TierRule

    spread = [event("u", "exposure", micros(30))] + [event("u", "generate", micros(day)) for day in range(-60, 31)]
    ctx = context(spread, rule=TierRule(days=100, high=4, mid=1.5))
    profile = tiers.user_profile(ctx).collect()[0]
    assert (profile["generates"], profile["active_days"]) == (91, 91)


def test_missing_user_is_a_set_member_but_no_distinct_user(context):
    ctx = context([event(None, "generate", micros(30)), event(None, "exposure", micros(30)),
                   event(None, "prompt_click", micros(30)), event("u", "generate", micros(30))])
    funnel = {(r["event_name"], r["tier"]): (r["event_count"], r["unique_users"])
              for r in counts.funnel_counts(ctx).filter("period = 'yesterday'").collect()}
    assert funnel == {("generate", "all"): (2, 1), ("exposure", "all"): (1, 0)}
    overlap = one(counts.prompt_overlap(ctx).filter("period = 'yesterday' and tier = 'all'"))
    assert (overlap["generate_users"], overlap["prompt_users"], overlap["generate_with_prompt"]) == (2, 1, 0)
    assert rows(tiers.user_tiers(ctx), "user_pseudo_id", "tier") == [(None, "none")]


def test_finalised_day_hides_intraday_even_without_the_wanted_event(context):
    ctx = context(
        intraday=[event("u", "save", micros(28)), event("u", "save", micros(30)), event("u", "save", micros(31))],
        daily=[event("u", "page_view", micros(28))],
    )
    saves = unified(ctx.daily, ctx.intraday, date(2024, 1, 24), ctx.as_of).filter("event_name = 'save'")
    assert rows(saves, "event_date") == [("20240130",), ("20240131",)]
    bounded = unified(ctx.daily, ctx.intraday, date(2024, 1, 24), ctx.as_of, include_today=False)
    assert rows(bounded, "event_date", "event_name") == [("20240128", "page_view"), ("20240130", "save")]


def test_parameters_by_slot(context, spark):
    ctx = context([
        event("a", "credit_reduce", 1, credits=3, type="tts"),
        event("b", "credit_reduce", 1, credits=2.5),
        event("c", "credit_reduce", 1, credits="1.25"),
        event("d", "credit_reduce", 1, credits="abc"),
        event("e", "credit_reduce", 1),
    ])
    got = ctx.intraday.df.select(
        "user_pseudo_id", number_param("credits").alias("n"), string_param("type").alias("t"), int_param("x").alias("i")
    )
    assert rows(got, "user_pseudo_id", "n", "t", "i") == [
        ("a", 3.0, "tts", None), ("b", 2.5, None, None), ("c", 1.25, None, None),
        ("d", None, None, None), ("e", None, None, None),
    ]


def test_repeated_parameter_takes_the_first(context, spark):
    row = ("u", "rate", 1, [("action", (None, 1, None)), ("action", (None, 2, None))], "20240130")
    assert rows(context([row]).intraday.df.select(int_param("action").alias("a")), "a") == [(1,)]


def test_credit_share_without_credits(context):
    share = one(quality.credit_share(context([event("u", "credit_reduce", micros(30), credits="abc")])))
    assert share["total_credits"] == 0.0 and share["share"] == 0.0 and share["share_delta"] == 0.0


def test_credit_share_windows(context):
    ctx = context([
        event("u", "credit_reduce", micros(30), credits=1, type="voice_design"),
        event("u", "credit_reduce", micros(24), credits=3.0, type="tts"),
        event("u", "credit_reduce", micros(23), credits="8", type="voice_design"),
        event("u", "credit_reduce", micros(31), credits=100, type="voice_design"),
    ])
    share = one(quality.credit_share(ctx))
    assert (share["feature_credits"], share["total_credits"], share["share"]) == (1.0, 4.0, 0.25)
    assert (share["prev_feature_credits"], share["prev_total_credits"], share["prev_share"]) == (8.0, 8.0, 1.0)
    assert share["share_delta"] == -0.75


def test_rating_without_action_is_unknown(context):
    ctx = context([event("u", "rate", micros(30)), event("u", "rate", micros(30), action=7),
                   event("u", "rate", micros(30), action=1), event("v", "rate", micros(30), action=2)])
    everyone = one(quality.rating_summary(ctx).filter("tier = 'all'"))
    assert (everyone["like"], everyone["dislike"], everyone["unknown"], everyone["total"]) == (1, 1, 2, 4)
    assert everyone["like_rate"] == 0.5
    high = one(quality.rating_summary(ctx).filter("tier = 'high'"))
    assert (high["total"], high["like_rate"], high["avg_like"]) == (0, 0.0, 0.0)


@pytest.mark.parametrize("likes, generated, segment", [
    (1, 5, "<=0.2"), (1, 2, ">=0.5"), (1, 3, "(0.2,0.5)"), (0, 1, "<=0.2"), (3, 1, ">=0.5"),
])
def test_like_segment_cuts(context, likes, generated, segment):
    ctx = context(
        [event("u", "rate", micros(30), action=2)]
        + [event("u", "rate", micros(30), action=1)] * likes
        + [event("u", "generate", micros(30))] * generated
        + [event("silent", "generate", micros(30))]
    )
    assert rows(quality.like_segments(ctx), "segment", "user_count", "total_users", "share") == [(segment, 1, 1, 1.0)]


def test_rater_comparison_leaves_out_raters_without_generate(context):
    ctx = context([event("r", "rate", micros(30), action=1), event("x", "rate", micros(30), action=1),
                   event("r", "generate", micros(30)), event("r", "save", micros(30)),
                   event("q", "generate", micros(30)), event("q", "generate", micros(30))])
    got = {r["segment"]: r.asDict() for r in quality.rater_comparison(ctx).collect()}
    assert got["rating_users"]["total_users"] == 1 and got["all_users"]["total_users"] == 2
    assert got["rating_users"]["avg_generated_voices"] == 3.0 and got["rating_users"]["diff_saved_voices"] == 0.5


def test_saves_without_voice_count_one_by_one(context):
    ctx = context(
        [event("u", "save", micros(20))] * 3
        + [event("u", "save", micros(22), voice_id="v")] * 2
        + [event("w", "save", micros(29), voice_id="v"), event("t", "tts", micros(25)), event("t", "tts", micros(26))]
    )
    got = one(ownership.voice_ownership_delta(ctx))
    assert (got["voice_users"], got["total_voices"], got["avg_voices"]) == (2, 5, 2.5)
    assert (got["prev_voice_users"], got["prev_avg_voices"], got["total_users"]) == (1, 4.0, 1)
    assert got["avg_delta"] == -1.5 and got["share_delta"] == 1.0


def test_no_saves_at_all(context):
    got = one(ownership.voice_ownership(context([event("t", "page_view", micros(25))])))
    assert (got["voice_users"], got["total_users"], got["voice_users_share"], got["avg_voices"]) == (0, 0, 0.0, 0.0)
    assert got["total_voices"] == 0


def test_interval_ends_are_inside(context):
    at = micros(28)
    ctx = context(
        [event(u, "save", at) for u in ("now", "edge", "late", "before")]
        + [event("now", "tts", at, from_="/voice/design"), event("edge", "tts", at + 10 * MINUTE),
           event("late", "tts", at + 10 * MINUTE + 1), event("before", "tts", at - 1)]
    )
    got = one(attribution.tts_adoption(ctx))
    assert (got["total_saves"], got["saves_with_tts"], got["saves_with_feature_tts"]) == (4, 2, 1)
    assert (got["tts_pairs"], got["feature_tts_pairs"], got["switch_tts_pairs"]) == (2, 1, 1)


@pytest.mark.parametrize("slice_micros", [1, SECOND, 60 * SECOND])
def test_interval_pairs_multiply_but_saves_are_distinct(context, slice_micros):
    at = micros(28)
    ctx = context([event("u", "save", at)] * 2 + [event("u", "save", at + MINUTE)]
                  + [event("u", "tts", at + MINUTE)] * 3
                  + [event(None, "save", at), event(None, "tts", at)])
    got = one(attribution.tts_adoption(ctx, slice_micros=slice_micros))
    assert (got["total_saves"], got["saves_with_tts"], got["tts_pairs"]) == (4, 2, 9)


def attributed(ctx, **more):
    return rows(attribution.template_attribution(ctx, **more), "user_pseudo_id", "template_id")


@pytest.mark.parametrize("slice_micros", [1, SECOND, 60 * SECOND])
def test_attribution_edges(context, slice_micros):
    at = micros(28)

    def click(user, when, template, session=1):
        extra = {} if template is None else {"templateId": template}
        return event(user, "template_click", when, ga_session_id=session, **extra)

    def save(user, when, session=1):
        return event(user, "save", when, **({} if session is None else {"ga_session_id": session}))

    ctx = context([
        click("same_time", at, "t1"), save("same_time", at),
        click("latest", at - 3 * SECOND, "t1"), click("latest", at - 2 * SECOND, "t2"), save("latest", at),
        click("null_template", at - 3 * SECOND, "t1"), click("null_template", at - 2 * SECOND, None),
        save("null_template", at),
        click("other_session", at - SECOND, "t1", session=2), save("other_session", at),
        click("too_late", at + 1, "t1"), save("too_late", at),
        click("no_session", at - SECOND, "t1"), save("no_session", at, session=None),
        click(None, at - SECOND, "t1"), save(None, at),
        click("twice", at - SECOND, "t3"), save("twice", at), save("twice", at),
    ])
    assert attributed(ctx, slice_micros=slice_micros) == [
        ("latest", "t2"), ("null_template", None), ("same_time", "t1"), ("twice", "t3"),
    ]
    funnel = {r["template_id"]: (r["clicks"], r["click_users"], r["saves"], r["total_saves"])
              for r in attribution.template_funnel(ctx, slice_micros=slice_micros).collect()}
    assert funnel == {"t1": (7, 6, 1, 9), "t2": (1, 1, 1, 9), "t3": (1, 1, 1, 9), None: (1, 1, 0, 9)}


def test_template_languages(context):
    ctx = context([event("u", "template_click", micros(28), templateId="p_a", ga_session_id=1),
                   event("u", "template_click", micros(28), templateId="unknown", ga_session_id=1),
                   event("u", "exposure", micros(28))])
    funnel = attribution.template_funnel(ctx)
    known = {"p_a": "zh"}
    assert rows(attribution.template_language(funnel, known), "language", "clicks", "click_rate") == [
        ("en", 0, 0.0), ("ja", 0, 0.0), ("zh", 1, 1.0)]
    assert rows(attribution.template_detail(funnel, known, "p_"), "template_id", "name", "click_share") == [
        ("p_a", "a", 1.0)]
    nothing = attribution.template_funnel(context([event("u", "exposure", micros(28))]))
    assert attribution.template_language(nothing, known).count() == 0


def test_path_band_and_exclusions(context):
    at = micros(28)
    ctx = context([
        event("u", "exposure", at),
        event("u", "tts", at + SECOND),
        event("u", "page_view", at + 2 * SECOND),
        event("u", "exposure", at + 2 * SECOND),
        event("u", "other_bounce", at + 3 * SECOND),
        event("u", "page_bounce", at + 4 * SECOND),
        event("u", "prompt_click", at + 5 * SECOND),
        event("u", "credit_reduce", at + 5 * SECOND),
        event("u", "save", at + 30 * MINUTE),
        event("late", "exposure", at), event("late", "tts", at + 30 * MINUTE), event("late", "save", at + 30 * MINUTE + 1),
        event("maker", "exposure", at), event("maker", "generate", at + 9 * MINUTE), event("maker", "tts", at + MINUTE),
        event(None, "exposure", at), event(None, "tts", at + MINUTE),
    ])
    steps = paths.path_steps(ctx)
    assert rows(steps, "user_pseudo_id", "step", "event_name") == [
        ("late", 1, "tts"), ("u", 1, "page_bounce"), ("u", 2, "credit_reduce"), ("u", 3, "prompt_click")]
    assert rows(paths.path_counts(steps), "step1", "step2", "step3", "user_count") == [
        ("page_bounce", "credit_reduce", "prompt_click", 1), ("tts", None, None, 1)]
    assert rows(paths.non_converters(ctx), "user_pseudo_id") == [(None,), ("late",), ("u",)]
    assert one(paths.exposure_totals(ctx)) == {"total_exposed": 3, "total_generated": 1, "non_generated": 2}


def test_exposure_totals_may_be_negative(context):
    ctx = context([event("a", "generate", micros(28)), event("b", "generate", micros(28)), event("a", "exposure", micros(28))])
    assert one(paths.exposure_totals(ctx))["non_generated"] == -1


def test_topk_folds_small_items_at_the_rounded_share(spark):
    counts_df = spark.createDataFrame(
        [("g", "a", 900), ("g", "b", 50), ("g", "c", 50), ("h", "a", 9005), ("h", "b", 495), ("h", "c", 500),
         ("i", "only", 4)],
        "g string, item string, n long",
    )
    got = paths.topk_with_others(counts_df, ["g"], "item", "n", k=3, min_pct=5.0)
    assert rows(got, "g", "rank", "item", "n") == [
        ("g", 1, "a", 900), ("g", 2, "b", 50), ("g", 3, "c", 50),
        ("h", 1, "a", 9005), ("h", 2, "c", 500), ("h", 3, "b", 495),
        ("i", 1, "only", 4)]  # 495 / 10000 is 4.95 %, shown as 5.0 %
    strict = paths.topk_with_others(counts_df, ["g"], "item", "n", k=1)
    assert rows(strict.filter("item = 'others'"), "g", "n") == [("g", 100), ("h", 995)]


def test_topk_of_everything_with_many_items(spark):
    many = spark.range(5000).selectExpr("concat('i', id) item", "id n")
    got = paths.topk_with_others(many, [], "item", "n", k=3)
    assert rows(got, "rank", "item", "n") == [
        (1, "i4999", 4999), (2, "i4998", 4998), (3, "i4997", 4997), (4, "others", 4999 * 5000 // 2 - 4999 - 4998 - 4997)]


def test_path_tree_of_nothing(spark):
    nothing = spark.createDataFrame([], "step1 string, step2 string, step3 string, user_count long")
    assert paths.path_tree(nothing).count() == 0


def test_path_tree_percentages_are_of_users_getting_that_far(spark):
    counted = spark.createDataFrame(
        [("a", None, None, 5), ("a", "x", None, 2), ("a", "x", "p", 6), ("a", "y", "p", 2), ("b", "x", "q", 3)],
        "step1 string, step2 string, step3 string, user_count long",
    )
    tree = paths.path_tree(counted, {"a": "A"}, others_label="rest")
    assert rows(tree, "depth", "parent1", "parent2", "rank", "event_name", "label", "user_count", "pct") == [
        (1, None, None, 1, "a", "A", 15, 15 / 18 * 100), (1, None, None, 2, "others", "rest", 3, 3 / 18 * 100),
        (2, "a", None, 1, "x", "x", 8, 80.0), (2, "a", None, 2, "y", "y", 2, 20.0),
        (3, "a", "x", 1, "p", "p", 6, 100.0), (3, "a", "y", 1, "p", "p", 2, 100.0)]


def test_report_texts(context):
    today, before = micros(30), micros(29)
    ctx = context(
        [event("u", "exposure", today)] * 1234 + [event("u", "exposure", before)] * 1000
        + [event("u", "entry_a", today)] * 2 + [event("u", "entry_b", today), event("u", "entry_a", before)] * 1
        + [event("u", "select", before)] + [event("u", "save", today)] * 5
    )
    got = {r["step"]: (r["count_text"], r["change"], r["conversion"]) for r in report.daily_report(ctx).collect()}
    assert got == {
        "exposure": ("1,234", "+23.4%", None),
        "entry": ("3", "+200.0%", "0.2%"),
        "generate": ("0", "-", "0.0%"),
        "select_voice": ("0", "-100.0%", "-"),
        "save": ("5", "NEW", "-"),
        "overall_all": ("1,234", None, "0.4%"),
        "overall_history": ("0", None, "-"),
    }


def test_unchanged_step_says_so(context):
    ctx = context([event("u", "save", micros(30)), event("u", "save", micros(29))])
    assert one(report.daily_report(ctx).filter("step = 'save'"))["change"] == "0%"


def test_history_includes_the_day_itself(context):
    ctx = context([event("u", "generate", micros(30)), event("u", "save", micros(30)), event("v", "save", micros(30))])
    assert one(report.history_funnel(ctx, ctx.ago(1)))["save"] == 1
    assert one(report.daily_funnel(ctx, ctx.ago(1)))["save"] == 2


def test_upgrade_window_is_open_ended(context):
    ctx = context([event("u", "upgrade_popup", micros(31)), event("u", "upgrade_popup", micros(23))])
    assert rows(counts.upgrade_popup(ctx), "event_name", "tier", "event_count") == [("upgrade_popup", "all", 1)]


def test_payment_is_found_by_substring(context):
    ctx = context([event("u", "xx_payment_success_yy", micros(30)), event("u", "paymentXsuccess", micros(30)),
                   event("v", "payment_failed", micros(30)), event("u", "upgrade_confirm", micros(30))])
    got = one(counts.payment_conversion(ctx).filter("period = 'yesterday'"))
    assert (got["upgrade_users"], got["payment_users"], got["upgrade_to_payment"]) == (1, 1, 1)


def test_entry_composite_counts_users_twice_and_keeps_empty_days(context):
    ctx = context([event("u", "entry_a", micros(30)), event("u", "entry_b", micros(30)), event("u", "save", micros(31))])
    composite = counts.composite(counts.trend_daily(ctx, tiers.user_tiers(ctx)), ctx.roles.entries)
    assert rows(composite, "event_date", "tier", "event_count", "unique_users") == [
        ("20240130", "all", 2, 2), ("20240131", "all", 0, 0)]


def test_periods_are_half_open(context):
    ctx = context([event("u", "save", micros(d)) for d in (23, 24, 27, 28, 29, 30, 31)])
    got = {r["period"]: r["event_count"] for r in counts.funnel_counts(ctx).filter("tier = 'all'").collect()}
    assert got == {"yesterday": 1, "last_3d": 3, "last_7d": 5}
    earlier = with_as_of(ctx, date(2024, 1, 24))
    assert {r["period"] for r in counts.funnel_counts(earlier).filter("tier = 'all'").collect()} == {
        "yesterday", "last_3d", "last_7d"}


def test_tags(spark):
    products = spark.createDataFrame(
        [
            (1, "[😨 #Fear:7]: a [😨 #Fear:1]: b", True),
            (1, "[😨 #Fear:7]: same product again", False),
            (2, "[surprise#Fear:2;Anger:3;Fear:1]: a", None),
            (3, "[custom#Fear:2]: a [😨 #Envy:2]: b", True),
            (4, "Fear # nothing [Fear:7]:", True),
            (5, "[proud#Happy:x;Anger]: broken weights", False),
        ],
        "gen_product_id long, target_text string, is_downloaded boolean",
    )
    usage = tags.tag_usage(products)
    assert rows(usage, "kind", "tag", "usage", "downloaded") == [
        ("emoji", "Fear", 1, 1), ("text", "proud", 1, 0), ("text", "surprise", 1, 0)]
    assert rows(tags.tag_weights(products), "tag", "emotion", "occurrences", "weight", "share") == [
        ("proud", "Anger", 0, 0.0, 0.0), ("proud", "Happy", 0, 0.0, 0.0),
        ("surprise", "Anger", 1, 3.0, 0.5), ("surprise", "Fear", 2, 3.0, 0.5)]
    assert rows(tags.tag_weights(products).filter("tag = 'proud'"), "unreadable") == [(1,), (1,)]
    mixed = products.selectExpr("gen_product_id", "'[surprise#Fear:2.5;Anger:3]: a' as target_text", "is_downloaded").limit(1)
    assert rows(tags.tag_weights(mixed), "emotion", "weight") == [("Anger", 3.0), ("Fear", 2.5)]


def test_rate_bands(spark):
    usage = spark.createDataFrame(
        [("a", 0.20), ("b", 0.15), ("c", 0.149), ("d", 0.5)], "tag string, download_rate double")
    assert [(r["tag"], r["rate_band"]) for r in tags.tag_ranking(usage).collect()] == [
        ("d", "high"), ("a", "high"), ("b", "mid"), ("c", "low")]


def test_deleted_products_are_left_out(spark):
    from datetime import datetime

    from eventloom.sources.products import live_products

    at = datetime(2024, 1, 2)
    products = spark.createDataFrame(
        [(1, None, at), (2, at, at), (3, None, datetime(2024, 1, 3))],
        "gen_product_id long, deleted_at timestamp, created_at timestamp")
    assert rows(live_products(products, datetime(2024, 1, 1), datetime(2024, 1, 3)), "gen_product_id") == [(1,)]


def test_sums_lose_nothing_and_raise_on_what_is_no_amount(spark):
    from eventloom.functions.numbers import exact_avg, exact_sum

    def total(values, how=exact_sum):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(how(F.col("v")).alias("s")).first()["s"]

    assert total([4e-7] * 1000) == 4e-4 and total([1e33, 1.0, -1e33]) == 1.0 and total([]) == 0.0 and total([None]) == 0.0
    assert total([0.1] * 10) == 1.0 and total([1 / 3] * 3, exact_avg) == 1 / 3 and total([None], exact_avg) is None
    for bad in (float("nan"), float("inf"), 1e38):
        with pytest.raises(Exception, match="not finite or too large"):
            total([1.0, bad])


def test_report_days_outside_the_history_window(context):
    day = date(2024, 1, 10)
    ctx = context([event("u", "exposure", micros(10)), event("u", "generate", micros(30)), event("v", "exposure", micros(31)), event("u", "save", micros(31))])
    assert one(report.history_funnel(ctx, day))["exposure"] == 1
    today = one(report.history_funnel(ctx, ctx.as_of))
    assert (today["exposure"], today["save"]) == (0, 1)
    short = {r["step"]: r["previous_count"] for r in report.daily_report(
        context([event("u", "exposure", micros(29)), event("u", "exposure", micros(30))]), history_days=1).collect()}
    assert short["exposure"] == 1


def test_a_day_finalised_meanwhile_is_counted_once(spark, tmp_path):
    from eventloom.sources.events import read_events, unified

    def add(name, day):
        spark.createDataFrame([event("u", "save", micros(day))], EVENTS).write.partitionBy("event_date").mode("append").parquet(str(tmp_path / name))

    add("daily", 28), add("intraday", 28), add("intraday", 29)
    lo, hi = date(2024, 1, 28), date(2024, 1, 31)
    daily, intraday = (read_events(spark, str(tmp_path / n)) for n in ("daily", "intraday"))
    before = unified(daily, intraday, lo, hi)
    add("daily", 29)
    assert before.count() == 2
    daily = read_events(spark, str(tmp_path / "daily"))
    assert unified(daily, intraday, lo, hi).count() == 2
    assert unified(daily.pin(lo, hi), intraday, lo, hi).count() == 2


def test_a_partition_without_rows_is_not_finalised(spark):
    from eventloom.sources.events import EventSource, table_events, unified

    row = spark.createDataFrame([event("u", "save", micros(28))], EVENTS)
    row.write.partitionBy("event_date").mode("overwrite").saveAsTable("finalised_events")
    try:
        spark.sql("alter table finalised_events add partition (event_date = '20240129')")
        intraday = EventSource(spark.createDataFrame([event("u", "save", micros(29))], EVENTS))
        assert unified(table_events(spark, "finalised_events"), intraday, date(2024, 1, 28), date(2024, 1, 31)).count() == 2
    finally:
        spark.sql("drop table finalised_events")


def test_several_parameters_from_one_fold(spark):
    from eventloom.functions.params import int_slot, number_slots, text_slot, with_params

    value = lambda s=None, i=None, d=None: (s, i, d)
    bags = [
        [("a", value("x")), ("a", value("later")), ("n", value(i=3))],
        [("a", None), ("a", value("hidden by a first one without value")), ("n", value("4.5"))],
        [("n", value("no number")), (None, value("z"))],
        [("n", value(d=2.5)), ("a", value(i=1))],
        [],
        None,
    ]
    events = spark.createDataFrame([("u", "e", k, bag, "20240101") for k, bag in enumerate(bags)], EVENTS)
    got = with_params(events, ["event_timestamp"], a=("a", text_slot), a_int=("a", int_slot), n=("n", number_slots), none=("absent", text_slot))
    one_by_one = events.select("event_timestamp", string_param("a").alias("a"), int_param("a").alias("a_int"), number_param("n").alias("n"), string_param("absent").alias("none"))
    assert rows(got, *got.columns) == rows(one_by_one, *got.columns)
    assert [r["n"] for r in got.orderBy("event_timestamp").collect()] == [3.0, 4.5, None, 2.5, None, None]
