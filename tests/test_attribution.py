import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from world import TOUCH, at, brute_force, chain, credits_of, deal, timeline, touch

from touchledger.config import MODELS, AttributionConfig
from touchledger.operators import attribution, contracts

# touches, touch the lead moment falls on (None: no lead), W-shaped credit per touch (None: row dropped)
GOLDEN = [
    (1, None, [1.0]),
    (2, None, [.66666667, .33333333]),
    (2, 2, [.33333333, .66666667]),
    (3, 2, [.33333333, .33333333, .33333333]),
    (3, None, [.66666667, None, .33333333]),
    (3, 1, [.66666667, None, .33333333]),
    (3, 3, [.33333333, None, .66666667]),
    (4, None, [.54545455, .09090909, .09090909, .27272727]),
    (4, 2, [.3, .3, .1, .3]),
    (5, 3, [.3, .05, .3, .05, .3]),
    (5, None, [.57142857, .04761905, .04761905, .04761905, .28571429]),
]


def test_w_shaped_golden_vectors(spark):
    deals, touches, leads, expected = [], [], [], {}
    for k, (n, lead, credit) in enumerate(GOLDEN):
        deals.append(deal(k, k, 0))
        touches += [touch(f"{k}-{i}", k, at(i - 20)) for i in range(1, n + 1)]
        if lead:
            leads.append((k, at(lead - 20, 5)))
        expected.update({(k, "w_shaped", f"{k}-{i}"): c for i, c in enumerate(credit, 1) if c is not None})
    fact = chain(spark, deals, touches, leads)[3].filter("model = 'w_shaped'")
    assert credits_of(fact) == pytest.approx(expected, abs=1e-9)


def test_lead_anchor_is_the_last_touch_up_to_the_lead(spark):
    touches = [touch(f"t{i}", 1, at(i - 10)) for i in range(1, 6)]
    late = credits_of(chain(spark, [deal(1, 1, 0)], touches, [(1, at(-1))])[3])
    assert late[(1, "w_shaped", "t5")] == pytest.approx(0.6 / 1.05, abs=1e-8)  # lead after the last touch
    early = credits_of(chain(spark, [deal(1, 1, 0)], touches, [(1, at(-30))])[3])
    assert early[(1, "w_shaped", "t1")] == pytest.approx(0.6 / 1.05, abs=1e-8)  # lead before any touch


def test_last_non_direct_skips_direct_and_other(spark):
    touches = [touch("a", 1, -9, "referral"), touch("b", 1, -8, "direct"), touch("c", 1, -7, "other"),
               touch("d", 2, -9, "direct"), touch("e", 2, -8, "other")]
    got = credits_of(chain(spark, [deal(1, 1, 0), deal(2, 2, 0)], touches)[3].filter("model = 'last_non_direct'"))
    assert got == {(1, "last_non_direct", "a"): 1.0, (2, "last_non_direct", "e"): 1.0}


def test_time_decay_halves_every_half_life(spark):
    touches = [touch("old", 1, -7), touch("new", 1, 0)]
    got = credits_of(chain(spark, [deal(1, 1, 0)], touches)[3].filter("model = 'time_decay'"))
    assert got == pytest.approx({(1, "time_decay", "old"): 1 / 3, (1, "time_decay", "new"): 2 / 3}, abs=1e-8)


def test_deals_without_touches_keep_their_revenue(spark):
    _, anchors, _, fact = chain(spark, [deal(1, 1, 0, "12.34"), deal(2, 2, 0, "5.00", won=False)], [touch("x", 1, 5)])
    rows = fact.collect()
    assert {(r["deal_id"], r["model"]) for r in rows} == {(d, m) for d in (1, 2) for m in MODELS}
    assert {(r["channel"], r["touchpoint_id"], r["touched_at"]) for r in rows} == {("unattributed", None, None)}
    assert {r["credited_won_revenue"] for r in rows} == {12.34, 0.0}
    assert attribution.unattributed(anchors).count() == 10


def test_money_uses_unrounded_credit_and_only_won_deals_earn(spark):
    touches = [touch(f"t{i}", 1, i - 10) for i in range(3)]
    fact = chain(spark, [deal(1, 1, 0, "100.00", won=False)], touches)[3].filter("model = 'linear'").collect()
    assert {r["credit"] for r in fact} == {0.33333333}
    assert all(r["credited_pipeline"] == pytest.approx(100 / 3, abs=1e-12) for r in fact)
    assert {r["credited_won_revenue"] for r in fact} == {0.0}


def test_attribution_ids_and_entry_channels(spark):
    import hashlib

    touches = [touch("a", 1, -9, "referral"), touch("b", 1, -8, "cold_email"), touch("c", 1, -7, "direct"),
               touch("d", 3, -1, "direct")]
    opps, anchors, pairs, fact = chain(spark, [deal(1, 1, 0), deal(2, 9, 0), deal(3, 3, 0)], touches)
    numbered = timeline(spark.createDataFrame(touches, TOUCH))
    ids = {(r["deal_id"], r["model"], r["touchpoint_id"]): r["attribution_id"] for r in fact.collect()}
    assert ids[(1, "linear", "b")] == hashlib.md5(b"1|linear|b").hexdigest()
    assert ids[(2, "linear", None)] == hashlib.md5(b"2|linear|").hexdigest()
    ends = {r["deal_id"]: (r["first_touch_channel"], r["last_non_direct_channel"])
            for r in attribution.fct_opportunities(opps, anchors, numbered).collect()}
    assert ends == {1: ("referral", "cold_email"), 2: ("unattributed", "unattributed"), 3: ("direct", "direct")}
    for model in ("first_touch", "last_non_direct"):
        one = {(r["deal_id"], r["touchpoint_id"], r["channel"], r["credit"])
               for r in attribution.end_touch(anchors, numbered, model).collect()}
        assert one == {(r["deal_id"], r["touchpoint_id"], r["channel"], r["credit"])
                       for r in fact.filter((F.col("model") == model) & F.col("touchpoint_id").isNotNull()).collect()}


def test_single_model_functions_agree_with_the_fact_table(spark):
    touches = [touch(f"t{i}", 1, i - 20, ("direct", "referral")[i % 2]) for i in range(7)]
    _, _, pairs, fact = chain(spark, [deal(1, 1, 0)], touches, [(1, at(-16))])
    whole = credits_of(fact)
    for model in MODELS:
        one = attribution.attribute(pairs, model)
        got = {(r["deal_id"], model, r["touchpoint_id"]): r["credit"] for r in one.collect()}
        assert got == pytest.approx({k: v for k, v in whole.items() if k[1] == model}, abs=1e-8)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.data())
def test_any_history_matches_brute_force(spark, data):
    day = st.integers(-130 * 4, 20).map(lambda q: at(q / 4))
    touches = [touch(f"t{i:03d}", *v) for i, v in enumerate(data.draw(st.lists(
        st.tuples(st.integers(1, 3), day, st.sampled_from(["direct", "other", "referral", "cold_email"])), max_size=25)))]
    deals = [deal(i, *v) for i, v in enumerate(data.draw(st.lists(
        st.tuples(st.integers(1, 3), day, st.sampled_from(["0.01", "99.99", "123456.78"])), min_size=1, max_size=6)))]
    leads = [(d[0], data.draw(day)) for d in deals if data.draw(st.booleans())]
    cfg = AttributionConfig(bucket_days=data.draw(st.sampled_from([3, 30, 100])), half_life_days=5, lookback_days=60)
    shuffled = data.draw(st.permutations(touches))
    opps, _, _, fact = chain(spark, deals, shuffled, leads, cfg)
    fact = fact.repartition(data.draw(st.integers(1, 5)))
    assert credits_of(fact) == pytest.approx(brute_force(deals, touches, leads, cfg), abs=2e-8)
    found = contracts.summarise({
        "sum": contracts.credit_sums_to_one(fact), "every": contracts.every_deal_in_every_model(opps, fact),
        "late": contracts.no_credit_after_deal_created(fact), "range": contracts.credit_in_unit_interval(fact),
        "money": contracts.won_revenue_reconciles(fact, opps)})
    assert {r["violations"] for r in found.collect()} == {0}


def test_hot_account_with_a_third_of_all_rows(spark):
    touches = [touch(f"h{i:04d}", 7, at(-(i % 60), i), ("referral", "direct")[i % 2]) for i in range(600)]
    touches += [touch(f"c{i:04d}", 100 + i % 300, at(-(i % 80))) for i in range(1200)]
    deals = [deal(i, 7, -(i % 5)) for i in range(5)] + [deal(100 + i, 100 + i, 0) for i in range(300)]
    _, _, _, fact = chain(spark, deals, touches)
    assert credits_of(fact) == pytest.approx(brute_force(deals, touches), abs=2e-8)
