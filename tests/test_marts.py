import datetime as dt
from decimal import Decimal

import pytest
from frames import rows

from touchledger.config import MODELS
from touchledger.operators import lift, marts
from touchledger.sources.feeds import dim_channel

@pytest.fixture
def credit(frame):
    def make(*values):
        return frame("model string; channel string; deal_created_at timestamp; credit double; is_won boolean; "
                     "credited_pipeline double; credited_won_revenue double", *values)
    return make


@pytest.fixture
def spend(frame):
    return frame("spend_date date; channel string; clicks int; spend_usd decimal(12,2)",
                 ("2025-01-03", "google_ads", 5, "10.00"), ("2025-01-30", "google_ads", 6, "15.00"),
                 ("2025-03-01", "google_ads", 1, "99.00"), ("2025-01-01", "adroll", 1, "1.00"))


def test_performance_groups_by_month_of_deal_creation(spark, credit, spend):
    fact = credit(("linear", "google_ads", "2025-01-05 00:00:00", 0.5, True, 50.005, 50.005),
                  ("linear", "google_ads", "2025-01-31 23:00:00", 0.25, False, 25.0, 0.0),
                  ("linear", "google_ads", "2025-02-01 00:00:00", 1.0, False, 7.0, 0.0),
                  ("linear", "referral", "2025-01-05 00:00:00", 0.5, True, 50.004, 50.004))
    got = rows(marts.channel_performance(fact, spend, dim_channel(spark)), "channel", "month")
    jan, feb = dt.date(2025, 1, 1), dt.date(2025, 2, 1)
    D = Decimal
    assert got == [
        ("linear", "google_ads", "paid", jan, D("0.750"), D("0.500"), D("75.01"), D("50.01"), D("25.00"), 11),
        ("linear", "google_ads", "paid", feb, D("1.000"), D("0.000"), D("7.00"), D("0.00"), None, None),
        ("linear", "referral", "organic", jan, D("0.500"), D("0.500"), D("50.00"), D("50.00"), None, None)]


def test_summary_adds_rounded_months_and_spend_of_all_time(frame, spend):
    perf = frame("model string; channel string; channel_group string; credited_deals double; credited_wins double; "
                 "pipeline_usd double; won_revenue_usd double",
                 ("linear", "google_ads", "paid", 1.0, 0.5, 300.0, 30.0), ("linear", "google_ads", "paid", 1.0, 0.0, 72.0, 0.0),
                 ("linear", "referral", "organic", 1.0, 0.0, 5.0, 60.0), ("w_shaped", "referral", "organic", 1.0, 0.0, 5.0, 0.0))
    got = {(r["model"], r["channel"]): r for r in marts.channel_summary(perf, spend).collect()}
    ads = got[("linear", "google_ads")]
    assert (ads["share_of_won_revenue"], ads["pipeline_per_dollar"], ads["cost_per_credited_win"]) == (0.3333, 3.0, 248.0)
    assert got[("linear", "referral")]["cost_per_credited_win"] is None
    assert got[("w_shaped", "referral")]["share_of_won_revenue"] is None  # no won revenue in that model


def test_disagreement_reads_missing_as_zero_and_ranks_with_gaps(frame):
    summary = frame("channel string; model string; share_of_won_revenue double",
                    ("a", "linear", 0.5), ("a", "w_shaped", 0.25), ("b", "linear", 0.5), ("b", "time_decay", 0.1),
                    ("c", "linear", 0.2), *[("d", m, 0.3) for m in MODELS])
    got = {r["channel"]: (r["swing"], r["swing_rank"]) for r in marts.model_disagreement(summary).collect()}
    assert got == {"a": (0.5, 1), "b": (0.5, 1), "c": (0.2, 3), "d": (0.0, 4)}


def test_funnel_spine_fills_months_and_drops_what_lies_outside(frame):
    sessions = frame("client_id string; started_at timestamp", ("k", "2025-01-05 00:00:00"), ("x", "2025-01-06 00:00:00"),
                     (None, "2025-01-07 00:00:00"), ("k", "2025-04-01 00:00:00"))
    client_map = frame("client_id string; person_id bigint", ("k", 1))
    leads = frame("person_id bigint; lead_at timestamp", (1, "2025-02-01 00:00:00"), (1, "2025-01-31 00:00:00"),
                  (2, "2025-04-02 00:00:00"))
    calls = frame("called_at timestamp; outcome string", ("2025-01-01 00:00:00", "meeting_booked"),
                  ("2025-01-01 00:00:00", "no_answer"), ("2024-12-31 00:00:00", "meeting_booked"))
    opps = frame("created_at timestamp; closed_at timestamp; is_closed boolean; is_won boolean; amount decimal(12,2)",
                 ("2025-01-01 00:00:00", "2025-04-30 00:00:00", True, True, "10.00"),
                 ("2025-01-01 00:00:00", "2025-04-30 00:00:00", True, False, "20.00"),
                 ("2025-01-01 00:00:00", None, True, True, "40.00"), ("2025-06-01 00:00:00", None, False, False, "80.00"))
    got = rows(marts.funnel_monthly(sessions, client_map, leads, calls, opps))
    D = Decimal
    assert got == [
        (dt.date(2025, 1, 1), 3, 1, 1, 1, 3, D("70.00"), 0, 0, D("0.00"), None),
        (dt.date(2025, 2, 1), 0, 0, 0, 0, 0, D("0.00"), 0, 0, D("0.00"), None),
        (dt.date(2025, 3, 1), 0, 0, 0, 0, 0, D("0.00"), 0, 0, D("0.00"), None),
        (dt.date(2025, 4, 1), 1, 1, 1, 0, 0, D("0.00"), 1, 1, D("10.00"), 0.5)]


FACTS = ("deal_id bigint; domain string; first_touch_channel string; is_closed boolean; is_won boolean; "
         "amount decimal(12,2); cycle_days int; created_at timestamp; closed_at timestamp; company_name string")


def fact(deal_id, domain, channel, won=True, closed=True, amount="10.00", days=5, at="2025-01-01 00:00:00"):
    return (deal_id, domain, channel, closed, won, amount, days, "2025-01-01 00:00:00", at, "Co")


def test_velocity_has_the_exact_median_of_won_deals(frame):
    facts = frame(FACTS, fact(1, "a", "referral", days=2), fact(2, "a", "referral", days=5), fact(3, "a", "referral", won=False, days=99),
                  fact(4, "a", None, won=False, closed=False), fact(5, "a", "referral", days=None, amount="25.01"))
    got = {r["first_touch_channel"]: tuple(r)[1:] for r in marts.velocity(facts).collect()}
    assert got == {"referral": (4, 4, 3, 0.75, 15.0, 3.5), "unattributed": (1, 0, 0, None, None, None)}


SUBS = "subscription_id string; domain string; start_date date; current_mrr_usd decimal(18,2)"
EVENTS = "subscription_id string; event_type string; mrr_delta_usd decimal(18,2)"


def test_retention_per_winning_channel_and_in_total(frame):
    subs = frame(SUBS, ("s1", "a", "2025-01-01", "0.00"), ("s2", "b", "2025-01-01", "130.00"),
                 ("s3", "c", "2025-01-01", "90.00"), ("none", "a", "2025-01-01", "500.00"))
    events = frame(EVENTS, ("s1", "new", "100.00"), ("s1", "expansion", "50.00"), ("s1", "churn", "-150.00"),
                   ("s2", "new", "100.00"), ("s2", "expansion", "30.00"), ("s3", "new", "100.00"), ("s3", "contraction", "-10.00"))
    facts = frame(FACTS, fact(1, "a", "referral", at="2025-01-01 00:00:00"), fact(2, "a", "direct", at="2025-02-01 00:00:00"),
                  fact(3, "b", "referral", at="2025-03-01 00:00:00"), fact(4, "b", "cold_email", at=None),
                  fact(5, "c", "referral", won=False))
    moved = marts.subscription_movements(subs, events)
    assert moved.count() == 3
    got = {r["first_touch_channel"]: (r["customers"], r["net_revenue_retention"], r["gross_revenue_retention"])
           for r in marts.retention(moved, facts).collect()}
    # expansion followed by churn must not push gross retention below zero
    assert got == {"direct": (1, 0.0, 0.0), "cold_email": (1, 1.3, 1.0), "unattributed": (1, 0.9, 0.9),
                   "all_customers": (3, 0.733, 0.633)}


def test_truth_clips_harm_and_ranks_models_densely(frame):
    summary = frame("model string; channel string; share_of_won_revenue double", ("linear", "a", 0.5), ("linear", "z", 0.5),
                    ("w_shaped", "a", 0.25), ("w_shaped", "b", 0.75), ("time_decay", "b", 0.5))
    truth = frame("channel string; expected_incremental_revenue string", ("a", "30.00"), ("b", "90.00"), ("c", "-5.00"))
    got = {(r["model"], r["channel"]): tuple(r)[2:] for r in marts.truth_evaluation(summary, truth).collect()}
    assert len(got) == 9
    assert got[("linear", "c")] == (0.0, 0.0, 0.0, 0.3333, 3)
    assert got[("w_shaped", "a")] == (0.25, 0.25, 0.0, 0.0, 1)
    assert got[("time_decay", "a")] == (0.25, 0.0, -0.25, 0.1667, 2)
    ranks = {m: {v[4] for k, v in got.items() if k[0] == m} for m in ("linear", "w_shaped", "time_decay")}
    assert ranks == {"w_shaped": {1}, "time_decay": {2}, "linear": {3}}


def test_lift_pairs_runs_of_the_same_replicate(frame):
    runs = frame("replicate bigint; disabled_channel string; won_revenue decimal(18,2)", (0, "none", "100.00"), (1, "none", "200.00"),
                 (0, "ads", "90.00"), (1, "ads", "170.00"), (0, "mail", "110.00"), (1, "mail", "200.00"))
    got = {r["channel"]: tuple(r)[1:] for r in lift.incremental_lift(runs).collect()}
    assert got == {"ads": (2, 20.0, 10.0, 150.0), "mail": (2, -5.0, 5.0, 150.0)}


def test_dashboard_summary(frame):
    facts = frame(FACTS, fact(1, "a", None, amount="10.50"), fact(2, "a", None, won=False), fact(3, "a", None, won=False, closed=False))
    assert tuple(marts.dashboard_summary(facts).first()) == (
        3, 1, 2, Decimal("30.50"), Decimal("10.50"), dt.date(2025, 1, 1), dt.date(2025, 1, 1))
    assert tuple(marts.dashboard_summary(facts.filter("false")).first())[:5] == (0, 0, 0, Decimal(0), Decimal(0))
