import datetime as dt

import pytest
from frames import rows
from pyspark.sql import Window
from pyspark.sql import functions as F
from world import at, chain, deal, timeline, touch, written

from touchledger.config import AttributionConfig
from touchledger.operators import journeys, opportunities
from touchledger.operators.numbering import number_rows, place_rows
from touchledger.operators.touches import touchpoints


def test_window_is_open_at_the_far_end_and_closed_at_the_deal(spark):
    touches = [touch("at_creation", 1, at(0)), touch("just_after", 1, at(0, 1)), touch("lower_bound", 1, at(-90)),
               touch("just_inside", 1, at(-90, 1)), touch("elsewhere", 2, at(-1))]
    _, _, pairs, _ = chain(spark, [deal(1, 1, 0)], touches)
    got = rows(journeys.deal_touch_window(pairs).select("touchpoint_id", "touch_number", "touch_count"), "touch_number")
    assert got == [("just_inside", 1, 2), ("at_creation", 2, 2)]


def test_equal_times_are_ordered_by_touch_id(spark):
    touches = [touch(t, 1, at(-5)) for t in ("b", "c", "a")]
    _, _, pairs, _ = chain(spark, [deal(1, 1, 0), deal(2, 1, 1)], touches)
    got = rows(pairs.select("deal_id", "touchpoint_id", "touch_number"), "deal_id", "touch_number")
    assert got == [(d, t, i) for d in (1, 2) for i, t in enumerate("abc", 1)]


def test_ages_are_exact_fractions_of_days(spark):
    _, _, pairs, _ = chain(spark, [deal(1, 1, 0)], [touch("a", 1, at(-1.5))])
    assert pairs.first()["days_before_deal"] == 1.5


def test_touch_without_time_or_deal_without_account_never_pairs(spark):
    touches = [("x", 1, 1, None, "referral", "w"), touch("y", 1, -1)]
    deals = [deal(1, 1, 0), (2, None, None, at(0), None, False, False)]
    _, anchors, pairs, _ = chain(spark, deals, touches)
    assert rows(pairs.select("deal_id", "touchpoint_id", "touch_count")) == [(1, "y", 1)]
    assert anchors.count() == 2


@pytest.mark.parametrize("bucket_days", [1, 7, 90, 365])
def test_plan_knobs_do_not_change_results(spark, bucket_days):
    touches = [touch(f"t{i}", i % 3, at(-i * 1.37), person=i) for i in range(150)]
    deals = [deal(i, i % 3, -i * 2.5) for i in range(12)]
    base = chain(spark, deals, touches)[2]
    other = chain(spark, deals, touches, cfg=AttributionConfig(bucket_days=bucket_days))[2]
    cols = ["deal_id", "touch_number", "touchpoint_id", "touch_count"]
    assert rows(base.select(cols), *cols) == rows(other.select(cols), *cols)


def test_numbering_over_partitions_equals_a_plain_window(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("k"), F.pmod(F.hash("id"), F.lit(500)).alias("v"), "id")
    ours = number_rows(written(place_rows(df.repartition(7), ["k", "v", "id"])), "n").select("id", "n")
    plain = df.select("id", F.row_number().over(Window.orderBy("k", "v", "id")).cast("bigint").alias("n"))
    assert rows(ours, "id") == rows(plain, "id")


def test_account_sequence_spans_days_without_gaps(spark):
    from world import TOUCH

    touches = spark.createDataFrame([touch(f"t{i}", 1, at(i * 0.4)) for i in range(20)], TOUCH)
    assert [r["account_seq"] for r in timeline(touches).orderBy("touched_at").collect()] == list(range(1, 21))


def test_one_account_day_with_a_third_of_all_touches_is_spread(spark):
    """Placed rows per partition stay even, however many share an account and a day."""
    from world import TOUCH

    hot = [touch(f"h{i:05d}", 7, at(0, i % 50)) for i in range(4000)]
    cold = [touch(f"c{i:05d}", 100 + i % 900, at(-(i % 80))) for i in range(8000)]
    placed = place_rows(spark.createDataFrame(hot + cold, TOUCH).repartition(5), ["company_id", "touched_at", "touchpoint_id"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = sorted(r["count"] for r in placed.groupBy("_part").count().collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 4 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_lead_moment_is_the_first_inside_the_window(frame):
    opps = frame("deal_id bigint; company_id bigint; created_at timestamp", (1, 1, "2025-06-01 00:00:00"),
                 (2, 2, "2025-06-01 00:00:00"), (3, 3, "2025-06-01 00:00:00"))
    leads = frame("company_id bigint; lead_at timestamp", (1, "2025-03-03 00:00:00"), (1, "2025-05-01 00:00:00"),
                  (1, "2025-04-01 00:00:00"), (1, "2025-06-01 00:00:01"), (2, "2025-06-01 00:00:00"))
    got = rows(opportunities.deal_lead_moment(opps, leads), "deal_id")
    assert got == [(1, dt.datetime(2025, 4, 1)), (2, dt.datetime(2025, 6, 1))]


def test_touchpoints_of_every_system(frame):
    at_ = "2025-05-01 00:00:00"
    email_map = frame("email string; person_id bigint; company_id bigint", ("a@x.io", 1, 10))
    client_map = frame("client_id string; person_id bigint; company_id bigint", ("k", 1, 10))
    sessions = frame("session_id string; client_id string; started_at timestamp; channel string",
                     ("s1", "k", at_, "direct"), ("s2", "anonymous", at_, "direct"), ("s3", None, at_, "direct"))
    mails = frame("email_event_id string; email string; event_type string; event_at timestamp; channel string",
                  *[(f"m{t}", "a@x.io", t, at_, "cold_email") for t in ("sent", "open", "click", "reply")])
    signals = frame("signal_id string; detected_at timestamp; person_id bigint; company_id bigint", ("g1", at_, 1, 10))
    bot = frame("thread_id string; email string; bot_replied_at timestamp", ("b1", "a@x.io", at_), ("b2", "a@x.io", None))
    calls = frame("call_id string; email string; called_at timestamp; outcome string", ("c1", "a@x.io", at_, "meeting_booked"),
                  ("c2", "a@x.io", at_, "no_answer"), ("c3", "a@x.io", at_, None))
    got = touchpoints(sessions, client_map, mails, email_map, signals, bot, calls)
    assert rows(got.select("source_system", "source_record_id", "channel", "touch_type", "company_id"), "source_record_id") == [
        ("reply_bot", "b1", "reply_bot", "bot_reply", 10), ("voice_agent", "c1", "voice_agent", "voice_call", 10),
        ("clay", "g1", "signal_engine", "signal_detected", 10), ("smartlead", "mclick", "cold_email", "email_click", 10),
        ("smartlead", "mreply", "cold_email", "email_reply", 10), ("ga4", "s1", "direct", "web_session", 10)]
    import hashlib
    ids = {r["source_record_id"]: r["touchpoint_id"] for r in got.collect()}
    assert ids["s1"] == hashlib.md5(b"ga4|s1").hexdigest()


def test_deal_outcomes(frame):
    deals = frame("deal_id bigint; deal_name string; amount decimal(12,2); current_stage string; created_at timestamp; "
                  "is_closed boolean; is_won boolean; company_id bigint; contact_id bigint",
                  *[(i, "d", "10.00", s, "2025-01-01 00:00:00", c, w, 1, k) for i, s, c, w, k in (
                      (1, "contractsent", False, False, None), (2, "closedwon", True, True, 5),
                      (3, "closedlost", True, False, 5), (4, "closedwon", True, True, 5),
                      (5, "closedwon", True, True, 5), (6, "closedlost", True, False, 5), (7, "closedwon", True, True, 5))])
    history = frame("deal_id bigint; stage string; changed_at timestamp",
                    (1, "closedlost", "2025-01-02 00:00:00"), (2, "closedwon", "2025-01-11 23:59:59"),
                    (3, "closedlost", "2025-01-03 00:00:00"), (3, "closedlost", "2025-01-05 12:00:00"),
                    (4, "closedlost", "2025-01-03 00:00:00"), (4, "closedwon", "2025-01-09 00:00:00"),
                    (7, "qualifiedtobuy", "2025-01-03 00:00:00"))
    companies = frame("company_id bigint; company_name string; domain string; industry string; size_band string",
                      (1, "Acme", "acme.io", "Saas", "mid"))
    got = {r["deal_id"]: r for r in opportunities.opportunities(deals, history, companies).collect()}
    assert {k: (r["cycle_days"], r["was_reopened"]) for k, r in got.items()} == {
        1: (None, False), 2: (10, False), 3: (4, False), 4: (8, True), 5: (None, None), 6: (None, False), 7: (None, False)}
    assert got[1]["closed_at"] is None and got[1]["is_missing_contact"] and not got[2]["is_missing_contact"]
    assert got[4]["closed_at"] == dt.datetime(2025, 1, 9) and got[7]["closed_at"] is None
    assert got[3]["closed_at"] == dt.datetime(2025, 1, 5, 12) and got[2]["domain"] == "acme.io"
