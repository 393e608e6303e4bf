from frames import rows
from pyspark.sql import functions as F
from world import written

from touchledger.operators import crm

FACTS = "deal_id bigint; domain string; company_name string; first_touch_channel string; created_at timestamp"


def test_pipeline_counts_only_w_shaped_credit(frame):
    facts = frame(FACTS, (1, "a.io", "A", "x", None), (2, "a.io", "A", "x", None), (3, "b.io", "B", "x", None))
    credit = frame("deal_id bigint; model string; credited_pipeline double", (1, "w_shaped", 1.5), (1, "w_shaped", 2.0),
                   (2, "w_shaped", 4.0), (2, "linear", 100.0), (3, "linear", 9.0))
    assert rows(crm.credited_pipeline_by_company(credit, facts)) == [("a.io", 7.5)]


def test_latest_deal_prefers_undated_then_newest_then_highest_id(frame):
    facts = frame(FACTS, (1, "a", "A", "x", "2025-01-01 00:00:00"), (2, "a", "A", "y", "2025-01-02 00:00:00"),
                  (3, "a", "A", "z", "2025-01-02 00:00:00"), (4, "b", "B", "q", None), (5, "b", "B", "r", "2025-01-01 00:00:00"))
    assert [(r["domain"], r["deal_id"], r["first_touch_channel"]) for r in
            crm.latest_deal_per_company(facts).orderBy("domain").collect()] == [("a", 3, "z"), ("b", 4, "q")]


def test_score_ranks_share_ties_and_read_missing_as_zero(frame):
    velocity = frame("first_touch_channel string; win_rate double", ("a", 0.5), ("b", 0.5), ("c", None))
    summary = frame("model string; channel string; won_revenue_usd double", ("w_shaped", "a", 9.0), ("w_shaped", "b", 5.0),
                    ("linear", "c", 99.0))
    got = {r["channel"]: (r["win_rank"], r["rev_rank"]) for r in crm.channel_score(velocity, summary).collect()}
    assert got == {"a": (0.5, 1.0), "b": (0.5, 0.5), "c": (0.0, 0.0)}


def payload(frame, limit=None):
    latest = frame("domain string; company_name string; first_touch_channel string", ("a", "A", "x"), ("b", "B", "y"),
                   ("c", "C", None), ("d", "D", "x"))
    credited = frame("domain string; attributed_pipeline double", ("a", 10.5), ("b", 99.4), ("d", 11.0))
    score = frame("channel string; win_rank double; rev_rank double", ("x", 0.125, 0.125), ("y", 1.0, 0.5))
    return crm.crm_payload(latest, credited, score, limit)


def test_payload_rounds_and_defaults(frame):
    got = {r["domain"]: tuple(r)[2:] for r in payload(frame).collect()}
    # 100 * 0.125 = 12.5 goes to the even neighbour, money goes up at a half
    assert got == {"a": ("x", 11, 12), "b": ("y", 99, 80), "c": ("unattributed", 0, 0), "d": ("x", 11, 12)}


def test_no_company_is_left_out_by_default(frame, spark):
    from inspect import signature

    from touchledger.plans.warehouse import Warehouse

    assert {signature(f).parameters["limit"].default for f in (
        crm.crm_payload, Warehouse.crm_payload, Warehouse.changed_rows)} == {None}
    assert payload(frame).count() == 4


def test_payload_limit_takes_the_largest_with_a_stable_tie(frame):
    assert [r["domain"] for r in payload(frame, 2).collect()] == ["b", "a"]


SNAPSHOT = "id string; domain string; first_touch_channel string; attributed_pipeline string; source_quality_score string"


def test_diff_update_create(frame):
    snapshot = frame(SNAPSHOT, ("7", "A", "x", "11.0", "12"), ("3", "b", "y", "99", "80.0"), ("2", "B", "y", "1", "1"),
                     ("9", None, "y", "1", "1"), ("8", "", "y", "1", "1"))
    existing = crm.existing_by_domain(snapshot)
    assert rows(existing.select("domain", "record_id"), "domain") == [("a", 7), ("b", 2)]
    changed = crm.split_upserts(crm.changed_rows(payload(frame), existing))
    assert rows(changed.select("domain", "record_id", "action"), "domain") == [
        ("b", 2, "update"), ("c", None, "create"), ("d", None, "create")]


def test_blank_values_and_prefixed_properties(frame):
    snapshot = frame("id string; domain string; p_first_touch_channel string; p_attributed_pipeline string; "
                     "p_source_quality_score string", ("1", "c", "unattributed", None, "0"), ("2", "d", "x", "11", "12.0"))
    changed = crm.changed_rows(payload(frame), crm.existing_by_domain(snapshot, "p_"))
    assert [r["domain"] for r in changed.orderBy("domain").collect()] == ["a", "b", "c"]


def test_second_diff_is_empty(frame, spark):
    first = payload(frame)
    applied = first.selectExpr("cast(hash(domain) as string) id", "upper(domain) domain", "first_touch_channel",
                               "concat(attributed_pipeline, '.0') attributed_pipeline",
                               "cast(source_quality_score as string) source_quality_score")
    assert crm.changed_rows(first, crm.existing_by_domain(applied)).isEmpty()


def test_batches_hold_at_most_n_rows_per_action(spark):
    rows_ = written(crm.placed_for_batches(spark.range(505).repartition(3).selectExpr(
        "concat('c', id, '.io') domain", "if(id % 5 = 0, 'create', 'update') action", "id % 40 as attributed_pipeline")))
    got = {(r["action"], r["batch_id"]): r["count"] for r in crm.batch_ids(rows_).groupBy("action", "batch_id").count().collect()}
    assert got == {("create", 0): 100, ("create", 1): 1, **{("update", i): 100 for i in range(4)}, ("update", 4): 4}
    small = crm.batch_ids(rows_, 50).groupBy("action", "batch_id").count()
    assert max(r["count"] for r in small.collect()) == 50
    # largest pipeline first
    ends = {(r["action"], r["batch_id"]): (r["low"], r["high"]) for r in crm.batch_ids(rows_).groupBy("action", "batch_id")
            .agg(F.min("attributed_pipeline").alias("low"), F.max("attributed_pipeline").alias("high")).collect()}
    assert all(ends["update", i][0] >= ends["update", i + 1][1] for i in range(4)) and ends["update", 0][1] == 39
