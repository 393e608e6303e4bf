"""Physical plans: what must not be in them at any scale, and what must."""

import contextlib
import io
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from touchledger.operators.contracts import ContractViolation
from touchledger.plans import contracts, nightly
from touchledger.plans.queries import QUERIES, warehouse
from touchledger.plans.warehouse import Warehouse
from touchledger.plans.workspace import Workspace, shared_folder

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


@pytest.fixture
def large(spark):
    """No table counts as small, so that only explicit broadcasts remain."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


CHAIN = ("identity_contacts", "identity_people", "identity_client_map", "match_signals", "lead_events", "touchpoints",
         "account_touches", "opportunities", "deal_lead_moment", "deal_anchors", "deal_journeys", "fct_attribution",
         "fct_opportunities", "channel_performance", "retention", "truth_evaluation", "data_quality")


def test_no_pairwise_joins_and_no_python_in_any_layer(spark, large):
    wh = warehouse(spark, FOLDER)
    for name in CHAIN:
        text = plan(getattr(wh, name))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ScalaUDF"):
            assert bad not in text, f"{name}: {bad}"


def broadcasts(text: str) -> list[str]:
    return [line for line in text.splitlines() if "BroadcastHashJoin" in line]


def test_only_fixed_lookups_are_broadcast(spark, large):
    wh = warehouse(spark, FOLDER)
    for name in ("touchpoints", "deal_anchors", "deal_journeys", "fct_attribution", "fct_opportunities"):
        # the offsets of placed rows, a row per partition, and the bits of the known cookies, a bounded number
        assert all("[_part#" in line or "[_slot#" in line for line in broadcasts(plan(getattr(wh, name)))), name
    wh.shared("fct_attribution")
    assert plan(wh.channel_performance).count("BroadcastHashJoin") == 1


def test_pairs_of_deals_and_touches_are_neither_shuffled_nor_sorted_nor_windowed(spark, large):
    wh = warehouse(spark, FOLDER)
    text = plan(wh.deal_journeys)
    join = text.index("SortMergeJoin")
    assert "Exchange" not in text[:join] and "Window [row_number" not in text
    assert text.count("Exchange hashpartitioning(company_id") == 2


def test_touches_are_numbered_without_a_window_over_them(spark, large):
    text = plan(warehouse(spark, FOLDER).account_touches)
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert len(windows) == 1 and "_part" in windows[0] and "Exchange hashpartitioning(company_id" not in text


@pytest.mark.parametrize("name", ["fct_opportunities", "velocity", "retention", "latest_deal_per_company", "data_quality"])
def test_facts_about_deals_join_no_pairs(spark, large, shared, name):
    """The join of deals and touches by bucket runs once, for the anchors, which are written by then."""
    shared.shared("deal_anchors")
    text = plan(getattr(shared, name))
    assert "bucket" not in text and "credit" not in text
    assert "Expand" not in text or name == "retention"  # which adds up all customers beside each channel


@pytest.fixture(scope="module")
def shared(spark):
    return warehouse(spark, FOLDER)


@pytest.mark.parametrize("name", ["touchpoints", "funnel_monthly", "data_quality"])
def test_sessions_of_unknown_cookies_are_dropped_before_a_shuffle(spark, large, shared, name):
    lines = plan(getattr(shared, name)).splitlines()
    asked = [i for i, line in enumerate(lines) if "BroadcastHashJoin [_slot#" in line]
    assert len(asked) == 1
    # above the test of the bit, and only there, rows are dealt by cookie
    dealt = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(client_id" in line]
    assert dealt and dealt[0] < asked[0] and not any("Exchange hashpartitioning" in line for line in lines[asked[0]:asked[0] + 6])


def test_filters_and_columns_reach_the_scan(spark):
    wh = warehouse(spark, FOLDER)
    text = plan(wh.stg_calls.filter(F.col("outcome") == "no_answer").select("call_id"))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "EqualTo(event_type,error)" in scan or "In(event_type, [error])" in scan
    assert "struct<event_id:bigint,event_type:string>" in scan
    spend = plan(wh.stg_spend_daily.groupBy("channel").agg(F.sum("spend_usd")))
    assert "l_tax" not in spend and "l_shipdate" not in spend


def test_shared_layers_are_written_once(spark, tmp_path):
    wh = Warehouse(spark, warehouse(spark, FOLDER).feeds, workspace=Workspace(spark, str(tmp_path)))
    first = wh.shared("identity_contacts")
    assert wh.shared("identity_contacts") is first and wh.latest("identity_contacts") is first
    assert len(list(tmp_path.glob("run-*/identity_contacts"))) == 1


def test_workspace_follows_the_cluster_setting(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert Workspace(spark).root.startswith(shared_folder(spark))


def test_workspace_falls_back_to_the_warehouse_and_else_raises():
    class Conf(dict):
        conf = property(lambda self: self)

    cluster = {"spark.master": "spark://host:7077"}
    assert shared_folder(Conf(cluster | {"spark.sql.warehouse.dir": "hdfs:/tables/"})) == "hdfs:/tables"
    assert shared_folder(Conf(cluster | {"spark.checkpoint.dir": "file:/shared/"})) == "file:/shared"
    assert shared_folder(Conf({"spark.master": "local[4]", "spark.sql.warehouse.dir": "file:/x/spark-warehouse"})) == "file:/x/spark-warehouse"
    for unset in ({}, cluster | {"spark.sql.warehouse.dir": "file:/x/spark-warehouse"},
                  {"spark.master": "local-cluster[2,1,1024]", "spark.sql.warehouse.dir": "/x/spark-warehouse"}):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(Conf(unset))


def test_a_later_session_reads_every_layer_by_name(spark, tmp_path):
    root = str(tmp_path)
    nightly.run(spark, warehouse(spark, FOLDER).feeds, root, 1)
    later = spark.newSession()
    for name in (*nightly.STAGING, *nightly.IDENTITY, *nightly.INTERMEDIATE, *nightly.MARTS):
        df = nightly.published(later, root, name)
        assert df.count() > 0 and not [c for c in df.columns if c.startswith("_")], name


def test_nightly_run_publishes_and_logs(spark, tmp_path):
    root = str(tmp_path)
    feeds = warehouse(spark, FOLDER).feeds
    for run_id in (1, 2):
        wh = nightly.run(spark, feeds, root, run_id, revision="abc", company="Acme", pitch="We sell anvils")
    assert nightly.published(spark, root, "channel_summary").count() == wh.latest("channel_summary").count() > 0
    assert spark.read.parquet(f"{root}/published").orderBy("run_id").collect()[-1]["folder"] == wh.workspace.root
    document = json.loads(spark.read.text(f"{wh.workspace.root}/dashboard").first()[0])
    assert document["summary"]["opps"] == 1500 and len(document["runs"]) == 14
    assert nightly.published(spark, root, "stg_deals").count() == 1500
    assert nightly.published(spark, root, "deal_touch_window").count() > 0
    log = spark.read.parquet(f"{root}/pipeline_runs").orderBy("run_id").collect()
    assert [(r["run_id"], r["status"], r["revision"]) for r in log] == [(1, "success", "abc"), (2, "success", "abc")]
    assert json.loads(log[0]["summary"])["opps"] == 1500
    assert [s["step"] for s in json.loads(log[0]["steps"])] == [
        "staging", "phones", "identity", "unambiguous", "build", "contracts", "publish"]
    assert (document["meta"]["company"], document["meta"]["pitch"]) == ("Acme", "We sell anvils")


def test_old_runs_are_pruned_and_the_published_and_the_running_stay(spark, tmp_path):
    import datetime as dt

    root = str(tmp_path)
    for k in range(4):
        (tmp_path / f"run-{k}" / "t").mkdir(parents=True)
    (tmp_path / "run-5").mkdir()  # not published: running, or failed
    rows = [(k, f"file:{root}/run-{k}", dt.datetime(2025, 1, 1 + k)) for k in range(4)]
    spark.createDataFrame(rows, "run_id bigint, folder string, published_at timestamp").coalesce(1).write.parquet(f"{root}/published")
    assert nightly.prune(spark, root, keep=2) == [f"{root}/run-0", f"{root}/run-1"]
    assert sorted(p.name for p in tmp_path.glob("run-*")) == ["run-2", "run-3", "run-5"] and (tmp_path / "published").exists()
    assert nightly.prune(spark, root, keep=1, unpublished_hours=-1) == [f"{root}/run-2", f"{root}/run-5"]
    with pytest.raises(ValueError):
        nightly.prune(spark, root, keep=0)


def test_ambiguous_keys_stop_a_run_before_touches_are_built(spark, tmp_path):
    driver = warehouse(spark, FOLDER).feeds
    feeds = {name: driver[name] for name in driver}
    twins = feeds["hubspot_contacts"].limit(20).withColumn("hs_object_id", F.concat(F.lit("9"), "hs_object_id"))
    feeds["hubspot_contacts"] = feeds["hubspot_contacts"].union(twins)
    with pytest.raises(ContractViolation, match="unambiguous_addresses"):
        nightly.run(spark, feeds, str(tmp_path), run_id=3)
    log = spark.read.parquet(f"{tmp_path}/pipeline_runs").first()
    assert json.loads(log["steps"])[-1] == {"step": "unambiguous", "ok": False}
    assert not list(tmp_path.glob("run-*/touchpoints"))


def test_phones_without_digits_stop_a_run_before_contacts_are_joined(spark, tmp_path):
    driver = warehouse(spark, FOLDER).feeds
    feeds = {name: driver[name] for name in driver}
    feeds["hubspot_contacts"] = feeds["hubspot_contacts"].withColumn(
        "phone", F.when(F.pmod(F.col("hs_object_id").cast("bigint"), F.lit(3)) == 0, F.lit("n/a")).otherwise(F.col("phone")))
    with pytest.raises(ContractViolation, match="phones_with_digits"):
        nightly.run(spark, feeds, str(tmp_path), run_id=4)
    assert json.loads(spark.read.parquet(f"{tmp_path}/pipeline_runs").first()["steps"])[-1] == {"step": "phones", "ok": False}
    assert not list(tmp_path.glob("run-*/identity_contacts"))


def test_broken_contract_keeps_the_published_tables(spark, tmp_path):
    root = str(tmp_path)
    driver = warehouse(spark, FOLDER).feeds
    feeds = {name: driver[name] for name in driver}
    feeds["voice_agent_calls"] = feeds["voice_agent_calls"].union(feeds["voice_agent_calls"].limit(1))
    with pytest.raises(ContractViolation, match="unique:stg_calls.call_id"):
        nightly.run(spark, feeds, root, run_id=2)
    assert not (tmp_path / "published").exists()
    log = spark.read.parquet(f"{root}/pipeline_runs").first()
    assert log["status"] == "failed" and json.loads(log["steps"])[-1] == {"step": "contracts", "ok": False}


def test_all_contracts_are_checked(spark):
    found = contracts.check_all(warehouse(spark, FOLDER))
    assert found.count() == 45 and {r["violations"] for r in found.collect()} == {0}


def test_registry_and_oracles_cover_the_same_queries():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_text_exports_give_the_same_marts_as_typed_feeds(spark, tmp_path):
    from touchledger.plans.queries import _landed

    typed = warehouse(spark, FOLDER)
    landed = _landed(typed)
    assert all(t == "string" for df in landed.values() for c, t in df.dtypes if not c.startswith("_"))
    text = Warehouse(spark, landed)
    for name in ("channel_summary", "retention", "funnel_monthly"):
        ours, theirs = (sorted(map(str, getattr(wh, name).collect())) for wh in (text, typed))
        assert ours == theirs and ours


def test_layers_are_written_in_a_codec_that_halves_hexadecimal_keys(spark, tmp_path):
    import pyarrow.parquet as pq

    keys = spark.range(20000).select(F.md5(F.col("id").cast("string")).alias("k")).coalesce(1)
    written = Workspace(spark, str(tmp_path)).settle(keys, "keys")
    (file,) = tmp_path.glob("run-*/keys/*.parquet")
    assert written.count() == 20000 and pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"
    assert file.stat().st_size < 20 * 20000


def test_rows_are_doubled_without_building_a_layer_twice(spark):
    from touchledger.plans import broken

    wh = warehouse(spark, FOLDER)
    found = broken.doubled(wh, "stg_deals", ["deal_id"])
    deals = wh.stg_deals.select("deal_id")
    assert sorted(found.collect()) == sorted(deals.union(deals.filter(broken.spoilt("deal_id"))).collect())
    assert plan(found).count("FileScan") == 1 and found.columns == ["deal_id"]


def test_tasks_are_small_unless_the_session_says_otherwise(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        warehouse(spark, FOLDER)
        assert spark.conf.get(key) == "8m"
        spark.conf.set(key, "32m")
        warehouse(spark, FOLDER)
        assert spark.conf.get(key) == "32m"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_a_table_is_broadcast_by_its_rows_not_by_its_files(spark):
    """Rows of 33 MB lie in files far below Spark's 10 MB; a join may not bring them to the driver for that."""
    session = spark.newSession()
    wh = warehouse(session, FOLDER)
    rows = session.range(300_000).withColumn("name", F.concat(F.lit("one long name " * 5), F.col("id").cast("string")))
    many = wh.workspace.settle(rows, "many")
    few = wh.workspace.settle(rows.limit(100), "few")
    assert sum(p.stat().st_size for p in pathlib.Path(wh.workspace.root.removeprefix("file:")).rglob("many/*.parquet")) < 4e6
    keys = session.range(1_000_000).select((F.col("id") % 400_000).alias("id"))
    for table, joined, way in ((many, 800_000, "SortMergeJoin"), (few, 300, "BroadcastHashJoin")):
        found = keys.join(table, "id").agg(F.count("name").alias("n"))
        assert found.collect()[0]["n"] == joined
        final = plan(found).partition("Initial Plan")[0]
        assert way in final and ("BroadcastHashJoin" in final) == (way == "BroadcastHashJoin")


def test_limits_of_the_session_hold_for_measured_sizes(spark):
    planned, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    for given, used in (({planned: "256k"}, str(256 << 10)), ({planned: "1g"}, str(2 << 20)), ({planned: "-1"}, "-1"), ({measured: "30m"}, "30m")):
        session = spark.newSession()
        for key, value in given.items():
            session.conf.set(key, value)
        for _ in range(2):
            warehouse(session, FOLDER)
            assert (session.conf.get(planned), session.conf.get(measured)) == ("-1", used)


def test_deals_of_untouched_accounts_are_not_spread_over_time_buckets(spark):
    from touchledger.operators import journeys

    wh = warehouse(spark, FOLDER)
    opps, leads = wh.shared("opportunities"), wh.shared("deal_lead_moment")
    lost = opps.withColumns({"deal_id": -F.col("deal_id") - 1, "company_id": -F.col("company_id") - 1})
    # bits are shared by chance
    assert wh.touched_accounts.may_hold(lost, "company_id").count() < lost.count() / 2
    opps = opps.union(lost).union(lost.withColumns({"deal_id": F.col("deal_id") - 10 ** 9, "company_id": F.lit(None).cast("bigint")}))
    found = [sorted(map(str, journeys.deal_anchors_by_pairs(opps, wh.account_touches, leads, wh.cfg, touched).collect()))
             for touched in (None, wh.touched_accounts)]
    assert found[0] == found[1] and len(found[0]) == opps.count()
    assert "getbit" in plan(wh.deal_anchors) or "getbit" in plan(journeys.deal_anchors_by_pairs(
        opps, wh.account_touches, leads, wh.cfg, wh.touched_accounts))


REPORTS = ("metric_catalogue", "crm_payload", "dashboard")


@pytest.mark.parametrize("name", REPORTS)
def test_reports_write_no_fact_table_but_read_the_same_facts(spark, tmp_path, name):
    from touchledger.plans.queries import _document

    def result(wh):
        if name == "dashboard":
            return {k: v for k, v in _document(wh).items() if k != "meta"}
        found = getattr(wh, name)
        return sorted(map(str, (found() if callable(found) else found).collect()))

    feeds = warehouse(spark, FOLDER).feeds
    narrow, whole = (Warehouse(spark, feeds, workspace=Workspace(spark, str(tmp_path))) for _ in range(2))
    whole.materialise(["fct_attribution", "fct_opportunities"])
    ours, theirs = result(narrow), result(whole)
    if name == "dashboard":
        for found in (ours, theirs):
            for row in found["quality"]:
                row.pop("checked_at", None)
    assert ours == theirs and ours
    written = {p.name for p in (tmp_path / narrow.workspace.root.rsplit("/", 1)[-1]).iterdir()}
    assert {"channel_performance", "deal_facts"} <= written and not {"fct_attribution", "fct_opportunities"} & written
