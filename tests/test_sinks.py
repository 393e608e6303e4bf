import json

import pytest

from touchledger import sinks
from touchledger.operators import catalogue


@pytest.mark.parametrize("layer", ["staging", "marts"])
def test_every_layer_is_a_table(spark, tmp_path, layer):
    for n in (3, 2):
        back = sinks.write_layer(spark.range(n), layer, "numbers", str(tmp_path))
    assert back.count() == 2 and (tmp_path / layer / "numbers").is_dir()


def test_dashboard_document_survives_a_failing_result(spark, tmp_path):
    broken = spark.sql("select raise_error('no log yet') as x")
    results = {"summary": spark.sql("select 3 as opps, cast(null as int) as won"),
               "monthly": spark.sql("select date'2025-01-01' as month, cast(1.50 as decimal(12,2)) as usd"), "runs": broken}
    sinks.dashboard_extract(results, str(tmp_path / "d"), lookback_days=60, company="Acme", pitch="One line")
    document = json.loads(spark.read.text(str(tmp_path / "d")).first()[0])
    assert document["summary"] == {"opps": 3, "won": None} and document["runs"] == []
    assert document["monthly"] == [{"month": "2025-01-01", "usd": 1.5}]
    assert document["meta"]["lookback_days"] == 60 and document["meta"]["company"] == "Acme" and len(document["metrics"]) == 15


def test_logs_only_grow(spark, tmp_path):
    path = str(tmp_path / "runs")
    for i in range(2):
        sinks.append_run_log(spark.sql(f"select {i}L as run_id, 'success' as status, array(named_struct('step', 'load')) as steps"), path)
    got = spark.read.parquet(path).orderBy("run_id").collect()
    assert [tuple(r) for r in got] == [(i, "success", '[{"step":"load"}]') for i in range(2)]
    writes = str(tmp_path / "writes")
    for mode in ("dry_run", "live"):
        sinks.append_write_log(spark.sql("select 'a.io' as domain, 7 as attributed_pipeline"), mode, writes)
    got = spark.read.parquet(writes).collect()
    assert {r["mode"] for r in got} == {"dry_run", "live"} and all(r["written_at"] for r in got)
    assert json.loads(got[0]["payload"]) == {"domain": "a.io", "attributed_pipeline": 7}
    with pytest.raises(ValueError):
        sinks.append_write_log(spark.range(1), "maybe", writes)


def test_catalogue_counts_values_and_rejects_unknown_columns(frame):
    tables = {
        "channel_summary": frame("won_revenue_usd double; pipeline_usd double; share_of_won_revenue double; "
                                 "pipeline_per_dollar double; cost_per_credited_win double", (1.0, 1.0, None, None, None)),
        "model_disagreement": frame("swing double", (0.5,), (None,)), "funnel_monthly": frame("win_rate double; new_leads int", (None, 1)),
        "velocity": frame("median_cycle_days_won double", (1.0,)),
        "retention": frame("net_revenue_retention double; gross_revenue_retention double", (1.0, None)),
        "data_quality": frame("check_name string; value double", ("unattributed_won_revenue_share", 0.1), ("other", 1.0)),
        "truth_evaluation": frame("model_mean_abs_error double", (0.1,)),
        "crm_payload": frame("attributed_pipeline int; source_quality_score int", (1, 2), (3, 4)),
    }
    got = {r["name"]: r["filled_values"] for r in catalogue.metric_catalogue(tables).collect()}
    assert len(got) == 15 and got["attributed_pipeline"] == 2 and got["model_swing"] == 1
    assert got["unattributed_won_revenue_share"] == 1 and got["pipeline_per_dollar"] == 0
    with pytest.raises(ValueError, match="velocity.median_cycle_days_won"):
        catalogue.metric_catalogue({**tables, "velocity": tables["velocity"].withColumnRenamed("median_cycle_days_won", "x")})
