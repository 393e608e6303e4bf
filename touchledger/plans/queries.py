"""Registered queries: each runs one operator over the whole benchmark tables."""

from __future__ import annotations

import json
import math
import uuid
from collections import Counter
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchledger.functions import settle, snap
from touchledger.operators import attribution, contracts, crm, staging
from touchledger.plans import broken, nightly
from touchledger.plans import contracts as contract_plans
from touchledger.plans.warehouse import Warehouse
from touchledger.session import pin
from touchledger.sinks import append_run_log, append_write_log, dashboard_extract
from touchledger.sources import driver_tables, landing
from touchledger.sources.feeds import LOADED_AT, RAW_FEEDS

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Reporting types: money as double in cents, whole numbers as bigint."""
    def one(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            c = settle(c, 2) if field.dataType.scale > 6 else c
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return c.cast("bigint").alias(field.name)
        return c
    return df.select(*[one(f) for f in df.schema.fields])


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    return Warehouse(pin(spark), driver_tables.DriverFeeds(spark, folder))


def _query(build: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, folder: plain(build(warehouse(spark, folder)))


def _layer(name: str, *drop: str) -> Query:
    return _query(lambda wh: getattr(wh, name).drop(*drop))


def _model(name: str) -> Query:
    return _query(lambda wh: attribution.attribute(wh.deal_journeys, name, wh.cfg))


def _end(name: str) -> Query:
    return _query(lambda wh: attribution.end_touch(wh.shared("deal_anchors"), wh.account_touches, name))


def _landed(wh: Warehouse, names: Iterable[str] = RAW_FEEDS) -> dict[str, DataFrame]:
    """Feeds written as CSV exports and landed again."""
    folder = f"{wh.workspace.root}/exports-{uuid.uuid4().hex}"
    for name in names:
        driver_tables.export(driver_tables.as_text(wh.feeds[name]), f"{folder}/{name}.csv")
    return landing.land_raw(wh.spark, folder, tables=list(names))


def _filled(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, column, values, different values) of every column."""
    parts = []
    for name, df in tables.items():
        columns = [c for c in df.columns if c != LOADED_AT]
        counts = df.agg(*[F.struct(F.count(c).alias("n"), F.count_distinct(c).alias("d")).alias(c) for c in columns])
        parts.append(counts.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("table"), F.lit(c).alias("column"), F.col(f"{c}.n").alias("filled"),
                     F.col(f"{c}.d").alias("different")) for c in columns]))))
    return reduce(DataFrame.unionByName, parts)


def _land_raw(wh: Warehouse) -> DataFrame:
    """What staging finds in each of the landed exports."""
    landed = Warehouse(wh.spark, _landed(wh), wh.cfg, wh.workspace)
    return _filled({name: getattr(landed, name) for name in nightly.STAGING})


def _land_split(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with line breaks, commas and quotes as an export, landed again range by range."""
    wh = warehouse(spark, folder)
    docs, root = spark.read.parquet(f"{folder}/documents.parquet"), f"{wh.workspace.root}/exports-{uuid.uuid4().hex}"
    driver_tables.export(docs.select("doc_id", "text", "lang", "source"), f"{root}/documents.csv")
    landed = landing.land_raw(spark, root, tables=["documents"], multi_line="split")["documents"]
    return landed.select(F.col("doc_id").cast("bigint"), "lang", "source", F.length("text").cast("bigint").alias("n_chars"),
                         F.md5("text").alias("text_md5"))


def _drift(wh: Warehouse) -> DataFrame:
    """The landed headers against stored ones, of which one has another order, one lacks a column and one is missing."""
    stored = {k: list(v) for k, v in RAW_FEEDS.items()}
    stored["hubspot_deals"].reverse()
    stored["ga4_sessions"].pop()
    del stored["adroll_daily"]
    return landing.schema_drift(wh.spark, stored, _landed(wh))


def _document(wh: Warehouse) -> dict:
    """The dashboard's document as it was written."""
    wh.write_report_inputs()
    wh.materialise(mart for mart, *_ in nightly.EXTRACTS.values())
    path = f"{wh.workspace.root}/dashboard-{uuid.uuid4().hex}"
    dashboard_extract(nightly.extracts(wh), path, wh.cfg.lookback_days, company="Benchmark Ltd", pitch="Tables, not slides")
    return json.loads(wh.spark.read.text(path).first()[0])


def _dashboard_texts(wh: Warehouse) -> DataFrame:
    """How often each text stands in each field, and how many rows of a result set are followed by one in its order."""
    document, out = _document(wh), Counter()
    for name, found in document.items():
        for row in found if isinstance(found, list) else [found]:
            out.update((name, k, v) for k, v in row.items() if isinstance(v, str) and k != "built_at")
    out["meta", "lookback_days", str(document["meta"]["lookback_days"])] += 1
    for name, (_, *order) in nightly.EXTRACTS.items():
        keys = [[-r[c] if direction is F.desc else r[c] for direction, c in order] for r in document[name]]
        out[name, "in order", ""] = sum(a <= b for a, b in zip(keys, keys[1:]))
    return wh.spark.createDataFrame([(*k, n) for k, n in out.items()], "result_set string, field string, text string, n bigint")


def _dashboard(wh: Warehouse) -> DataFrame:
    document, out = _document(wh), []
    for name, found in document.items():
        found = found if isinstance(found, list) else [found]
        numbers = {k: [r[k] for r in found if isinstance(r[k], (int, float)) and not isinstance(r[k], bool)]
                   for k in (found[0] if name not in ("meta", "metrics") and found else {})}
        out += [(name, k, len(found), len(v), round(math.fsum(v), 4)) for k, v in numbers.items() if v]
    return wh.spark.createDataFrame(out, "result_set string, field string, rows bigint, filled bigint, total double")


def _write_log(wh: Warehouse) -> DataFrame:
    path = f"{wh.workspace.root}/crm_writes"
    append_write_log(wh.changed_rows(), "dry_run", path)
    shown = {p: F.get_json_object("payload", f"$.{p}") for p in crm.PROPERTIES}
    return wh.spark.read.parquet(path).select("system", "object", "domain", "mode", *[c.alias(p) for p, c in shown.items()])


def _run_log(wh: Warehouse) -> DataFrame:
    path = f"{wh.workspace.root}/pipeline_runs"
    append_run_log(wh.feeds["pipeline_runs"].withColumn("steps", F.array(F.struct(F.lit("load").alias("step")))), path)
    return wh.spark.read.parquet(path).select("run_id", "started_at", "finished_at", "status", "steps", "summary")


def _split(wh: Warehouse) -> DataFrame:
    return crm.split_upserts(wh.changed_rows())


def _contracts(of: Callable[[Warehouse, contract_plans.Reader], dict[str, DataFrame]], read: contract_plans.Reader) -> Query:
    """Contracts over tables with faults, so that there is something to find."""
    return _query(lambda wh: contracts.summarise(of(wh, read)))


def _total(name: str) -> Query:
    return _query(lambda wh: contracts.summarise({name: contract_plans.credit_totals(wh, broken.credit(wh))[name]}))


def _row_check(name: str) -> Query:
    return _query(lambda wh: contract_plans.credit_rows(wh, broken.credit(wh)).filter(F.col("contract") == name))


def _exported_truth(wh: Warehouse) -> DataFrame:
    """Models scored against a measured effect that comes as an export, as text."""
    feeds = {**{n: wh.feeds[n] for n in wh.feeds}, "channel_incrementality": driver_tables.as_text(wh.incremental_lift)}
    return Warehouse(wh.spark, feeds, wh.cfg).truth_evaluation


QUERIES: dict[str, Query] = {
    # landing
    "land_raw": _query(_land_raw),
    "land_raw_split": _land_split,
    "schema_drift": _query(_drift),
    "load_manifest": _query(lambda wh: landing.load_manifest(_landed(wh))),
    # staging
    **{n: _layer(n) for n in nightly.STAGING},
    "classify_page_urls": lambda spark, folder: staging.classify_page_urls(driver_tables.pages(pin(spark), folder)),
    # identity
    "identity_contacts": _layer("identity_contacts", "company_id"),
    "identity_people": _layer("identity_people"),
    "identity_email_map": _layer("identity_email_map", "company_id"),
    "identity_client_map": _layer("identity_client_map", "company_id"),
    "match_signals": _layer("match_signals"),
    "lead_events": _layer("lead_events", "company_id"),
    # touches and deals
    "touchpoints": _layer("touchpoints"),
    "opportunities": _layer("opportunities"),
    "deal_lead_moment": _layer("deal_lead_moment"),
    "deal_touch_window": _layer("deal_touch_window"),
    # attribution
    "attr_first_touch": _end("first_touch"),
    "attr_last_non_direct": _end("last_non_direct"),
    "attr_linear": _model("linear"),
    "attr_w_shaped": _model("w_shaped"),
    "attr_time_decay": _model("time_decay"),
    "unpivot_models": _query(lambda wh: attribution.unpivot_models(
        attribution.attribution_weights(wh.deal_journeys, wh.cfg)
        .select("deal_id", "touchpoint_id", *attribution.MODELS))
        .withColumn("credit", snap(F.col("credit"), attribution.CREDIT_DIGITS))),
    "attr_unattributed": _query(
        lambda wh: attribution.unattributed(wh.deal_anchors).select("deal_id", "model", "channel", "credit")),
    "fct_attribution": _query(lambda wh: wh.fct_attribution.withColumns(
        {c: settle(F.col(c), 2) for c in ("credited_pipeline", "credited_won_revenue")})),
    "fct_opportunities": _layer("fct_opportunities"),
    # marts
    **{n: _layer(n) for n in (
        "channel_performance", "channel_summary", "model_disagreement", "funnel_monthly", "velocity",
        "subscription_movements", "retention", "truth_evaluation", "incremental_lift", "dashboard_summary",
        "run_summary", "recent_runs")},
    "truth_evaluation_exported": _query(_exported_truth),
    "data_quality": _layer("data_quality", "checked_at"),
    "metric_catalogue": _layer("metric_catalogue"),
    "dashboard_extract": _query(_dashboard),
    "dashboard_texts": _query(_dashboard_texts),
    # CRM
    "credited_pipeline_by_company": _layer("credited_pipeline_by_company"),
    "channel_score": _query(
        lambda wh: wh.channel_score.withColumns({c: F.round(c, 9) for c in ("win_rank", "rev_rank")})),
    "latest_deal_per_company": _layer("latest_deal_per_company"),
    "crm_payload": _query(lambda wh: wh.crm_payload()),
    "existing_by_domain": _layer("existing_by_domain"),
    "changed_rows": _query(lambda wh: wh.changed_rows()),
    "split_upserts": _query(_split),
    "batch_ids": _query(lambda wh: crm.batch_ids(wh.workspace.settle(crm.placed_for_batches(_split(wh)), "split_upserts"))
                        .select("domain", "action", "batch_id")),
    "append_write_log": _query(_write_log),
    "append_run_log": _query(_run_log),
    # contracts
    "contract_unique": _contracts(contract_plans.unique, broken.doubled),
    "contract_not_null": _query(lambda wh: contracts.summarise({}, contract_plans.not_null(wh, broken.emptied))),
    "contract_relationship": _contracts(contract_plans.relationships, broken.strayed),
    "contract_accepted_values": _contracts(contract_plans.accepted_values, broken.strayed),
    "contract_credit_sum": _total("credit_sums_to_one"),
    "contract_every_deal": _total("every_deal_in_every_model"),
    "contract_no_late_credit": _row_check("no_credit_after_deal_created"),
    "contract_credit_range": _row_check("credit_in_unit_interval"),
    "contract_reconcile": _total("won_revenue_reconciles"),
    "contract_gate": _query(contract_plans.check_all),
}
