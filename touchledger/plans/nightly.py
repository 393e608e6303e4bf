"""A whole run: build, check, publish, log.

Every run writes its tables into a folder of its own under the root. Publishing only adds a row that names
this folder, after all contracts hold. So nothing is copied, readers switch from one complete set of tables
to the next, and a failed run leaves the published one in place.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchledger.config import AttributionConfig
from touchledger.operators.numbering import PLACE
from touchledger.plans.contracts import check_all, check_phones, check_unambiguous
from touchledger.plans.warehouse import Warehouse
from touchledger.plans.workspace import Workspace
from touchledger.sinks import append_run_log, dashboard_extract

STAGING = ("stg_companies", "stg_contacts", "stg_deals", "stg_stage_history", "stg_sessions", "stg_form_fills",
           "stg_email_events", "stg_signals", "stg_bot_threads", "stg_calls", "stg_spend_daily", "stg_subscriptions",
           "stg_subscription_events")
# Tables in the order of their dependencies: what has been written is what later layers read.
IDENTITY = ("identity_contacts", "identity_people", "identity_email_map")
# The pairs of deals and touches are joined once and written, for the window table and the fact table are both made of them.
INTERMEDIATE = ("identity_client_map", "lead_events", "touchpoints", "opportunities", "deal_journeys", "deal_touch_window")
MARTS = ("fct_attribution", "fct_opportunities", "channel_performance", "channel_summary", "model_disagreement",
         "funnel_monthly", "velocity", "retention", "truth_evaluation", "data_quality")
# Result set of the dashboard -> mart and reading order.
EXTRACTS = {
    "monthly": ("funnel_monthly", [F.asc, "month"]),
    "channels": ("channel_summary", [F.asc, "model"], [F.desc, "won_revenue_usd"]),
    "disagreement": ("model_disagreement", [F.desc, "swing"]),
    "truth": ("truth_evaluation", [F.asc, "model"], [F.desc, "true_share"]),
    "velocity": ("velocity", [F.desc, "opps"]),
    "retention": ("retention", [F.desc, "customers"]),
    "quality": ("data_quality", [F.asc, "check_name"]),
}


def extracts(wh: Warehouse) -> dict[str, DataFrame]:
    """The nine result sets of the dashboard, each a bounded report in its reading order."""
    results = {"summary": wh.dashboard_summary}
    for name, (mart, *order) in EXTRACTS.items():
        rows = wh.latest(mart).drop("checked_at")
        # ties in the order of the other columns, or they would lie as a join has left them
        results[name] = rows.orderBy(*[direction(c) for direction, c in order], *rows.columns)
    results["runs"] = wh.recent_runs
    return results


def run(spark: SparkSession, feeds: Mapping[str, DataFrame], root: str, run_id: int,
        cfg: AttributionConfig = AttributionConfig(), revision: str | None = None, company: str = "",
        pitch: str = "") -> Warehouse:
    """Builds all layers, publishes them once every contract holds, and logs the run either way.

    ``company`` and ``pitch`` head the dashboard.
    """
    started = datetime.now(timezone.utc)
    wh = Warehouse(spark, feeds, cfg, Workspace(spark, root))
    steps: list[tuple[str, bool]] = []
    summary: dict[str, float] = {}

    def step(name: str, action) -> None:
        steps.append((name, False))
        action()
        steps[-1] = (name, True)

    def publish() -> None:
        dashboard_extract(extracts(wh), f"{wh.workspace.root}/dashboard", cfg.lookback_days, company=company, pitch=pitch)
        summary.update({k: float(v) for k, v in wh.run_summary.first().asDict().items()})
        (spark.createDataFrame([(run_id, wh.workspace.root, datetime.now(timezone.utc))],
                               "run_id bigint, folder string, published_at timestamp")
         .coalesce(1).write.mode("append").parquet(f"{root}/published"))

    try:
        # Written, so that a later session can read them by name, and so that raw text is parsed once.
        step("staging", lambda: wh.materialise(STAGING))
        # Before contacts meet by phone: one that very many share would multiply them.
        step("phones", lambda: check_phones(wh))
        step("identity", lambda: wh.materialise(IDENTITY))
        # Before any touches are built: an ambiguous key would multiply them.
        step("unambiguous", lambda: check_unambiguous(wh))
        step("build", lambda: wh.materialise((*INTERMEDIATE, *MARTS)))
        step("contracts", lambda: check_all(wh))
        step("publish", publish)
        return wh
    finally:
        status = "success" if steps[-1] == ("publish", True) else "failed"
        log = spark.createDataFrame(
            [(run_id, started, datetime.now(timezone.utc), status, steps, summary, revision)],
            "run_id bigint, started_at timestamp, finished_at timestamp, status string, "
            "steps array<struct<step string, ok boolean>>, summary map<string,double>, revision string")
        append_run_log(log.coalesce(1), f"{root}/pipeline_runs")


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the latest published run."""
    folder = spark.read.parquet(f"{root}/published").orderBy(F.desc("published_at")).first()["folder"]
    return spark.read.parquet(f"{folder}/{name}").drop(*PLACE)


def prune(spark: SparkSession, root: str, keep: int = 3, unpublished_hours: float = 48.0) -> list[str]:
    """Deletes the folders of old runs and returns their paths.

    The ``keep`` latest published runs stay, and so does every unpublished one that was begun less than
    ``unpublished_hours`` ago, for it may still be running. Logs and the list of published runs stay whole.
    """
    if keep < 1:
        raise ValueError("the published run must stay")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # a row per run, and a folder per run
    runs = spark.read.parquet(f"{root}/published").orderBy(F.desc("published_at")).select("folder").collect()
    names = [r["folder"].rstrip("/").rsplit("/", 1)[-1] for r in runs]
    stay, published = set(names[:keep]), set(names)
    oldest = (datetime.now(timezone.utc).timestamp() - unpublished_hours * 3600) * 1000
    gone = []
    for status in system.listStatus(path):
        name = status.getPath().getName()
        if not status.isDirectory() or not name.startswith("run-") or name in stay:
            continue
        if name in published or status.getModificationTime() < oldest:
            system.delete(status.getPath(), True)
            gone.append(f"{root.rstrip('/')}/{name}")
    return sorted(gone)
