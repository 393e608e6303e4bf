"""Company-level results for the CRM, and the difference to what the CRM already holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchledger.config import UNATTRIBUTED
from touchledger.functions import exact_sum
from touchledger.operators.numbering import number_rows, place_rows

PROPERTIES = ("first_touch_channel", "attributed_pipeline", "source_quality_score")
# Weights of win rate and won revenue in the quality score.
WIN_WEIGHT, REVENUE_WEIGHT = 0.6, 0.4


def credited_pipeline_by_company(attribution: DataFrame, fct_opps: DataFrame) -> DataFrame:
    """W-shaped pipeline per company domain; reduced to deals before the join."""
    per_deal = attribution.filter(F.col("model") == "w_shaped").groupBy("deal_id").agg(
        exact_sum(F.col("credited_pipeline")).alias("pipeline"))
    return (fct_opps.select("deal_id", "domain").join(per_deal, "deal_id")
            .groupBy("domain").agg(F.sum("pipeline").alias("attributed_pipeline")))


def channel_score(velocity: DataFrame, summary: DataFrame) -> DataFrame:
    """Rank of each first-touch channel by win rate and by W-shaped won revenue (one row per channel)."""
    revenue = summary.filter(F.col("model") == "w_shaped").select("channel", "won_revenue_usd")
    both = velocity.select(F.col("first_touch_channel").alias("channel"), "win_rate").join(revenue, "channel", "left")
    everything = Window.partitionBy(F.lit(1))

    def ranked(c: str) -> Column:
        return F.percent_rank().over(everything.orderBy(F.coalesce(F.col(c).cast("double"), F.lit(0.0))))

    return both.select("channel", ranked("win_rate").alias("win_rank"), ranked("won_revenue_usd").alias("rev_rank"))


def latest_deal_per_company(fct_opps: DataFrame) -> DataFrame:
    """Newest deal per domain (undated counts as newest, then the higher deal id)."""
    newest = F.max(F.struct(F.col("created_at").isNull().alias("undated"), "created_at", "deal_id",
                            "company_name", "first_touch_channel")).alias("d")
    return fct_opps.groupBy("domain").agg(newest).select(
        "domain", "d.company_name", "d.first_touch_channel", "d.created_at", "d.deal_id")


def crm_payload(latest: DataFrame, credited: DataFrame, score: DataFrame, limit: int | None = None) -> DataFrame:
    """What the CRM should show per company, one row each; with a limit, that many companies of the largest
    attributed pipeline.

    The score is halfway-to-even rounded, as doubles round in the warehouse it mirrors.
    """
    points = 100 * (WIN_WEIGHT * F.coalesce("win_rank", F.lit(0.0)) + REVENUE_WEIGHT * F.coalesce("rev_rank", F.lit(0.0)))
    score = score.select(F.col("channel").alias("first_touch_channel"), "win_rank", "rev_rank")
    rows = (latest.join(credited, "domain", "left").join(F.broadcast(score), "first_touch_channel", "left")
            .select("domain", "company_name",
                    F.coalesce("first_touch_channel", F.lit(UNATTRIBUTED)).alias("first_touch_channel"),
                    F.round(F.round(F.coalesce("attributed_pipeline", F.lit(0)), 6), 0).cast("bigint")
                    .alias("attributed_pipeline"),
                    F.rint(F.round(points, 9)).cast("int").alias("source_quality_score")))
    if limit is None:
        return rows
    return rows.orderBy(F.desc("attributed_pipeline"), "domain").limit(limit)


def existing_by_domain(snapshot: DataFrame, prefix: str = "") -> DataFrame:
    """Current CRM record per lower-case domain; the lowest record id wins, blank domains are left out.

    ``prefix`` is what the portal puts before the three property names.
    """
    domain = F.lower("domain")
    first = F.min(F.struct(F.col("id").cast("bigint").alias("record_id"), *[F.col(prefix + p).alias(p) for p in PROPERTIES]))
    return (snapshot.filter(F.coalesce(domain, F.lit("")) != "").groupBy(domain.alias("domain")).agg(first.alias("r"))
            .select("domain", "r.record_id", *[F.col(f"r.{p}").alias(f"current_{p}") for p in PROPERTIES]))


def _same_number(text: Column, number: Column) -> Column:
    """The CRM shows a number as whole or as decimal text; anything else, also nothing, is a difference."""
    whole = number.cast("string")
    return F.coalesce(text.isin(whole, F.concat(whole, F.lit(".0"))), F.lit(False))


def changed_rows(payload: DataFrame, existing: DataFrame) -> DataFrame:
    """Payload rows the CRM lacks or shows differently, with the record id where there is one."""
    same = (F.col("first_touch_channel").eqNullSafe(F.col("current_first_touch_channel"))
            & _same_number(F.col("current_attributed_pipeline"), F.col("attributed_pipeline"))
            & _same_number(F.col("current_source_quality_score"), F.col("source_quality_score")))
    return (payload.join(existing, "domain", "left").filter(F.col("record_id").isNull() | ~same)
            .select(*payload.columns, "record_id"))


def split_upserts(changed: DataFrame) -> DataFrame:
    """Marks each changed row as an update of a known record or as a new one."""
    return changed.withColumn("action", F.when(F.col("record_id").isNull(), "create").otherwise("update"))


def batch_order() -> list[Column]:
    """Order in which rows are pushed: by action, then largest attributed pipeline first."""
    return [F.col("action"), F.desc("attributed_pipeline"), F.col("domain")]


def placed_for_batches(rows: DataFrame) -> DataFrame:
    """Rows in the order of their push; write the result before ``batch_ids``."""
    return place_rows(rows, batch_order())


def batch_ids(placed: DataFrame, n: int = 100) -> DataFrame:
    """Assigns the rows of each action to batches of at most ``n``, in the order of their push."""
    numbered = number_rows(placed, "_number")
    first = numbered.groupBy("action").agg(F.min("_number").alias("_first"))
    # one row per action
    return (numbered.join(F.broadcast(first), "action")
            .withColumn("batch_id", F.floor((F.col("_number") - F.col("_first")) / n)).drop("_number", "_first"))
