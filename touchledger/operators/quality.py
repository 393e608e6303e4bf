"""Data-quality checks, run summary and run history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchledger.config import PAID_CHANNELS, QUALITY_THRESHOLDS, Threshold
from touchledger.functions import safe_ratio
from touchledger.operators.membership import Membership

DESCRIPTIONS = {
    "utm_coverage_paid_clicks": "Paid ad clicks that reached the site with their tags, as a share of all paid clicks",
    "identified_session_share": "Web sessions that belong to a known person, as a share of all sessions",
    "unattributed_won_revenue_share": "Won revenue without any touch in the look-back window",
    "deals_missing_contact_share": "Deals the CRM links to no contact",
    "personal_email_contacts_merged": "Personal-email contacts merged into a work contact by phone",
    "personal_email_contacts_unmatched": "Personal-email contacts left without a work contact",
    "clay_signals_matched_share": "Buying signals matched to a known person",
    "reopened_won_deals": "Won deals that had been marked lost before",
}


def _parts(df: DataFrame, check: str, num: Column | None = None, den: Column | None = None) -> DataFrame:
    """One row with a part of a check's numerator and denominator."""
    nothing = F.lit(None).cast("double")
    return df.agg((num if num is not None else nothing).cast("double").alias("num"),
                  (den if den is not None else nothing).cast("double").alias("den")).withColumn(
                      "check_name", F.lit(check))


def data_quality(sessions: DataFrame, spend: DataFrame, opps: DataFrame, anchors: DataFrame,
                 client_map: DataFrame, id_contacts: DataFrame, touches: DataFrame, signals: DataFrame,
                 thresholds: dict[str, Threshold] | None = None, cookies: Membership | None = None) -> DataFrame:
    """One row per check with its value, threshold and status. ``cookies`` are the known ones, if their set is at hand.

    Every source contributes one-row parts; the parts of a check are added up, so shares whose two halves
    come from different tables need no join.
    """
    limits = {**QUALITY_THRESHOLDS, **(thresholds or {})}
    rows, won = F.count(F.lit(1)), F.col("is_won")
    session_totals = sessions.agg(rows.alias("n"), F.count_if(F.col("channel").isin(*PAID_CHANNELS)).alias("tagged"))
    # sessions shrink to one row per cookie before they meet the map, and those of unknown cookies before that
    visits = (cookies.may_hold(sessions, "client_id") if cookies else sessions).groupBy("client_id").agg(rows.alias("n"))
    known_sessions = visits.join(client_map.select("client_id"), "client_id")
    deal_totals = opps.agg(
        F.sum(F.when(won, F.col("amount"))).alias("won_usd"), rows.alias("n"),
        F.count_if("is_missing_contact").alias("missing"), F.count_if("was_reopened").alias("reopened"))
    contact_totals = id_contacts.agg(
        F.count_if(F.col("match_rule") == "phone_match").alias("merged"),
        F.count_if(F.col("match_rule") == "unmatched_personal").alias("unmatched"))
    blind = anchors.filter(F.col("touch_count").isNull() & won)

    def spread(totals: DataFrame, *entries: tuple[str, str | None, str | None]) -> DataFrame:
        """A one-row table of totals as (check, num, den) rows."""
        def part(c):
            return (F.col(c) if c else F.lit(None)).cast("double")
        return totals.select(F.explode(F.array(*[
            F.struct(F.lit(k).alias("check_name"), part(n).alias("num"), part(d).alias("den"))
            for k, n, d in entries])).alias("p")).select("p.*")

    parts = [
        spread(session_totals, ("utm_coverage_paid_clicks", "tagged", None), ("identified_session_share", None, "n")),
        _parts(known_sessions, "identified_session_share", num=F.coalesce(F.sum("n"), F.lit(0))),
        _parts(spend, "utm_coverage_paid_clicks", den=F.sum("clicks")),
        _parts(blind, "unattributed_won_revenue_share", num=F.coalesce(F.sum("amount"), F.lit(0))),
        spread(deal_totals, ("unattributed_won_revenue_share", None, "won_usd"),
               ("deals_missing_contact_share", "missing", "n"), ("reopened_won_deals", "reopened", None)),
        spread(contact_totals, ("personal_email_contacts_merged", "merged", None),
               ("personal_email_contacts_unmatched", "unmatched", None)),
        _parts(touches.filter(F.col("source_system") == "clay").select("source_record_id").distinct(),
               "clay_signals_matched_share", num=rows),
        _parts(signals, "clay_signals_matched_share", den=rows),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    totals = stacked.groupBy("check_name").agg(F.sum("num").alias("num"), F.sum("den").alias("den"))

    counts = ("personal_email_contacts_merged", "personal_email_contacts_unmatched", "reopened_won_deals")
    value = F.when(F.col("check_name").isin(*counts), F.col("num")).otherwise(
        safe_ratio(F.col("num"), F.col("den"), 3))
    rules = F.broadcast(stacked.sparkSession.createDataFrame(
        [(k, DESCRIPTIONS.get(k, k), t.limit, t.direction) for k, t in limits.items()],
        "check_name string, description string, threshold double, direction string"))
    breached = (((F.col("direction") == "min") & (F.col("value") < F.col("threshold")))
                | ((F.col("direction") == "max") & (F.col("value") > F.col("threshold"))))
    return (totals.withColumn("value", value).join(rules, "check_name")
            .select("check_name", "description", "value", "threshold", "direction",
                    F.when(breached, "warn").otherwise("ok").alias("status"),
                    F.current_timestamp().alias("checked_at")))


def run_summary(fct_opps: DataFrame, quality: DataFrame) -> DataFrame:
    """Deals, wins, won revenue and number of warnings, for the run log."""
    won = F.col("is_won")
    zero = F.lit(0).cast("bigint")
    deals = fct_opps.agg(F.count(F.lit(1)).alias("opps"), F.count_if(won).alias("won"),
                         F.sum(F.when(won, F.col("amount"))).alias("won_revenue_usd"), zero.alias("warnings"))
    warned = quality.agg(zero.alias("opps"), zero.alias("won"), F.lit(0).alias("won_revenue_usd"),
                         F.count_if(F.col("status") == "warn").alias("warnings"))
    return deals.unionByName(warned).agg(
        F.sum("opps").alias("opps"), F.sum("won").alias("won"),
        F.coalesce(F.sum("won_revenue_usd"), F.lit(0)).alias("won_revenue_usd"),
        F.sum("warnings").alias("data_quality_warnings"))


def recent_runs(runs: DataFrame, n: int = 14) -> DataFrame:
    """The latest ``n`` runs of the run log."""
    return (runs.select("run_id", "started_at", "finished_at", "status", "summary")
            .orderBy(F.desc("run_id")).limit(n))
