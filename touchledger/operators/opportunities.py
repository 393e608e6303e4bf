"""Deals with their outcome, and the moment each account became a lead before a deal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchledger.config import AttributionConfig
from touchledger.functions import whole_days_between
from touchledger.operators.journeys import in_lookback


def opportunities(deals: DataFrame, history: DataFrame, companies: DataFrame) -> DataFrame:
    """One row per deal. Won or lost is the current stage; history only supplies the dates.

    A won deal without any history has an unknown (NULL) reopened flag.
    """
    def last_time(stage: str):
        return F.max(F.when(F.col("stage") == stage, F.col("changed_at")))

    outcomes = history.groupBy("deal_id").agg(
        last_time("closedwon").alias("won_at"),
        last_time("closedlost").alias("lost_at"),
        F.count_if(F.col("stage") == "closedlost").alias("times_lost"))
    named = companies.select("company_id", "company_name", "domain", "industry", "size_band")
    ended = F.when(F.col("is_won"), F.col("won_at")).otherwise(F.col("lost_at"))
    closed = F.col("is_won") | F.col("is_closed")
    return (
        deals.join(outcomes, "deal_id", "left").join(named, "company_id", "left")
        .select(
            "deal_id", "deal_name", "company_id", "company_name", "domain", "industry", "size_band", "contact_id",
            F.col("contact_id").isNull().alias("is_missing_contact"),
            "amount", "created_at", "current_stage", "is_closed", "is_won",
            F.when(closed, ended).alias("closed_at"),
            F.when(F.col("is_closed"), whole_days_between(ended, F.col("created_at"))).alias("cycle_days"),
            (F.col("is_won") & (F.col("times_lost") > 0)).alias("was_reopened"),
        ))


def deal_lead_moment(opps: DataFrame, leads: DataFrame, cfg: AttributionConfig = AttributionConfig()) -> DataFrame:
    """First time anyone at the account became a lead inside the deal's look-back window."""
    moments = leads.select("company_id", "lead_at").distinct()
    deals = opps.select("deal_id", "company_id", "created_at")
    return in_lookback(moments, "lead_at", deals, cfg).groupBy("deal_id").agg(F.min("lead_at").alias("lead_at"))
