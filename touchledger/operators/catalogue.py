"""Metric definitions and where to find each metric."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Metric name, table, column, grain, version. The last two are the definition and its history.
METRICS = (
    ("won_revenue_by_model", "channel_summary", "won_revenue_usd", "model, channel", 2,
     "Won deal amounts split over channels by the chosen model; won means the deal's current stage",
     "v1 took any closedlost in the history as lost; v2 looks at the current stage, so that reopened deals count once"),
    ("pipeline_by_model", "channel_summary", "pipeline_usd", "model, channel", 1,
     "Amounts of all deals created, open or closed, split over channels by the chosen model", None),
    ("share_of_won_revenue", "channel_summary", "share_of_won_revenue", "model, channel", 1,
     "A channel's part of all won revenue under one model, unattributed revenue included", None),
    ("pipeline_per_dollar", "channel_summary", "pipeline_per_dollar", "model, channel", 1,
     "Credited pipeline per dollar of ad spend of the same channel, all time", None),
    ("cost_per_credited_win", "channel_summary", "cost_per_credited_win", "model, channel", 1,
     "Ad spend per credited (possibly fractional) win", None),
    ("model_swing", "model_disagreement", "swing", "channel", 1,
     "Highest minus lowest share of won revenue over the five models", None),
    ("win_rate", "funnel_monthly", "win_rate", "month", 1,
     "Won deals among the deals closed in the month", None),
    ("median_cycle_days_won", "velocity", "median_cycle_days_won", "first_touch_channel", 1,
     "Median days from creation to win, by the channel of the first touch", None),
    ("new_leads", "funnel_monthly", "new_leads", "month", 1,
     "People whose first demo form or interested reply fell in the month", None),
    ("net_revenue_retention", "retention", "net_revenue_retention", "first_touch_channel", 1,
     "Current over starting recurring revenue, by the first-touch channel of the winning deal", None),
    ("gross_revenue_retention", "retention", "gross_revenue_retention", "first_touch_channel", 2,
     "As net retention, but a customer counts with at most the starting revenue",
     "v1 subtracted contraction and churn and could fall below zero; v2 caps each customer at the starting revenue"),
    ("unattributed_won_revenue_share", "data_quality", "value", "check_name", 1,
     "Part of won revenue whose deals have no touch in the look-back window", None),
    ("model_mean_abs_error", "truth_evaluation", "model_mean_abs_error", "model, channel", 1,
     "Mean distance of a model's channel shares from the measured incremental shares", None),
    ("attributed_pipeline", "crm_payload", "attributed_pipeline", "company", 1,
     "W-shaped pipeline of all deals of a company, as pushed to the CRM", None),
    ("source_quality_score", "crm_payload", "source_quality_score", "company", 1,
     "0 to 100 score of the first-touch channel: 60% win rate rank, 40% W-shaped won revenue rank", None),
)


def metric_definitions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(METRICS), "name string, source_table string, source_column string, grain string, version int, definition string, changelog string")


def metric_catalogue(tables: dict[str, DataFrame]) -> DataFrame:
    """Every metric with the number of values its column holds now.

    Raises when a definition points to a column that its table does not have.
    """
    wanted: dict[str, list[str]] = {}
    for _, table, column, *_ in METRICS:
        wanted.setdefault(table, [])
        if column not in wanted[table]:
            wanted[table].append(column)
    missing = [f"{t}.{c}" for t, cols in wanted.items() for c in cols
               if t not in tables or c not in tables[t].columns]
    if missing:
        raise ValueError(f"metrics refer to unknown columns: {', '.join(missing)}")

    filled = None
    for table, cols in wanted.items():
        df = tables[table]
        if table == "data_quality":  # a metric kept as a row, not as a column
            df = df.filter(F.col("check_name") == "unattributed_won_revenue_share")
        counts = (df.agg(*[F.count(c).alias(c) for c in cols]).unpivot([], cols, "source_column", "filled_values")
                  .withColumn("source_table", F.lit(table)))
        filled = counts if filled is None else filled.unionByName(counts)
    spark = filled.sparkSession
    return F.broadcast(metric_definitions(spark)).join(filled, ["source_table", "source_column"]).select(
        "name", "source_table", "source_column", "grain", "version", "definition", "changelog", "filled_values")
