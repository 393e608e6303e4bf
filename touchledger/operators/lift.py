"""Measured channel effect from runs with and without a channel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchledger.functions import settle


def incremental_lift(replicates: DataFrame, baseline: str = "none") -> DataFrame:
    """Mean revenue lost when a channel is off, paired with the same replicate's baseline.

    ``replicates`` holds replicate, disabled_channel and won_revenue, one row per run.
    """
    full = replicates.filter(F.col("disabled_channel") == baseline).select(
        "replicate", F.col("won_revenue").alias("full_revenue"))
    paired = replicates.filter(F.col("disabled_channel") != baseline).join(full, "replicate")
    lost = (F.col("full_revenue") - F.col("won_revenue")).cast("double")
    return paired.groupBy(F.col("disabled_channel").alias("channel")).agg(
        F.count(F.lit(1)).alias("replicates"),
        settle(F.avg(lost), 2).alias("expected_incremental_revenue"),
        settle(F.stddev_samp(lost) / F.sqrt(F.count(F.lit(1))), 2).alias("std_error"),
        settle(F.avg(F.col("full_revenue").cast("double")), 2).alias("expected_won_revenue"))
