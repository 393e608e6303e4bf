"""Five ways to split a deal's revenue over its touches.

Every weight is a plain expression over one deal x touch row, because the row already carries the
landmarks of its deal (see operators.journeys). No window function and no shuffle is involved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchledger.config import MODELS, UNATTRIBUTED, AttributionConfig
from touchledger.functions import snap, surrogate_key

# Decimals of a credit in the fact table.
CREDIT_DIGITS = 8


def _one_if(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def _w_shaped(cfg: AttributionConfig) -> Column:
    """Anchor weight on first, lead and last touch (adding up where they coincide), the rest shared evenly
    by the other touches, scaled to a total of one.

    With three touches and coinciding anchors there is no rest to share: the middle touch has no weight
    (NULL) and drops out.
    """
    n, count = F.col("touch_number"), F.col("touch_count")
    lead = F.coalesce(F.col("lead_touch_number"), F.lit(1))
    a = float(cfg.anchor_weight)
    hits = _one_if(n == 1) + _one_if(n == lead) + _one_if(n == count)
    share = F.lit(1.0 - 3 * a) / F.nullif(count - 3, F.lit(0))
    landmarks = F.lit(1) + F.when(count > 1, 1).otherwise(0) + F.when((lead > 1) & (lead < count), 1).otherwise(0)
    total = F.lit(3 * a) + F.coalesce((count - landmarks) * share, F.lit(0.0))
    return F.when(hits > 0, hits * a).otherwise(share) / F.nullif(total, F.lit(0.0))


def model_weights(cfg: AttributionConfig = AttributionConfig()) -> dict[str, Column]:
    """Model -> credit expression over a journey row."""
    n, count = F.col("touch_number"), F.col("touch_count")
    return {
        "first_touch": _one_if(n == 1),
        "last_non_direct": _one_if(n == F.coalesce(F.col("last_non_direct_number"), count)),
        "linear": F.lit(1.0) / count,
        "w_shaped": _w_shaped(cfg),
        "time_decay": F.col("decay") / F.col("decay_total"),
    }


def attribution_weights(journeys: DataFrame, cfg: AttributionConfig = AttributionConfig()) -> DataFrame:
    """Journeys with one credit column per model."""
    return journeys.withColumns(model_weights(cfg))


def unpivot_models(weights: DataFrame) -> DataFrame:
    """Credit columns -> rows (model, credit); rows without credit vanish."""
    kept = [c for c in weights.columns if c not in MODELS]
    return weights.unpivot(kept, list(MODELS), "model", "credit").filter(F.col("credit") > 0)


def attribute(journeys: DataFrame, model: str, cfg: AttributionConfig = AttributionConfig()) -> DataFrame:
    """Credit of a single model."""
    return (journeys.withColumn("credit", model_weights(cfg)[model]).filter(F.col("credit") > 0)
            .select("deal_id", "touchpoint_id", "channel", snap(F.col("credit"), CREDIT_DIGITS).alias("credit")))


def each_model() -> Column:
    return F.explode(F.array(*[F.lit(m) for m in MODELS]))


def unattributed(anchors: DataFrame) -> DataFrame:
    """Deals without a touch: one row per model that keeps the whole deal."""
    return (anchors.filter(F.col("touch_count").isNull())
            .withColumn("model", each_model())
            .withColumns({
                "touchpoint_id": F.lit(None).cast("string"),
                "channel": F.lit(UNATTRIBUTED),
                "touched_at": F.lit(None).cast("timestamp"),
                "credit": F.lit(1.0),
            }))


def fct_attribution(journeys: DataFrame, anchors: DataFrame,
                    cfg: AttributionConfig = AttributionConfig()) -> DataFrame:
    """Credit per deal, model and touch; every deal hands out one whole credit in every model.

    Money is the amount times the unrounded credit, as a double per row; add it up with ``exact_sum``.
    """
    facts = ["deal_id", "model", "touchpoint_id", "channel", "touched_at", "credit", "amount", "created_at",
             "closed_at", "is_won"]
    # only what the fact table needs enters the five-fold unpivot
    wide = journeys.select("deal_id", "touchpoint_id", "channel", "touched_at", "amount", "created_at",
                           "closed_at", "is_won",
                           *[c.alias(m) for m, c in model_weights(cfg).items()])
    rows = unpivot_models(wide).select(*facts).unionByName(unattributed(anchors).select(*facts))
    money = F.col("amount").cast("double") * F.col("credit")
    return rows.select(
        surrogate_key(F.col("deal_id"), F.col("model"), F.col("touchpoint_id")).alias("attribution_id"),
        "deal_id", "model", "touchpoint_id", "channel", "touched_at",
        snap(F.col("credit"), CREDIT_DIGITS).alias("credit"),
        F.col("created_at").alias("deal_created_at"),
        "closed_at", "is_won",
        money.alias("credited_pipeline"),
        F.when(F.col("is_won"), money).otherwise(F.lit(0.0)).alias("credited_won_revenue"),
    )


def end_touch(anchors: DataFrame, touches: DataFrame, model: str) -> DataFrame:
    """The one touch per deal that takes the whole credit in ``first_touch`` or ``last_non_direct``.

    Pass one has its number in the account's timeline, so one equi-join with a row per deal finds it.
    """
    numbers = {"first_touch": F.col("first_seq"),
               "last_non_direct": F.col("first_seq") - 1 + F.coalesce("last_non_direct_number", "touch_count")}
    deals = anchors.filter(F.col("touch_count").isNotNull()).select("deal_id", numbers[model].alias("account_seq"))
    return (deals.join(touches.select("account_seq", "touchpoint_id", "channel"), "account_seq")
            .select("deal_id", "touchpoint_id", "channel", F.lit(1.0).alias("credit")))


def fct_opportunities(opps: DataFrame, anchors: DataFrame, touches: DataFrame) -> DataFrame:
    """Deals with the channel of their first and of their last non-direct touch."""
    def channel(model: str) -> DataFrame:
        return end_touch(anchors, touches, model).select("deal_id", F.col("channel").alias(f"{model}_channel"))

    untouched = anchors.select("deal_id", F.col("touch_count").isNull().alias("untouched"))
    joined = (opps.join(untouched, "deal_id", "left").join(channel("first_touch"), "deal_id", "left")
              .join(channel("last_non_direct"), "deal_id", "left"))
    return joined.select(*opps.columns, *[
        F.when(F.col("untouched"), F.lit(UNATTRIBUTED)).otherwise(F.col(c)).alias(c)
        for c in ("first_touch_channel", "last_non_direct_channel")])
