"""The touches before each deal.

First, what each deal must know of its own look-back window: its first, last, last non-direct and lead touch, and the
total of the decay. Each is an as-of lookup of a moment on its account's timeline (``operators.asof``), so no pair of a
deal and a touch is formed for them, however many touches an account has: numbers of touches are differences of running
counts, the decay total a difference of running sums, each relative to the start of its time block so that the powers stay
in range.

Then the pairs. Deals and touches meet on account and time bucket: a deal is repeated for the few buckets its look-back
window covers, a touch stays single. That prunes pairs outside the window before they are formed, and spreads the history
of a busy account over many join keys; adaptive execution splits what is still skewed. The deal side has the landmarks,
so every pair is weighted on the spot, and the pairs, the largest relation of all, are never shuffled, sorted or written.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchledger.config import DIRECT_CHANNELS, AttributionConfig
from touchledger.functions import DAY_MICROS, days_between, time_bucket
from touchledger.operators.asof import as_of
from touchledger.operators.membership import Membership


def _spread(deals: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """A row per deal and time bucket that its window touches."""
    created, width = F.unix_micros("created_at"), float(cfg.bucket_days * DAY_MICROS)
    return (deals.filter(F.col("created_at").isNotNull() & F.col("company_id").isNotNull())
            .withColumn("bucket", F.explode(F.sequence(F.floor((created - cfg.lookback_days * DAY_MICROS) / width),
                                                       F.floor(created / width)))))


def in_lookback(events: DataFrame, at: str, deals: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Pairs of a deal and an event of its account with created − look-back < event time <= created."""
    lookback, created, spread = cfg.lookback_days * DAY_MICROS, F.unix_micros("created_at"), _spread(deals, cfg)
    placed = events.withColumn("bucket", time_bucket(F.col(at), cfg.bucket_days))
    when = F.unix_micros(at)
    # events on the left: a sort-merge join streams its left side and buffers only the deals of one key
    return (placed.join(spread, ["company_id", "bucket"])
            .filter((when <= created) & (when > created - lookback)).drop("bucket"))


def _decay(age_days: Column, cfg: AttributionConfig) -> Column:
    return F.pow(F.lit(0.5), age_days / F.lit(float(cfg.half_life_days)))


def _blocks(cfg: AttributionConfig) -> tuple[int, int]:
    """How many time blocks a look-back window is, and their width; one is 500 half-lives at most."""
    lookback = cfg.lookback_days * DAY_MICROS
    number = max(1, math.ceil(cfg.lookback_days / (500 * cfg.half_life_days)))
    return number, math.ceil(lookback / number)


def _growth(micros: Column, cfg: AttributionConfig) -> Column:
    """The inverse of the decay over a time."""
    return F.pow(F.lit(2.0), micros / F.lit(cfg.half_life_days * DAY_MICROS))


def window_probes(opps: DataFrame, account_touches: DataFrame, lead_moment: DataFrame,
                  cfg: AttributionConfig = AttributionConfig()) -> DataFrame:
    """Touches, and the moments that deals ask about, as ``asof`` takes them. Place and write the result.

    A deal asks at its creation, at the start of its window, at the end of every time block between the two, and when its
    account became a lead, if that was before.
    """
    _, width = _blocks(cfg)
    at, created = F.unix_micros("touched_at"), F.unix_micros("created_at")
    block = F.floor(F.col("at") / F.lit(float(width)))
    touches = account_touches.filter(F.col("company_id").isNotNull()).select(
        F.col("company_id").alias("account"), at.alias("at"), F.lit(0).alias("kind"), F.col("account_seq").alias("seq"),
        F.when(~F.col("channel").isin(*DIRECT_CHANNELS), F.col("account_seq")).alias("marked"),
        F.lit(None).cast(opps.schema["deal_id"].dataType).alias("deal_id"), F.lit(None).cast("string").alias("probe"),
        F.lit(None).cast("bigint").alias("created"))
    deals = (opps.select("deal_id", "company_id", "created_at").join(lead_moment, "deal_id", "left")
             .filter(F.col("created_at").isNotNull() & F.col("company_id").isNotNull()))
    start = created - cfg.lookback_days * DAY_MICROS

    def probe(name: str, moment: Column) -> Column:
        return F.struct(F.lit(name).alias("probe"), moment.cast("bigint").alias("at"))

    first, last = (F.floor(t / F.lit(float(width))) for t in (start, created))
    ends = F.transform(F.sequence(first, last - 1), lambda b: probe("end", (b + 1) * width - 1))
    asked = F.concat(F.array(probe("start", start), probe("created", created)), F.when(last > first, ends).otherwise(F.array()),
                     F.when(F.col("lead_at").isNotNull(), F.array(probe("lead", F.least(F.unix_micros("lead_at"), created))))
                     .otherwise(F.array()))
    moments = deals.select(
        F.col("company_id").alias("account"), "deal_id", created.alias("created"), F.explode(asked).alias("p")).select(
        "account", "p.at", F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("seq"),
        F.lit(None).cast("bigint").alias("marked"), "deal_id", "p.probe", "created")
    return (touches.unionByName(moments).withColumn("block", block)
            .withColumn("weight", F.when(F.col("kind") == 0, _growth(F.col("at") - F.col("block") * width, cfg))))


def deal_anchors(opps: DataFrame, probes: DataFrame, lead_moment: DataFrame,
                 cfg: AttributionConfig = AttributionConfig()) -> DataFrame:
    """One row per deal: its facts, and the landmarks of its look-back window (NULL without a touch).

    ``probes`` is the written table of ``window_probes``, placed in the order of ``asof``.
    """
    deals = (opps.select("deal_id", "company_id", "amount", "created_at", "closed_at", "is_won")
             .join(lead_moment, "deal_id", "left"))
    _, width = _blocks(cfg)
    known = as_of(probes)
    is_ = {name: F.col("probe") == name for name in ("start", "end", "created", "lead")}
    # weights grow from the start of their block; a window has all of its blocks, less what is before its start
    share = F.col("block_weight") / _growth(F.col("created") - F.col("block") * width, cfg)
    at = {name: F.max(F.when(is_[name], F.col("n"))) for name in ("start", "created", "lead")}
    seen = known.groupBy("deal_id").agg(
        (at["created"] - at["start"]).alias("touch_count"), (at["lead"] - at["start"]).alias("lead_number"),
        F.max(F.when(is_["created"], F.col("last_seq"))).alias("last_seq"),
        F.max(F.when(is_["created"], F.col("last_marked"))).alias("last_marked"),
        F.sum(F.when(is_["start"], -share).otherwise(F.when(~is_["lead"], share))).alias("decay_total"))
    first = F.col("last_seq") - F.col("touch_count") + 1
    number = F.col("last_marked") - F.col("first_seq") + 1
    landmarks = seen.filter("touch_count > 0").select("deal_id", "touch_count", "lead_number", "last_marked", "decay_total",
                                                      first.alias("first_seq"))
    return deals.join(landmarks, "deal_id", "left").select(
        *deals.columns, "first_seq", "touch_count",
        F.when(number > 0, number).alias("last_non_direct_number"),
        F.when(F.col("lead_number") > 0, F.col("lead_number")).alias("lead_touch_number"),
        "decay_total")


def candidate_pairs(opps: DataFrame, account_touches: DataFrame, cfg: AttributionConfig = AttributionConfig()) -> DataFrame:
    """One row with the number of pairs that deals and touches would form by account and time bucket, from counts alone."""
    key = ["company_id", "bucket"]
    touches = (account_touches.groupBy("company_id", time_bucket(F.col("touched_at"), cfg.bucket_days).alias("bucket"))
               .agg(F.count(F.lit(1)).alias("touches")))
    deals = (_spread(opps.select("company_id", "created_at"), cfg).groupBy(*key).agg(F.count(F.lit(1)).alias("deals")))
    product = F.col("touches").cast("decimal(19,0)") * F.col("deals")
    return touches.join(deals, key).agg(F.coalesce(F.sum(product.cast("decimal(38,0)")), F.lit(0)).alias("pairs"))


def deal_anchors_by_pairs(opps: DataFrame, account_touches: DataFrame, lead_moment: DataFrame,
                          cfg: AttributionConfig = AttributionConfig(), touched: Membership | None = None) -> DataFrame:
    """``deal_anchors`` from the pairs of deals and touches themselves, for accounts with few touches to a deal.

    The pairs are aggregated in the tasks that form them. With ``touched``, the accounts that have touches, deals of others
    are not spread over time buckets and shuffled.
    """
    deals = (opps.select("deal_id", "company_id", "amount", "created_at", "closed_at", "is_won")
             .join(lead_moment, "deal_id", "left"))
    asked = deals.select("deal_id", "company_id", "created_at", "lead_at")
    pairs = in_lookback(account_touches.select("company_id", "touched_at", "channel", "account_seq"), "touched_at",
                        touched.may_hold(asked, "company_id") if touched else asked, cfg)
    seq, age = F.col("account_seq"), days_between(F.col("created_at"), F.col("touched_at"))
    landmarks = pairs.groupBy("deal_id").agg(
        F.min(seq).alias("first_seq"),
        F.max(seq).alias("last_seq"),
        F.max(F.when(~F.col("channel").isin(*DIRECT_CHANNELS), seq)).alias("non_direct_seq"),
        F.max(F.when(F.col("touched_at") <= F.col("lead_at"), seq)).alias("lead_seq"),
        F.sum(_decay(age, cfg)).alias("decay_total"))
    place = lambda c: F.col(c) - F.col("first_seq") + 1
    return deals.join(landmarks, "deal_id", "left").select(
        *deals.columns, "first_seq",
        place("last_seq").alias("touch_count"),
        place("non_direct_seq").alias("last_non_direct_number"),
        place("lead_seq").alias("lead_touch_number"),
        "decay_total")


def deal_journeys(anchors: DataFrame, account_touches: DataFrame,
                  cfg: AttributionConfig = AttributionConfig()) -> DataFrame:
    """Every deal x touch pair of the look-back windows with the deal's facts and landmarks."""
    touched = anchors.filter(F.col("touch_count").isNotNull())
    touches = account_touches.select("company_id", "touchpoint_id", "person_id", "touched_at", "channel",
                                     "touch_type", "account_seq")
    age = days_between(F.col("created_at"), F.col("touched_at"))
    return (in_lookback(touches, "touched_at", touched, cfg)
            .withColumn("days_before_deal", age)
            .withColumn("decay", _decay(age, cfg))
            .withColumn("touch_number", F.col("account_seq") - F.col("first_seq") + 1)
            .drop("first_seq", "account_seq"))


def deal_touch_window(journeys: DataFrame) -> DataFrame:
    """The look-back windows as a table: one row per deal and touch."""
    return journeys.select("deal_id", "touchpoint_id", "person_id", "touched_at", "channel", "touch_type",
                           "days_before_deal", F.col("touch_number").cast("int").alias("touch_number"),
                           "touch_count", "lead_at")
