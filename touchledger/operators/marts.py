"""Reporting tables. Each one aggregates before it joins, so the joins see a few hundred rows at most."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchledger.config import MODELS, UNATTRIBUTED
from touchledger.functions import exact_sum, month_of, safe_ratio, settle
from touchledger.operators.attribution import each_model
from touchledger.operators.membership import Membership


def channel_performance(attribution: DataFrame, spend: DataFrame, dim: DataFrame) -> DataFrame:
    """Model x channel x month of deal creation; ad spend of the same channel and month beside it."""
    credit = attribution.groupBy("model", "channel", month_of(F.col("deal_created_at")).alias("month")).agg(
        exact_sum(F.col("credit")).alias("deals"),
        exact_sum(F.when(F.col("is_won"), F.col("credit"))).alias("wins"),
        exact_sum(F.col("credited_pipeline")).alias("pipeline"),
        exact_sum(F.col("credited_won_revenue")).alias("won_revenue"))
    monthly_spend = spend.groupBy("channel", month_of(F.col("spend_date")).alias("month")).agg(
        F.sum("spend_usd").alias("spend_usd"), F.sum("clicks").alias("clicks"))
    groups = F.broadcast(dim.select("channel", "channel_group"))
    return (
        credit.join(monthly_spend, ["channel", "month"], "left").join(groups, "channel", "left")
        .select(
            "model", "channel", "channel_group", "month",
            settle(F.col("deals"), 3).alias("credited_deals"),
            settle(F.coalesce("wins", F.lit(0)), 3).alias("credited_wins"),
            settle(F.col("pipeline"), 2).alias("pipeline_usd"),
            settle(F.col("won_revenue"), 2).alias("won_revenue_usd"),
            "spend_usd", "clicks",
        ))


def channel_summary(performance: DataFrame, spend: DataFrame) -> DataFrame:
    """Model x channel over all time, from the rounded monthly rows, with spend efficiency."""
    totals = performance.groupBy("model", "channel", "channel_group").agg(
        *[F.sum(c).alias(c) for c in ("credited_deals", "credited_wins", "pipeline_usd", "won_revenue_usd")])
    all_spend = spend.groupBy("channel").agg(F.sum("spend_usd").alias("spend_usd"))
    model_revenue = F.sum("won_revenue_usd").over(Window.partitionBy("model"))  # one row per channel
    return (
        totals.withColumn("share_of_won_revenue", safe_ratio(F.col("won_revenue_usd"), model_revenue, 4))
        .join(all_spend, "channel", "left")
        .select(
            "model", "channel", "channel_group", "credited_deals", "credited_wins", "pipeline_usd",
            "won_revenue_usd", "share_of_won_revenue", "spend_usd",
            safe_ratio(F.col("pipeline_usd"), F.col("spend_usd"), 2).alias("pipeline_per_dollar"),
            safe_ratio(F.col("spend_usd"), F.col("credited_wins"), 0).alias("cost_per_credited_win"),
        ))


def model_disagreement(summary: DataFrame) -> DataFrame:
    """How far a channel's share of won revenue moves with the choice of model."""
    shares = summary.groupBy("channel").pivot("model", list(MODELS)).agg(F.max("share_of_won_revenue"))
    values = [F.coalesce(F.col(m), F.lit(0.0)) for m in MODELS]
    swing = F.round(F.greatest(*values) - F.least(*values), 4)
    return (shares.withColumn("swing", swing)
            .withColumn("swing_rank", F.rank().over(Window.orderBy(F.desc("swing")))))  # one row per channel


def funnel_monthly(sessions: DataFrame, client_map: DataFrame, leads: DataFrame, calls: DataFrame,
                   opps: DataFrame, cookies: Membership | None = None) -> DataFrame:
    """Sessions to won revenue per calendar month, from the first to the last month with a session. ``cookies`` are the
    known ones, if their set is at hand.

    Each source is reduced to months on its own; the reduced rows are stacked and added up, so five
    measures need one small aggregate instead of five joins.
    """
    def monthly(df, at, **measures):
        return df.groupBy(month_of(F.col(at)).alias("month")).agg(*[c.alias(n) for n, c in measures.items()])

    visits = (cookies.may_hold(sessions, "client_id") if cookies else sessions).groupBy(
        "client_id", month_of(F.col("started_at")).alias("month")).agg(F.count(F.lit(1)).alias("n"))
    known = visits.join(client_map.select("client_id"), "client_id")
    first_leads = leads.groupBy("person_id").agg(F.min("lead_at").alias("first_lead_at"))
    won = F.col("is_won")
    one = F.count(F.lit(1))
    parts = [
        monthly(sessions, "started_at", sessions=one),
        known.groupBy("month").agg(F.sum("n").alias("identified_sessions")),
        monthly(first_leads, "first_lead_at", new_leads=one),
        monthly(calls.filter(F.col("outcome") == "meeting_booked"), "called_at", voice_meetings_booked=one),
        monthly(opps, "created_at", opps_created=one, pipeline_created_usd=F.sum("amount")),
        monthly(opps.filter("is_closed"), "closed_at", deals_won=F.count_if(won), deals_lost=F.count_if(~won),
                won_revenue_usd=F.sum(F.when(won, F.col("amount")))),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    measures = [c for c in stacked.columns if c != "month"]
    by_month = stacked.filter(F.col("month").isNotNull()).groupBy("month").agg(
        *[F.sum(c).alias(c) for c in measures])

    # One row per calendar month by now, so windows over all rows are small.
    every, in_order = Window.partitionBy(F.lit(1)), Window.partitionBy(F.lit(1)).orderBy("month")
    visited = F.when(F.col("sessions").isNotNull(), F.col("month"))
    spine = (by_month
             .withColumns({"from": F.min(visited).over(every), "to": F.max(visited).over(every)})
             .filter(F.col("month").between(F.col("from"), F.col("to")))
             .withColumn("until", F.coalesce(F.add_months(F.lead("month").over(in_order), -1), F.col("month")))
             .withColumn("at", F.explode(F.sequence("month", "until", F.expr("interval 1 month")))))
    own = F.col("at") == F.col("month")
    filled = {m: F.coalesce(F.when(own, F.col(m)), F.lit(0)).alias(m) for m in measures}
    return spine.select(
        F.col("at").alias("month"), *filled.values(),
        F.when(own, safe_ratio(F.col("deals_won"), F.col("deals_won") + F.col("deals_lost"), 3)).alias("win_rate"),
    ).orderBy("month")


def velocity(fct_opps: DataFrame) -> DataFrame:
    """Win rate and median cycle of won deals per first-touch channel.

    The exact median counts distinct day values per group, so its state is bounded by the cycle length.
    """
    won = F.col("is_won")
    return (
        fct_opps.groupBy(F.coalesce("first_touch_channel", F.lit(UNATTRIBUTED)).alias("first_touch_channel"))
        .agg(F.count(F.lit(1)).alias("opps"),
             F.count_if("is_closed").alias("closed_opps"),
             F.count_if(won).alias("won_opps"),
             F.sum(F.when(won, F.col("amount"))).alias("won_usd"),
             F.count(F.when(won, F.col("amount"))).alias("won_amounts"),
             F.percentile(F.when(won, F.col("cycle_days")), 0.5).alias("median_cycle_days_won"))
        .select("first_touch_channel", "opps", "closed_opps", "won_opps",
                safe_ratio(F.col("won_opps"), F.col("closed_opps"), 3).alias("win_rate"),
                safe_ratio(F.col("won_usd"), F.col("won_amounts"), 0).alias("avg_won_deal_usd"),
                "median_cycle_days_won"))


def subscription_movements(subs: DataFrame, events: DataFrame) -> DataFrame:
    """Recurring revenue gained and lost per subscription; subscriptions without events drop out."""
    def moved(kind: str, sign: int):
        return F.sum(F.when(F.col("event_type") == kind, F.col("mrr_delta_usd") * sign))

    moves = events.groupBy("subscription_id").agg(
        moved("new", 1).alias("starting_mrr"),
        moved("expansion", 1).alias("expansion_mrr"),
        moved("contraction", -1).alias("contraction_mrr"),
        moved("churn", -1).alias("churned_mrr"))
    return subs.select("subscription_id", "domain", "start_date", "current_mrr_usd").join(moves, "subscription_id")


def winning_channel(fct_opps: DataFrame) -> DataFrame:
    """First-touch channel of each domain's latest won deal; a deal without close date counts as latest.

    An aggregate over ordered structs combines partially, unlike a window over all deals of a domain.
    """
    latest = F.max(F.struct(F.col("closed_at").isNull().alias("undated"), "closed_at", "deal_id",
                            "first_touch_channel")).alias("latest")
    return (fct_opps.filter("is_won").groupBy("domain").agg(latest)
            .select("domain", F.col("latest.first_touch_channel").alias("first_touch_channel")))


def retention(movements: DataFrame, fct_opps: DataFrame) -> DataFrame:
    """Net and gross revenue retention per winning channel, and for all customers.

    Gross retention counts a customer with at most their starting revenue.
    """
    sums = ("starting_mrr", "current_mrr_usd", "expansion_mrr", "contraction_mrr", "churned_mrr", "kept_mrr")
    # one row per domain before the join, however many subscriptions a domain has
    per_domain = (movements.withColumn("kept_mrr", F.least("current_mrr_usd", "starting_mrr")).groupBy("domain")
                  .agg(F.count(F.lit(1)).alias("customers"), *[F.sum(c).alias(c) for c in sums]))
    source = F.coalesce("first_touch_channel", F.lit(UNATTRIBUTED)).alias("source")
    grouped = (per_domain.join(winning_channel(fct_opps), "domain", "left").select(source, *per_domain.columns)
               .rollup("source").agg(
                   F.grouping("source").alias("is_total"), F.sum("customers").alias("customers"),
                   *[F.sum(c).alias(c) for c in ("starting_mrr", "current_mrr_usd", "kept_mrr")],
                   *[F.coalesce(F.sum(c), F.lit(0)).alias(c)
                     for c in ("expansion_mrr", "contraction_mrr", "churned_mrr")]))
    return grouped.select(
        F.when(F.col("is_total") == 1, "all_customers").otherwise(F.col("source")).alias("first_touch_channel"),
        "customers",
        F.round("starting_mrr", 2).alias("starting_mrr_usd"),
        F.round("expansion_mrr", 2).alias("expansion_mrr_usd"),
        F.round("contraction_mrr", 2).alias("contraction_mrr_usd"),
        F.round("churned_mrr", 2).alias("churned_mrr_usd"),
        F.round("current_mrr_usd", 2).alias("current_mrr_usd"),
        safe_ratio(F.col("current_mrr_usd"), F.col("starting_mrr"), 3).alias("net_revenue_retention"),
        safe_ratio(F.col("kept_mrr"), F.col("starting_mrr"), 3).alias("gross_revenue_retention"),
    )


def truth_evaluation(summary: DataFrame, truth: DataFrame) -> DataFrame:
    """Error of each model's channel shares against the channels' measured incremental shares.

    The grid is truth channels x models (a few dozen rows), grown from the truth side; model shares of
    channels the truth does not know are ignored.
    """
    effect = F.greatest(F.col("expected_incremental_revenue").cast("double"), F.lit(0.0))
    everything = Window.partitionBy(F.lit(1))
    true_share = F.col("effect") / F.nullif(F.sum("effect").over(everything), F.lit(0.0))
    grid = (truth.select("channel", effect.alias("effect")).withColumn("true_share", true_share)
            .withColumn("model", each_model())
            .join(summary.select("model").distinct(), "model", "left_semi"))
    scored = (
        grid.join(summary.select("model", "channel", "share_of_won_revenue"), ["model", "channel"], "left")
        .withColumn("model_share", F.coalesce("share_of_won_revenue", F.lit(0.0)))
        .withColumn("mae", F.avg(F.abs(F.col("model_share") - F.col("true_share"))).over(Window.partitionBy("model"))))
    mae = settle(F.col("mae"), 4, 10)
    return scored.select(
        "model", "channel",
        settle(F.col("true_share"), 4, 10).alias("true_share"),
        F.round("model_share", 4).alias("model_share"),
        settle(F.col("model_share") - F.col("true_share"), 4, 10).alias("error"),
        mae.alias("model_mean_abs_error"),
        F.dense_rank().over(everything.orderBy(mae)).alias("model_rank"),
    )


def dashboard_summary(fct_opps: DataFrame) -> DataFrame:
    """Headline counts and revenue over all deals."""
    won = F.col("is_won")
    return fct_opps.agg(
        F.count(F.lit(1)).alias("opps"),
        F.count_if(won).alias("won"),
        F.count_if("is_closed").alias("closed"),
        F.coalesce(F.sum("amount"), F.lit(0)).alias("pipeline_usd"),
        F.coalesce(F.sum(F.when(won, F.col("amount"))), F.lit(0)).alias("won_revenue_usd"),
        F.min("created_at").cast("date").alias("first_deal"),
        F.max("created_at").cast("date").alias("last_deal"))
