"""The benchmark tables (customer, orders, lineitem, events, pages) read as raw feeds.

Every row of a table takes part; which feed a row belongs to follows from its own columns, and the values
a table lacks are derived from its keys. FIXTURES.md section 4 lists the mapping.

Values that are typed in the tables stay typed: staging casts them all the same, and for a typed value that
costs nothing. Text remains where a feed is text by nature or a surrogate key is taken over it; ``as_text``
turns a feed into the all-text form of an export.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
FIRST_DEAL_DAY = "2024-02-01"
FIRST_CONTACT_DAY = "2023-01-01"
# Channels that runs for the lift measurement switch off, one per residue of the order key after the
# first, which stands for the baseline.
LIFT_CHANNELS = ("linkedin_ads", "google_ads", "retargeting_ads", "organic_search", "direct", "referral",
                 "cold_email", "signal_engine", "reply_bot", "voice_agent")


def _text(c: Column) -> Column:
    return c.cast("string")


def _pick(key: Column, *values: str | None) -> Column:
    """One of the values, chosen by the remainder of the key."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]),
                        (key % len(values) + 1).cast("int"))


def _domain(account: Column) -> Column:
    return F.concat(F.lit("c"), _text(account), F.lit(".example.com"))


def _work_email(account: Column) -> Column:
    return F.concat(F.lit("u"), _text(account), F.lit("@"), _domain(account))


def _typed_email(user: Column) -> Column:
    """A work email as people type it."""
    return F.concat(F.lit(" U"), _text(user), F.lit("@"), _domain(user))


def _phone_digits(account: Column) -> Column:
    return F.lpad(_text(account), 10, "0")


def _plus_days(day: str, days: Column) -> Column:
    return F.timestamp_add("DAY", days, F.lit(day).cast("timestamp"))


def _deal_day(order: Column) -> Column:
    return F.timestamp_add("HOUR", order % 24, _plus_days(FIRST_DEAL_DAY, order % 90))


def _instant(ts: Column) -> Column:
    return F.date_format(ts, INSTANT)


def _money(name: str) -> Column:
    return F.col(name).cast("decimal(12,2)")


class DriverFeeds(Mapping):
    """Raw feeds by export name, plus lift_replicates, pipeline_runs and crm_snapshot; built when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")
        self._built: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._spark.read.parquet(f"{self._folder}/{name}.parquet")
        return self._tables[name]

    def events(self, *kinds: str) -> DataFrame:
        """Events of some types. Their times cover one month; spread over four, so that windows and months
        differ between deals."""
        at = F.timestamp_add("DAY", F.floor(F.col("event_id") / 10) % 4 * 30, F.col("ts").cast("timestamp"))
        events = self.table("events")
        return (events.filter(F.col("event_type").isin(*kinds)) if kinds else events).withColumn("at", at)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = _FEEDS[name](self)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(_FEEDS)

    def __len__(self) -> int:
        return len(_FEEDS)



def _companies(feeds: DriverFeeds) -> DataFrame:
    c = F.col("c_custkey")
    return feeds.table("customer").select(
        c.alias("hs_object_id"), F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("name"),
        F.upper(_domain(c)).alias("domain"), F.concat("c_mktsegment", F.lit("_GOODS")).alias("industry"),
        (15 + c * 37 % 3000).alias("numberofemployees"),
        _plus_days(FIRST_CONTACT_DAY, c % 365).alias("createdate"))


def _contacts(feeds: DriverFeeds) -> DataFrame:
    """A work contact per customer, and a personal one that shares its phone or has none."""
    c = F.col("c_custkey")
    digits = _phone_digits(c)
    spelled = F.concat(F.lit("+1 ("), F.substring(digits, 1, 3), F.lit(") "), F.substring(digits, 4, 3), F.lit("-"),
                       F.substring(digits, 7, 4))
    shared = [F.lit("User").alias("firstname"), _text(c).alias("lastname")]
    created = _plus_days(FIRST_CONTACT_DAY, c % 365).alias("createdate")
    work = F.struct(
        (c * 2).alias("hs_object_id"), F.concat(F.lit(" "), F.upper(_work_email(c))).alias("email"), *shared,
        F.lit("Counsel").alias("jobtitle"), spelled.alias("phone"), c.alias("associatedcompanyid"),
        F.lit("lead").alias("lifecyclestage"), created)
    personal = F.struct(
        (c * 2 + 1).alias("hs_object_id"), F.concat(F.lit("u"), _text(c), F.lit("@gmail.com")).alias("email"),
        *shared, F.lit(None).cast("string").alias("jobtitle"), F.when(c % 5 != 0, digits).alias("phone"),
        F.lit(None).cast("bigint").alias("associatedcompanyid"), F.lit("subscriber").alias("lifecyclestage"), created)
    return feeds.table("customer").select(F.explode(F.array(work, personal)).alias("r")).select("r.*")


def _deals(feeds: DriverFeeds) -> DataFrame:
    o, status = F.col("o_orderkey"), F.col("o_orderstatus")
    return feeds.table("orders").select(
        o.alias("hs_object_id"), F.concat(F.lit("Deal "), _text(o)).alias("dealname"),
        _money("o_totalprice").alias("amount"), F.lit("default").alias("pipeline"),
        F.when(status == "F", "closedwon").when(status == "P", "closedlost").otherwise("contractsent")
        .alias("dealstage"),
        _deal_day(o).alias("createdate"),
        F.timestamp_add("DAY", F.lit(60), _deal_day(o)).alias("closedate"),
        status.isin("F", "P").alias("hs_is_closed"),
        F.col("o_custkey").alias("associatedcompanyid"),
        F.when(o % 13 != 0, F.col("o_custkey") * 2).alias("associatedcontactid"))


def _stage_history(feeds: DriverFeeds) -> DataFrame:
    order, flag = F.col("l_orderkey"), F.col("l_returnflag")
    return feeds.table("lineitem").select(
        order.alias("deal_id"),
        F.when(flag == "R", "closedlost").when(flag == "A", "closedwon").otherwise("qualifiedtobuy")
        .alias("dealstage"),
        F.timestamp_add("DAY", F.col("l_linenumber") * 9, _deal_day(order)).alias("changed_at"))


def _cookie() -> Column:
    return F.concat(F.lit("ck"), _text(F.col("user_id")), F.lit("."), _text(F.col("event_id") % 2))


def _sessions(feeds: DriverFeeds) -> DataFrame:
    e, kind = F.col("event_id"), F.col("event_type")
    click = kind == "click"
    return feeds.events("click", "view", "signup").select(
        _text(e).alias("session_id"), _cookie().alias("client_id"), F.col("at").alias("session_start"),
        F.when(click, _pick(e, "linkedin", "LinkedIn_Ads", "google", "adroll", "newsletter")).alias("utm_source"),
        F.when(click, _pick(e, "CPC", "email", "cpc")).alias("utm_medium"),
        F.when(click, F.concat(F.lit("Launch-"), _text(e % 10))).alias("utm_campaign"),
        F.when(kind == "view", _pick(e, "google.com", "bing.com", "G2.com", "capterra.com", "linkedin.com",
                                     "blog.example.org")).alias("referrer"),
        F.concat(F.lit("/"), kind).alias("landing_page"))


def _form_fills(feeds: DriverFeeds) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    return feeds.events("signup").select(
        _text(e).alias("session_id"), _cookie().alias("client_id"),
        F.when(e % 2 == 1, F.concat(F.lit("guest"), _text(e), F.lit("@unknown.example.org")))
        .when(u % 17 == 0, F.concat(F.lit("u"), _text(u), F.lit("@gmail.com")))
        .otherwise(_typed_email(u)).alias("email"),
        F.lit("demo_request").alias("form_name"), F.col("at").alias("submitted_at"))


def _email_events(feeds: DriverFeeds) -> DataFrame:
    e = F.col("event_id")
    return feeds.events("purchase").select(
        _pick(e, "outbound_seq", "clay_signal_x", "sig_post").alias("campaign_name"),
        _typed_email(F.col("user_id")).alias("lead_email"),
        _pick(e, "sent", "open", "click", "reply", "reply").alias("event_type"),
        _instant(F.col("at")).alias("event_time"),
        F.when(e % 5 == 3, _pick(e, "interested", "not_interested"))
        .when(e % 5 == 4, "out_of_office").alias("reply_category"))


def _signals(feeds: DriverFeeds) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    return feeds.events("error").select(
        F.concat(F.lit("https://social.example.com/posts/"), _text(e % 40)).alias("linkedin_post_url"),
        F.concat(F.lit(" User "), _text(u)).alias("commenter_name"), F.lit("Counsel").alias("commenter_title"),
        F.when(e % 11 == 0, "nowhere.example.org").otherwise(_domain(u)).alias("company_domain"),
        F.when(e % 3 != 0, _typed_email(u)).alias("work_email"), _instant(F.col("at")).alias("detected_at"))


def _bot_threads(feeds: DriverFeeds) -> DataFrame:
    e, at = F.col("event_id"), F.col("at")
    return feeds.events("error").select(
        _typed_email(F.col("user_id")).alias("lead_email"), _instant(at).alias("inbound_at"),
        _pick(e, "pricing", "demo", "other").alias("intent_label"),
        F.when(e % 3 != 0, F.timestamp_add("MINUTE", F.lit(5), at)).alias("bot_replied_at"),
        (e % 2 == 0).alias("handed_off_to_human"))


def _calls(feeds: DriverFeeds) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    return feeds.events("error").select(
        F.concat(F.lit("call"), _text(e)).alias("call_id"), _typed_email(u).alias("lead_email"),
        _phone_digits(u).alias("phone"),
        F.date_trunc("second", F.col("at")).cast("timestamp_ntz").alias("called_at_ist"),
        (e % 600).alias("duration_sec"),
        _pick(e, "meeting_booked", "no_answer", "not_qualified", "call_back_later").alias("outcome"))


def _subscriptions(feeds: DriverFeeds) -> DataFrame:
    c = F.col("c_custkey")
    return feeds.table("customer").select(
        F.concat(F.lit("sub"), _text(c)).alias("id"), F.upper(_domain(c)).alias("customer_domain"),
        F.when(c % 5 == 0, "canceled").otherwise("active").alias("status"),
        F.lit("2024-05-01").alias("start_date"),
        _pick(c, "0", "12000", "9000", "9000", "9000").alias("current_mrr_cents"))


def _subscription_events(feeds: DriverFeeds) -> DataFrame:
    def event(kind: str, cents: int, day: str) -> Column:
        return F.struct(F.lit(kind).alias("event_type"), F.lit(str(cents)).alias("mrr_delta_cents"),
                        F.lit(day).alias("occurred_on"))

    c = F.col("c_custkey")
    start, grow = event("new", 10000, "2024-05-01"), event("expansion", 2000, "2024-08-01")
    shrink, leave = event("contraction", -1000, "2024-08-01"), event("churn", -12000, "2024-11-01")
    history = (F.when(c % 5 == 0, F.array(start, grow, leave)).when(c % 5 == 1, F.array(start, grow))
               .otherwise(F.array(start, shrink)))
    return feeds.table("customer").select(
        F.concat(F.lit("sub"), _text(c)).alias("subscription_id"), F.explode(history).alias("r")
    ).select("subscription_id", "r.*")


def _ad_feed(flag: str, columns: Callable[[Column, Column, Column], list[Column]]) -> Callable[[DriverFeeds], DataFrame]:
    """Ad spend of one platform: the line items of one return flag."""
    def build(feeds: DriverFeeds) -> DataFrame:
        day = F.date_add(F.lit(FIRST_DEAL_DAY).cast("date"), (F.col("l_orderkey") % 90).cast("int"))
        campaign = F.concat(F.lit("cmp_"), _text(F.col("l_linenumber")))
        return (feeds.table("lineitem").filter(F.col("l_returnflag") == flag)
                .select(*columns(day, campaign, F.col("l_quantity").cast("int"))))
    return build


def _lift_replicates(feeds: DriverFeeds) -> DataFrame:
    o = F.col("o_orderkey")
    return feeds.table("orders").groupBy(
        (o % 12).alias("replicate"), _pick(o, "none", *LIFT_CHANNELS).alias("disabled_channel")).agg(
            F.sum(_money("o_totalprice")).alias("won_revenue"))


def _pipeline_runs(feeds: DriverFeeds) -> DataFrame:
    return feeds.events().select(
        F.col("event_id").alias("run_id"), F.col("at").alias("started_at"),
        F.timestamp_add("SECOND", F.lit(40), F.col("at")).alias("finished_at"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        F.col("props").alias("summary"))


def _crm_snapshot(feeds: DriverFeeds) -> DataFrame:
    """CRM records: half without a domain, some domains twice in different case."""
    c, copy = F.col("c_custkey"), F.col("copy")
    copies = F.when(c % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return feeds.table("customer").select("c_custkey", F.explode(copies).alias("copy")).select(
        _text(c * 2 + copy).alias("id"),
        F.when(c % 2 == 0, F.when(copy == 1, F.upper(_domain(c))).otherwise(_domain(c))).alias("domain"),
        F.when(copy == 0, "unattributed").alias("first_touch_channel"),
        F.lit("0").alias("attributed_pipeline"), F.lit("0.0").alias("source_quality_score"))


_FEEDS: dict[str, Callable[[DriverFeeds], DataFrame]] = {
    "hubspot_companies": _companies,
    "hubspot_contacts": _contacts,
    "hubspot_deals": _deals,
    "hubspot_deal_stage_history": _stage_history,
    "ga4_sessions": _sessions,
    "ga4_form_fills": _form_fills,
    "linkedin_ads_daily": _ad_feed("A", lambda day, campaign, clicks: [
        day.alias("date"), campaign.alias("campaign_name"), (clicks * 100).alias("impressions"),
        clicks.alias("clicks"), _money("l_extendedprice").alias("cost_in_usd")]),
    "google_ads_daily": _ad_feed("N", lambda day, campaign, clicks: [
        day.alias("segments_date"), campaign.alias("campaign_name"), clicks.alias("metrics_clicks"),
        (_money("l_extendedprice") * 1000000).cast("bigint").alias("metrics_cost_micros")]),
    "adroll_daily": _ad_feed("R", lambda day, campaign, clicks: [
        day.alias("day"), campaign.alias("campaign"), clicks.alias("clicks"),
        _money("l_extendedprice").alias("spend")]),
    "smartlead_email_events": _email_events,
    "clay_signal_leads": _signals,
    "reply_bot_threads": _bot_threads,
    "voice_agent_calls": _calls,
    "stripe_subscriptions": _subscriptions,
    "stripe_subscription_events": _subscription_events,
    "lift_replicates": _lift_replicates,
    "pipeline_runs": _pipeline_runs,
    "crm_snapshot": _crm_snapshot,
}


def as_text(feed: DataFrame) -> DataFrame:
    """The feed as an export would hold it: every column text."""
    return feed.select(*[(_instant(F.col(c)) if t == "timestamp" else _text(F.col(c))).alias(c)
                         for c, t in feed.dtypes])


def export(feed: DataFrame, path: str) -> None:
    """Writes a feed as CSV, with quotes doubled within quoted cells."""
    (feed.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).option("escape", '"').csv(path))


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/pages.parquet").select("page_id", "url")
