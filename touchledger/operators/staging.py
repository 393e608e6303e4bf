"""Typing and cleaning of the raw text feeds: one projection per feed, no shuffle.

Casts are strict (a malformed value stops the job); ``lenient=True`` turns such values into NULL instead.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchledger.config import PERSONAL_EMAIL_DOMAINS
from touchledger.functions import (
    blank_to_null,
    classify_web_channel,
    normal_email,
    phone_key,
    surrogate_key,
)

MONEY = "decimal(12,2)"
MRR = "decimal(18,2)"
# Campaign name patterns of signal-engine sequences (old and new series), and its time zone.
SIGNAL_CAMPAIGNS = ("clay_signal_%", "sig_%")
CALLS_TIME_ZONE = "Asia/Kolkata"


def _typed(name: str, dtype: str, lenient: bool) -> Column:
    return F.col(name).try_cast(dtype) if lenient else F.col(name).cast(dtype)


def _scaled(name: str, unit: str, dtype: str, lenient: bool) -> Column:
    """A whole number of small units (cents, micros) as an amount."""
    whole = _typed(name, "bigint", lenient).cast("decimal(20,0)")
    return F.round(whole * F.lit(Decimal(unit)), 2).cast(dtype)


def stg_companies(raw: DataFrame, lenient: bool = False) -> DataFrame:
    staff = _typed("numberofemployees", "int", lenient)
    return raw.select(
        _typed("hs_object_id", "bigint", lenient).alias("company_id"),
        F.trim("name").alias("company_name"),
        F.lower(F.trim("domain")).alias("domain"),
        F.initcap(F.replace(F.lower("industry"), F.lit("_"), F.lit(" "))).alias("industry"),
        staff.alias("employees"),
        F.when(staff < 100, "small").when(staff <= 1000, "mid").otherwise("large").alias("size_band"),
        _typed("createdate", "timestamp", lenient).alias("created_at"),
    )


def stg_contacts(raw: DataFrame, lenient: bool = False) -> DataFrame:
    email = normal_email(F.col("email"))
    domain = F.split_part(email, F.lit("@"), F.lit(2))
    return raw.select(
        _typed("hs_object_id", "bigint", lenient).alias("contact_id"),
        email.alias("email"),
        domain.alias("email_domain"),
        domain.isin(*PERSONAL_EMAIL_DOMAINS).alias("is_personal_email"),
        F.col("firstname").alias("first_name"),
        F.col("lastname").alias("last_name"),
        F.lower(F.trim(F.concat("firstname", F.lit(" "), "lastname"))).alias("full_name_key"),
        F.col("jobtitle").alias("job_title"),
        phone_key(F.col("phone")).alias("phone_key"),
        _typed("associatedcompanyid", "bigint", lenient).alias("company_id"),
        F.col("lifecyclestage").alias("lifecycle_stage"),
        _typed("createdate", "timestamp", lenient).alias("created_at"),
    )


def stg_deals(raw: DataFrame, lenient: bool = False) -> DataFrame:
    return raw.select(
        _typed("hs_object_id", "bigint", lenient).alias("deal_id"),
        F.col("dealname").alias("deal_name"),
        _typed("amount", MONEY, lenient).alias("amount"),
        F.col("dealstage").alias("current_stage"),
        _typed("createdate", "timestamp", lenient).alias("created_at"),
        _typed("closedate", "timestamp", lenient).alias("close_date"),
        _typed("hs_is_closed", "boolean", lenient).alias("is_closed"),
        (F.col("dealstage") == "closedwon").alias("is_won"),
        _typed("associatedcompanyid", "bigint", lenient).alias("company_id"),
        _typed("associatedcontactid", "bigint", lenient).alias("contact_id"),
    )


def stg_stage_history(raw: DataFrame, lenient: bool = False) -> DataFrame:
    return raw.select(
        _typed("deal_id", "bigint", lenient).alias("deal_id"),
        F.col("dealstage").alias("stage"),
        _typed("changed_at", "timestamp", lenient).alias("changed_at"),
    )


def stg_sessions(raw: DataFrame, lenient: bool = False) -> DataFrame:
    source, medium, referrer = F.lower("utm_source"), F.lower("utm_medium"), F.lower("referrer")
    return raw.select(
        "session_id",
        "client_id",
        _typed("session_start", "timestamp", lenient).alias("started_at"),
        blank_to_null(source).alias("utm_source"),
        blank_to_null(medium).alias("utm_medium"),
        blank_to_null(F.col("utm_campaign")).alias("utm_campaign"),
        blank_to_null(referrer).alias("referrer"),
        "landing_page",
        # classified before blanks become NULL: an empty tag is not the same as no tag
        classify_web_channel(source, medium, referrer).alias("channel"),
    )


def stg_form_fills(raw: DataFrame, lenient: bool = False) -> DataFrame:
    return raw.select(
        "session_id",
        "client_id",
        normal_email(F.col("email")).alias("email"),
        "form_name",
        _typed("submitted_at", "timestamp", lenient).alias("submitted_at"),
    )


def stg_email_events(raw: DataFrame, lenient: bool = False) -> DataFrame:
    from_signal = F.lit(False)
    for pattern in SIGNAL_CAMPAIGNS:
        from_signal = from_signal | F.coalesce(F.col("campaign_name").like(pattern), F.lit(False))
    return raw.select(
        surrogate_key(*[F.col(c) for c in ("campaign_name", "lead_email", "event_type", "event_time")])
        .alias("email_event_id"),
        "campaign_name",
        F.when(from_signal, "signal_engine").otherwise("cold_email").alias("channel"),
        normal_email(F.col("lead_email")).alias("email"),
        "event_type",
        _typed("event_time", "timestamp", lenient).alias("event_at"),
        blank_to_null(F.col("reply_category")).alias("reply_category"),
    )


def stg_signals(raw: DataFrame, lenient: bool = False) -> DataFrame:
    return raw.select(
        surrogate_key(*[F.col(c) for c in ("linkedin_post_url", "commenter_name", "company_domain", "detected_at")])
        .alias("signal_id"),
        "linkedin_post_url",
        F.lower(F.trim("commenter_name")).alias("full_name_key"),
        "commenter_title",
        F.lower(F.trim("company_domain")).alias("company_domain"),
        blank_to_null(normal_email(F.col("work_email"))).alias("email"),
        _typed("detected_at", "timestamp", lenient).alias("detected_at"),
    )


def stg_bot_threads(raw: DataFrame, lenient: bool = False) -> DataFrame:
    return raw.select(
        surrogate_key(F.col("lead_email"), F.col("inbound_at")).alias("thread_id"),
        normal_email(F.col("lead_email")).alias("email"),
        _typed("inbound_at", "timestamp", lenient).alias("inbound_at"),
        "intent_label",
        _typed("bot_replied_at", "timestamp", lenient).alias("bot_replied_at"),
        _typed("handed_off_to_human", "boolean", lenient).alias("handed_off_to_human"),
    )


def stg_calls(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """The export holds local wall-clock time without an offset."""
    return raw.select(
        "call_id",
        normal_email(F.col("lead_email")).alias("email"),
        F.to_utc_timestamp(_typed("called_at_ist", "timestamp_ntz", lenient), CALLS_TIME_ZONE).alias("called_at"),
        _typed("duration_sec", "int", lenient).alias("duration_sec"),
        "outcome",
    )


def stg_spend_daily(linkedin: DataFrame, google: DataFrame, adroll: DataFrame, lenient: bool = False) -> DataFrame:
    """Three export shapes (dollars, micros, dollars under other names) as one daily spend table."""

    def shaped(raw, day, channel, campaign, clicks, spend):
        return raw.select(
            _typed(day, "date", lenient).alias("spend_date"),
            F.lit(channel).alias("channel"),
            F.col(campaign).alias("campaign_name"),
            _typed(clicks, "int", lenient).alias("clicks"),
            spend.alias("spend_usd"),
        )

    return (
        shaped(linkedin, "date", "linkedin_ads", "campaign_name", "clicks", _typed("cost_in_usd", MONEY, lenient))
        .unionByName(shaped(google, "segments_date", "google_ads", "campaign_name", "metrics_clicks",
                            _scaled("metrics_cost_micros", "0.000001", MONEY, lenient)))
        .unionByName(shaped(adroll, "day", "retargeting_ads", "campaign", "clicks", _typed("spend", MONEY, lenient)))
    )


def stg_subscriptions(raw: DataFrame, lenient: bool = False) -> DataFrame:
    return raw.select(
        F.col("id").alias("subscription_id"),
        F.lower("customer_domain").alias("domain"),
        "status",
        _typed("start_date", "date", lenient).alias("start_date"),
        _scaled("current_mrr_cents", "0.01", MRR, lenient).alias("current_mrr_usd"),
    )


def stg_subscription_events(raw: DataFrame, lenient: bool = False) -> DataFrame:
    return raw.select(
        "subscription_id",
        "event_type",
        _scaled("mrr_delta_cents", "0.01", MRR, lenient).alias("mrr_delta_usd"),
        _typed("occurred_on", "date", lenient).alias("occurred_on"),
    )


def classify_page_urls(pages: DataFrame) -> DataFrame:
    """The web channel rules applied to the tags in page addresses; a page address has no referrer."""
    source = F.lower(F.try_parse_url(F.col("url"), F.lit("QUERY"), F.lit("utm_source")))
    medium = F.lower(F.try_parse_url(F.col("url"), F.lit("QUERY"), F.lit("utm_medium")))
    return pages.select(
        "page_id",
        blank_to_null(source).alias("utm_source"),
        blank_to_null(medium).alias("utm_medium"),
        classify_web_channel(source, medium, F.lit(None).cast("string")).alias("channel"),
    )
