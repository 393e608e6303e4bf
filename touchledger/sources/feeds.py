"""Raw feeds the engine accepts: names, columns (all text) and the channel dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from touchledger.config import CHANNELS

# Export name -> column names, in export order.
RAW_FEEDS = {
    "hubspot_companies": ["hs_object_id", "name", "domain", "industry", "numberofemployees", "createdate"],
    "hubspot_contacts": ["hs_object_id", "email", "firstname", "lastname", "jobtitle", "phone",
                         "associatedcompanyid", "lifecyclestage", "createdate"],
    "hubspot_deals": ["hs_object_id", "dealname", "amount", "pipeline", "dealstage", "createdate", "closedate",
                      "hs_is_closed", "associatedcompanyid", "associatedcontactid"],
    "hubspot_deal_stage_history": ["deal_id", "dealstage", "changed_at"],
    "ga4_sessions": ["session_id", "client_id", "session_start", "utm_source", "utm_medium", "utm_campaign",
                     "referrer", "landing_page"],
    "ga4_form_fills": ["session_id", "client_id", "email", "form_name", "submitted_at"],
    "linkedin_ads_daily": ["date", "campaign_name", "impressions", "clicks", "cost_in_usd"],
    "google_ads_daily": ["segments_date", "campaign_name", "metrics_clicks", "metrics_cost_micros"],
    "adroll_daily": ["day", "campaign", "clicks", "spend"],
    "smartlead_email_events": ["campaign_name", "lead_email", "event_type", "event_time", "reply_category"],
    "clay_signal_leads": ["linkedin_post_url", "commenter_name", "commenter_title", "company_domain", "work_email",
                          "detected_at"],
    "reply_bot_threads": ["lead_email", "inbound_at", "intent_label", "bot_replied_at", "handed_off_to_human"],
    "voice_agent_calls": ["call_id", "lead_email", "phone", "called_at_ist", "duration_sec", "outcome"],
    "stripe_subscriptions": ["id", "customer_domain", "status", "start_date", "current_mrr_cents"],
    "stripe_subscription_events": ["subscription_id", "event_type", "mrr_delta_cents", "occurred_on"],
}
# The measured per-channel effect that models are scored against.
TRUTH_FEED = {
    "channel_incrementality": ["channel", "replicates", "expected_incremental_revenue", "std_error",
                               "expected_won_revenue"],
}
# Column the landing step adds to every table.
LOADED_AT = "_loaded_at"


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def feed_schema(name: str) -> T.StructType:
    return text_schema({**RAW_FEEDS, **TRUTH_FEED}[name])


def dim_channel(spark: SparkSession) -> DataFrame:
    """The 13 channels and their groups; a fixed lookup, always small enough to broadcast."""
    return spark.createDataFrame(
        list(CHANNELS), "channel string, channel_group string, is_direct boolean, description string")
