"""Parameters and fixed vocabularies."""

from __future__ import annotations

from dataclasses import dataclass

# Attribution models, in reporting order.
MODELS = ("first_touch", "last_non_direct", "linear", "w_shaped", "time_decay")

# The channel dimension (channel, channel_group, is_direct, description). Fixed values are the first three columns; the
# descriptions are our own words.
CHANNELS = (
    ("linkedin_ads", "paid", False, "Tagged clicks on sponsored LinkedIn posts"),
    ("google_ads", "paid", False, "Tagged clicks on paid Google results"),
    ("retargeting_ads", "paid", False, "Clicks on retargeting display ads"),
    ("organic_search", "organic", False, "Visits from unpaid search results"),
    ("organic_social", "organic", False, "Untagged visits from LinkedIn"),
    ("referral", "organic", False, "Visits from review sites and partners"),
    ("direct", "direct", True, "Visits with neither a tag nor a referrer"),
    ("other", "direct", True, "Web visits no rule recognises"),
    ("cold_email", "outbound", False, "Clicks and replies in cold email sequences"),
    ("signal_engine", "gtm_system", False, "Detected buying signals and the sequences they start"),
    ("reply_bot", "gtm_system", False, "Automatic answers to interested replies"),
    ("voice_agent", "gtm_system", False, "Automatic calls to new leads"),
    ("unattributed", "none", True, "Deals without a known touch in the look-back window"),
)
PAID_CHANNELS = ("linkedin_ads", "google_ads", "retargeting_ads")
# Channels that last_non_direct skips.
DIRECT_CHANNELS = ("direct", "other")
UNATTRIBUTED = "unattributed"

# Domain vocabularies enforced by the contracts.
DEAL_STAGES = (
    "appointmentscheduled", "qualifiedtobuy", "presentationscheduled",
    "decisionmakerboughtin", "contractsent", "closedwon", "closedlost",
)
EMAIL_EVENT_TYPES = ("sent", "open", "click", "reply")
PERSONAL_EMAIL_DOMAINS = ("gmail.com", "yahoo.com", "outlook.com", "hotmail.com")


@dataclass(frozen=True)
class AttributionConfig:
    """Knobs of the attribution chain.

    ``on_conflict`` is what joins do with an ambiguous phone, address or name (see operators.identity).
    ``bucket_days`` and ``dense_pairs`` only shape the physical plan (see operators.journeys); results do not depend on
    them. The latter is the number of pairs for each touch and deal from which on landmarks are looked up without pairs.
    """

    lookback_days: int = 90
    half_life_days: float = 7.0
    anchor_weight: float = 0.30
    bucket_days: int = 30
    dense_pairs: float = 16.0
    on_conflict: str = "fanout"


@dataclass(frozen=True)
class Threshold:
    """When a data-quality value is worth a warning: below a ``min``, above a ``max``, never (``info``)."""

    limit: float | None
    direction: str


# Data-quality thresholds per check.
QUALITY_THRESHOLDS = {
    "utm_coverage_paid_clicks": Threshold(0.80, "min"),
    "identified_session_share": Threshold(0.10, "min"),
    "unattributed_won_revenue_share": Threshold(0.20, "max"),
    "deals_missing_contact_share": Threshold(0.10, "max"),
    "personal_email_contacts_merged": Threshold(None, "info"),
    "personal_email_contacts_unmatched": Threshold(5.0, "max"),
    "clay_signals_matched_share": Threshold(0.90, "min"),
    "reopened_won_deals": Threshold(None, "info"),
}
