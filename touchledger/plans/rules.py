"""What must hold for which layer: fixed rules, and the counts that a layer's write takes along for them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchledger.config import DEAL_STAGES, EMAIL_EVENT_TYPES, MODELS
from touchledger.functions import exact_sum
from touchledger.operators import contracts as c

# Which columns must be unique, filled, known to a parent, or from a vocabulary.
UNIQUE = {
    "stg_companies": ["company_id", "domain"], "stg_contacts": ["contact_id"], "stg_deals": ["deal_id"],
    "stg_sessions": ["session_id"], "stg_calls": ["call_id"], "identity_contacts": ["contact_id"],
    "identity_email_map": ["email"], "identity_client_map": ["client_id"], "touchpoints": ["touchpoint_id"],
    "opportunities": ["deal_id"], "fct_attribution": ["attribution_id"], "fct_opportunities": ["deal_id"],
    "data_quality": ["check_name"],
}
NOT_NULL = {
    "stg_companies": ["company_id", "domain"], "stg_contacts": ["contact_id", "email"],
    "stg_deals": ["deal_id", "amount", "company_id"], "stg_sessions": ["session_id"], "stg_calls": ["call_id"],
    "identity_contacts": ["contact_id"], "identity_email_map": ["email"], "identity_client_map": ["client_id"],
    "touchpoints": ["touchpoint_id", "company_id"], "opportunities": ["deal_id"],
    "fct_attribution": ["attribution_id"], "fct_opportunities": ["deal_id"],
}
RELATIONSHIPS = (
    ("stg_deals", "company_id", "stg_companies", "company_id"),
    ("stg_sessions", "channel", "dim_channel", "channel"),
    ("touchpoints", "channel", "dim_channel", "channel"),
    ("fct_attribution", "channel", "dim_channel", "channel"),
)
ACCEPTED = (
    ("stg_deals", "current_stage", DEAL_STAGES),
    ("stg_email_events", "event_type", EMAIL_EVENT_TYPES),
    ("fct_attribution", "model", MODELS),
)
#: Layers whose writes take counts along.
WATCHED = tuple(dict.fromkeys([*UNIQUE, *NOT_NULL, *(t for t, *_ in ACCEPTED)]))


def row_checks(layer: str) -> dict[str, Column]:
    """Contract -> what a row of the layer is that breaks it."""
    checks = {f"not_null:{layer}.{col}": F.col(col).isNull() for col in NOT_NULL.get(layer, ())}
    checks |= {f"accepted_values:{t}.{col}": ~F.col(col).isin(*values) for t, col, values in ACCEPTED if t == layer}
    if layer == "fct_attribution":
        checks |= {"no_credit_after_deal_created": c.is_late(), "credit_in_unit_interval": c.is_out_of_range()}
    return checks


def watches(layer: str) -> dict[str, Column]:
    """Aggregates that the write of a layer takes along: rows that break a contract, and the won revenue."""
    taken = {name: F.count_if(broken) for name, broken in row_checks(layer).items()}
    if layer == "fct_attribution":
        won = F.col("credited_won_revenue")
        taken |= {f"won:{m}": exact_sum(F.when(F.col("model") == m, won)) for m in MODELS}
    if layer == "opportunities":
        taken["won"] = F.sum(F.when(F.col("is_won"), F.col("amount")))
    return taken
