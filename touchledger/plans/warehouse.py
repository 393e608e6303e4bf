"""The layers of the engine and how they feed each other.

A layer is a property that gives a plan. Where a plan is built on a layer that several others read, that layer is
written first, once per warehouse, through ``shared``; so asking for a late layer runs the jobs that write the early
ones. ``materialise`` writes layers by name, in the order given, and says so.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from touchledger.config import AttributionConfig
from touchledger.operators import (
    asof,
    attribution,
    catalogue,
    crm,
    identity,
    journeys,
    lift,
    marts,
    membership,
    opportunities,
    quality,
    staging,
    touches,
)
from touchledger.operators.numbering import PLACE, place_rows
from touchledger.plans.rules import watches
from touchledger.plans.workspace import Workspace
from touchledger.session import limit_tasks, measure_broadcasts
from touchledger.sources.feeds import dim_channel


#: What reports and the CRM take of the deal facts.
DEAL_FACTS = ("deal_id", "company_name", "domain", "amount", "created_at", "closed_at", "is_closed", "is_won", "cycle_days",
              "first_touch_channel")


class Warehouse:
    """All layers over one set of raw feeds (see sources.feeds for their names)."""

    def __init__(self, spark: SparkSession, feeds: Mapping[str, DataFrame], cfg: AttributionConfig = AttributionConfig(),
                 workspace: Workspace | None = None):
        self.spark, self.feeds, self.cfg = measure_broadcasts(limit_tasks(spark)), feeds, cfg
        self.workspace = workspace or Workspace(spark)
        self._written: dict[str, DataFrame] = {}

    def shared(self, name: str) -> DataFrame:
        """The written form of a layer that has several readers."""
        if name == "touchpoints":
            return self.placed_touches.drop(*PLACE)
        if name not in self._written:
            self._written[name] = self.workspace.settle(getattr(self, name), name, watches(name))
        return self._written[name]

    def materialise(self, names: Iterable[str]) -> None:
        """Writes layers, and whatever they are built on."""
        for name in names:
            self.shared(name)

    def latest(self, name: str) -> DataFrame:
        """A layer in its written form if it has been written, else as a plan."""
        return self._written[name] if name in self._written else getattr(self, name)

    # staging -----------------------------------------------------------------------------------------
    @cached_property
    def stg_companies(self):
        return staging.stg_companies(self.feeds["hubspot_companies"])

    @cached_property
    def stg_contacts(self):
        return staging.stg_contacts(self.feeds["hubspot_contacts"])

    @cached_property
    def stg_deals(self):
        return staging.stg_deals(self.feeds["hubspot_deals"])

    @cached_property
    def stg_stage_history(self):
        return staging.stg_stage_history(self.feeds["hubspot_deal_stage_history"])

    @cached_property
    def stg_sessions(self):
        return staging.stg_sessions(self.feeds["ga4_sessions"])

    @cached_property
    def stg_form_fills(self):
        return staging.stg_form_fills(self.feeds["ga4_form_fills"])

    @cached_property
    def stg_email_events(self):
        return staging.stg_email_events(self.feeds["smartlead_email_events"])

    @cached_property
    def stg_signals(self):
        return staging.stg_signals(self.feeds["clay_signal_leads"])

    @cached_property
    def stg_bot_threads(self):
        return staging.stg_bot_threads(self.feeds["reply_bot_threads"])

    @cached_property
    def stg_calls(self):
        return staging.stg_calls(self.feeds["voice_agent_calls"])

    @cached_property
    def stg_spend_daily(self):
        return staging.stg_spend_daily(
            self.feeds["linkedin_ads_daily"], self.feeds["google_ads_daily"], self.feeds["adroll_daily"])

    @cached_property
    def stg_subscriptions(self):
        return staging.stg_subscriptions(self.feeds["stripe_subscriptions"])

    @cached_property
    def stg_subscription_events(self):
        return staging.stg_subscription_events(self.feeds["stripe_subscription_events"])

    @cached_property
    def dim_channel(self):
        return dim_channel(self.spark)

    # identity ----------------------------------------------------------------------------------------
    # A lookup that a feed with hot keys is joined to is written first: adaptive execution splits a skewed
    # join only when both sides come out of a shuffle of their own, not out of an aggregate on the key.
    @cached_property
    def phone_owners(self):
        return identity.phone_owners(self.latest("stg_contacts"), self.cfg.on_conflict)

    @cached_property
    def identity_contacts(self):
        return identity.identity_contacts(self.latest("stg_contacts"), owners=self.shared("phone_owners"))

    @cached_property
    def identity_people(self):
        return identity.identity_people(self.shared("identity_contacts"), self.latest("stg_contacts"), self.latest("stg_companies"))

    @cached_property
    def identity_email_map(self):
        return identity.identity_email_map(self.shared("identity_contacts"))

    @cached_property
    def email_lookup(self):
        return identity.email_lookup(self.latest("identity_email_map"), self.cfg.on_conflict)

    @cached_property
    def identity_client_map(self):
        return identity.identity_client_map(self.latest("stg_form_fills"), self.shared("email_lookup"))

    @cached_property
    def known_cookies(self):
        """Bits of the known cookies, written, as joins of all sessions use them."""
        clients = self.shared("identity_client_map")
        bits = membership.bits_for(clients.count())
        return membership.Membership(self.workspace.settle(membership.words(clients, "client_id", bits), "known_cookies"), bits)

    @cached_property
    def people_keys(self):
        return identity.people_keys(self.latest("identity_people"), self.cfg.on_conflict)

    @cached_property
    def match_signals(self):
        return identity.match_signals(self.latest("stg_signals"), self.latest("identity_people"), keys=self.shared("people_keys"))

    @cached_property
    def lead_events(self):
        return identity.lead_events(self.latest("stg_form_fills"), self.latest("stg_email_events"), self.shared("email_lookup"))

    # touches and deals -------------------------------------------------------------------------------
    @cached_property
    def touchpoints(self):
        return touches.touchpoints(
            self.latest("stg_sessions"), self.shared("identity_client_map"), self.latest("stg_email_events"), self.shared("email_lookup"),
            self.match_signals, self.latest("stg_bot_threads"), self.latest("stg_calls"), self.known_cookies)

    @cached_property
    def placed_touches(self):
        """The one written copy of the touches, sorted by account and time."""
        return self.workspace.settle(place_rows(self.touchpoints, touches.TIMELINE), "touchpoints", watches("touchpoints"))

    @cached_property
    def account_touches(self):
        return touches.account_touches(self.placed_touches)

    @cached_property
    def touched_accounts(self):
        """Bits of the accounts that have touches, written, as deals of other accounts have no pairs to look for."""
        accounts = self.placed_touches.filter("touched_at is not null and company_id is not null").select("company_id").distinct()
        bits = membership.bits_for(accounts.count())
        return membership.Membership(self.workspace.settle(membership.words(accounts, "company_id", bits), "touched_accounts"), bits)

    @cached_property
    def opportunities(self):
        return opportunities.opportunities(self.latest("stg_deals"), self.latest("stg_stage_history"), self.latest("stg_companies"))

    @cached_property
    def deal_lead_moment(self):
        return opportunities.deal_lead_moment(self.shared("opportunities"), self.latest("lead_events"), self.cfg)

    @cached_property
    def deal_anchors(self):
        opps, leads = self.shared("opportunities"), self.shared("deal_lead_moment")
        rows = self.placed_touches.count() + opps.count()
        asked = self.touched_accounts.may_hold(opps, "company_id")
        if journeys.candidate_pairs(asked, self.account_touches, self.cfg).first()["pairs"] < self.cfg.dense_pairs * rows:
            return journeys.deal_anchors_by_pairs(opps, self.account_touches, leads, self.cfg, self.touched_accounts)
        return journeys.deal_anchors(opps, self.window_probes, leads, self.cfg)

    @cached_property
    def window_probes(self):
        """The written copy of touches and deals' moments, sorted by account and time."""
        probes = journeys.window_probes(
            self.shared("opportunities"), self.account_touches, self.shared("deal_lead_moment"), self.cfg)
        return self.workspace.settle(place_rows(probes, asof.ORDER), "window_probes")

    @cached_property
    def deal_journeys(self):
        return journeys.deal_journeys(self.shared("deal_anchors"), self.account_touches, self.cfg)

    @cached_property
    def deal_touch_window(self):
        return journeys.deal_touch_window(self.latest("deal_journeys"))

    # attribution -------------------------------------------------------------------------------------
    @cached_property
    def fct_attribution(self):
        return attribution.fct_attribution(self.latest("deal_journeys"), self.shared("deal_anchors"), self.cfg)

    @cached_property
    def fct_opportunities(self):
        return attribution.fct_opportunities(
            self.shared("opportunities"), self.shared("deal_anchors"), self.account_touches)

    @cached_property
    def deal_facts(self):
        """The columns of the deal facts that reports and the CRM read."""
        return self.latest("fct_opportunities").select(*DEAL_FACTS)

    def write_report_inputs(self) -> None:
        """Writes what several reports read of the fact tables.

        The fact tables need not be written for that: their keys and texts, which no report reads, are most of their bytes.
        """
        if "fct_opportunities" not in self._written:
            self.shared("deal_facts")
        self.shared("channel_performance")

    # marts -------------------------------------------------------------------------------------------
    @cached_property
    def channel_performance(self):
        credit = self.latest("fct_attribution")
        return marts.channel_performance(credit, self.latest("stg_spend_daily"), self.dim_channel)

    @cached_property
    def channel_summary(self):
        performance = self.latest("channel_performance")
        return marts.channel_summary(performance, self.latest("stg_spend_daily"))

    @cached_property
    def model_disagreement(self):
        return marts.model_disagreement(self.latest("channel_summary"))

    @cached_property
    def funnel_monthly(self):
        return marts.funnel_monthly(
            self.latest("stg_sessions"), self.shared("identity_client_map"), self.latest("lead_events"), self.latest("stg_calls"),
            self.shared("opportunities"), self.known_cookies)

    @cached_property
    def velocity(self):
        return marts.velocity(self.latest("deal_facts"))

    @cached_property
    def subscription_movements(self):
        return marts.subscription_movements(self.latest("stg_subscriptions"), self.latest("stg_subscription_events"))

    @cached_property
    def retention(self):
        return marts.retention(
            self.subscription_movements, self.latest("deal_facts"))

    @cached_property
    def incremental_lift(self):
        return lift.incremental_lift(self.feeds["lift_replicates"])

    @cached_property
    def truth(self):
        """Measured effect per channel: the exported one if there is one, else computed from the replicates."""
        known = "channel_incrementality" in self.feeds
        return self.feeds["channel_incrementality"] if known else self.incremental_lift

    @cached_property
    def truth_evaluation(self):
        return marts.truth_evaluation(self.shared("channel_summary"), self.truth)

    @cached_property
    def data_quality(self):
        return quality.data_quality(
            self.latest("stg_sessions"), self.latest("stg_spend_daily"), self.shared("opportunities"),
            self.shared("deal_anchors"), self.shared("identity_client_map"),
            self.shared("identity_contacts"), self.shared("touchpoints"), self.latest("stg_signals"),
            cookies=self.known_cookies)

    @cached_property
    def dashboard_summary(self):
        # deal facts only; the fact table adds nothing but channels to them
        return marts.dashboard_summary(self.shared("opportunities"))

    @cached_property
    def run_summary(self):
        return quality.run_summary(self.shared("opportunities"), self.latest("data_quality"))

    @cached_property
    def recent_runs(self):
        return quality.recent_runs(self.feeds["pipeline_runs"])

    # CRM ---------------------------------------------------------------------------------------------
    @cached_property
    def credited_pipeline_by_company(self):
        # domains are deal facts, so the deals themselves will do
        return crm.credited_pipeline_by_company(self.latest("fct_attribution"), self.shared("opportunities"))

    @cached_property
    def channel_score(self):
        return crm.channel_score(self.velocity, self.latest("channel_summary"))

    @cached_property
    def latest_deal_per_company(self):
        return crm.latest_deal_per_company(self.latest("deal_facts"))

    def crm_payload(self, limit: int | None = None) -> DataFrame:
        # three inputs of the payload are made of them
        self.write_report_inputs()
        return crm.crm_payload(
            self.latest_deal_per_company, self.credited_pipeline_by_company, self.channel_score, limit)

    @cached_property
    def existing_by_domain(self):
        return crm.existing_by_domain(self.feeds["crm_snapshot"])

    def changed_rows(self, limit: int | None = None) -> DataFrame:
        return crm.changed_rows(self.crm_payload(limit), self.existing_by_domain)

    @cached_property
    def metric_catalogue(self):
        self.write_report_inputs()
        names = ("channel_summary", "model_disagreement", "funnel_monthly", "velocity", "retention", "data_quality",
                 "truth_evaluation")
        return catalogue.metric_catalogue({**{n: getattr(self, n) for n in names}, "crm_payload": self.crm_payload()})
