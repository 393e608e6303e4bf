"""Query name -> DuckDB SQL over the benchmark tables."""

from __future__ import annotations

from oracles.definitions import ACCEPTED, DESCRIPTIONS, METRICS, NOT_NULL, RAW_FEEDS, RELATIONSHIPS, UNIQUE
from oracles.duckdb_sql import MODEL_LIST, RELATIONS, money, with_relations

# layer of the engine -> relation of the oracle
RELATION_OF = {
    "stg_companies": "companies", "stg_contacts": "contacts", "stg_deals": "deals", "stg_sessions": "sessions",
    "stg_calls": "calls", "stg_email_events": "email_events", "identity_contacts": "persons",
    "identity_email_map": "email_map", "identity_client_map": "client_map", "touchpoints": "touches",
    "opportunities": "opps", "fct_attribution": "attribution", "fct_opportunities": "fct_opps",
    "data_quality": "quality", "dim_channel": "channels",
}


def _union(rows: list[str]) -> str:
    return "\nunion all\n".join(rows)


def _violations(name: str, counted: str) -> str:
    return f"select '{name}' as contract, ({counted}) as violations"


# The queries of single contracts run over tables with faults: those whose key has an MD5 that begins with 0 or 1.
SPOILT = "md5(cast({0} as varchar)) < '2'"


def _texts(t: str, c: str) -> bool:
    return c in ("domain", "channel", "current_stage", "event_type", "model")


def _unique(broken: bool = True) -> list[str]:
    def keys(t, c):
        r = RELATION_OF[t]
        return f"(select {c} from {r} union all select {c} from {r} where {SPOILT.format(c)})" if broken else r
    return [_violations(f"unique:{t}.{c}", f"select count(*) from (select {c} from {keys(t, c)} where {c} is not null "
                                           f"group by {c} having count(*) > 1)") for t, cs in UNIQUE.items() for c in cs]


def _not_null(broken: bool = True) -> list[str]:
    empty = " or {1}" if broken else ""
    return [_violations(f"not_null:{t}.{c}", f"select count(*) from {RELATION_OF[t]} where {c} is null"
                        + empty.format(c, SPOILT.format(c))) for t, cs in NOT_NULL.items() for c in cs]


def _values(t: str, c: str, broken: bool) -> str:
    r = RELATION_OF[t]
    if not broken:
        return r
    stray = f"select 'no ' || {c} as {c} from {r}" if _texts(t, c) else f"select -{c} - 1 as {c} from {r} where {SPOILT.format(c)}"
    return f"(select {c} from {r} union all {stray})"


def _relationships(broken: bool = True) -> list[str]:
    return [_violations(f"relationship:{t}.{c}", f"select count(distinct {c}) from {_values(t, c, broken)} "
                                                 f"where {c} not in (select {pc} from {RELATION_OF[p]})")
            for t, c, p, pc in RELATIONSHIPS]


def _accepted(broken: bool = True) -> list[str]:
    return [_violations(f"accepted_values:{t}.{c}", f"select count(distinct {c}) from {_values(t, c, broken)} "
                                                    f"where {c} not in ({', '.join(repr(v) for v in values)})")
            for t, c, values in ACCEPTED]


# Credit too high in one model, missing in another and later than the deal, for the spoilt deals.
BROKEN_CREDIT = f"""(
    select * replace (if(model = 'w_shaped' and {SPOILT.format('deal_id')}, credit * 2 + 0.5, credit) as credit,
                      if(model = 'w_shaped', credited_won_revenue * 2, credited_won_revenue) as credited_won_revenue,
                      if({SPOILT.format('deal_id')}, touched_at + to_days(1000), touched_at) as touched_at)
    from attribution where not (model = 'linear' and {SPOILT.format('deal_id')}))"""
INVARIANTS = {
    "credit_sums_to_one": "select count(*) from (select deal_id, model from attribution group by all "
                          "having abs(1 - sum(credit)) > 1e-5 + count(*) * 0.5e-8)",
    "every_deal_in_every_model": f"select count(*) from (select deal_id, unnest({MODEL_LIST}) as model from opps "
                                 "except select deal_id, model from attribution)",
    "no_credit_after_deal_created": "select count(*) from attribution where deal_created_at < touched_at",
    "credit_in_unit_interval": "select count(*) from attribution where credit not between 0 and 1",
    "won_revenue_reconciles": "select count(*) from (select sum(cast(credited_won_revenue as decimal(28,8))) as x from attribution group by model) "
                              "where abs(x - (select sum(amount) from opps where is_won)) > 0.01",
}
PHONES = ("select count(*) from (select phone_key from contacts where phone_key is not null group by phone_key "
          "having count(*) filter (not is_personal_email) > 1 and count(*) filter (is_personal_email) > 0)")


SIGNALS = ("select count(*) from (select full_name_key, company_domain from signals where email is null "
           "intersect select full_name_key, company_domain from people group by all having count(*) > 1)")


def _gate() -> list[str]:
    return [*_unique(False), *_not_null(False), *_relationships(False), *_accepted(False),
            *[_violations(n, s) for n, s in INVARIANTS.items()], _violations("unambiguous_phones", PHONES),
            _violations("unambiguous_signals", SIGNALS)]


def _broken(name: str) -> str:
    return _violations(name, INVARIANTS[name].replace("from attribution", f"from {BROKEN_CREDIT}"))


# rows a feed delivers, by table of origin
FEED_ROWS = {
    "hubspot_companies": "companies", "hubspot_contacts": "contacts", "hubspot_deals": "deals",
    "hubspot_deal_stage_history": "stage_history", "ga4_sessions": "sessions", "ga4_form_fills": "form_fills",
    "linkedin_ads_daily": "spend where channel = 'linkedin_ads'", "google_ads_daily": "spend where channel = 'google_ads'",
    "adroll_daily": "spend where channel = 'retargeting_ads'", "smartlead_email_events": "email_events",
    "clay_signal_leads": "signals", "reply_bot_threads": "bot_threads", "voice_agent_calls": "calls",
    "stripe_subscriptions": "subscriptions", "stripe_subscription_events": "subscription_events",
}
MANIFEST = _union([f"select '{t}' as feed, count(*) as rows from {r}" for t, r in FEED_ROWS.items()])
def _drift() -> str:
    rows = []
    for t, cs in RAW_FEEDS.items():
        stored = {"hubspot_deals": cs[::-1], "ga4_sessions": cs[:-1], "adroll_daily": None}.get(t, cs)
        expected = "cast(null as varchar)" if stored is None else f"'{','.join(stored)}'"
        action = "create" if stored is None else "replace" if stored == cs else "rebuild"
        rows.append(f"select '{t}' as \"table\", {expected} as expected, '{','.join(cs)}' as found, '{action}' as action")
    return _union(rows)


# staging layer -> relation and columns
STAGED = {
    "stg_companies": "companies", "stg_contacts": "contacts", "stg_deals": "deals", "stg_stage_history": "stage_history",
    "stg_sessions": "sessions", "stg_form_fills": "form_fills", "stg_email_events": "email_events", "stg_signals": "signals",
    "stg_bot_threads": "bot_threads", "stg_calls": "calls", "stg_spend_daily": "spend", "stg_subscriptions": "subscriptions",
    "stg_subscription_events": "subscription_events",
}
LANDED = _union([
    f"select '{layer}' as \"table\", name as \"column\", n as filled, d as different from (unpivot (select "
    f"struct_pack(n := count(columns(*)), d := count(distinct columns(*))) from {relation}) on columns(*) into name name value v), "
    "(select 1) u, lateral (select v.n as n, v.d as d)" for layer, relation in STAGED.items()])

def _text(value: str | None) -> str:
    return "cast(null as varchar)" if value is None else "'" + value.replace("'", "''") + "'"


METRIC_TABLES = {
    "channel_summary": "summary", "model_disagreement": "disagreement", "funnel_monthly": "funnel", "velocity": "velocity",
    "retention": "retention", "data_quality": "quality where check_name = 'unattributed_won_revenue_share'",
    "truth_evaluation": "truth_evaluation", "crm_payload": "payload",
}
METRIC_ROWS = _union([
    f"select '{name}' as name, '{table}' as source_table, '{column}' as source_column, '{grain}' as grain, "
    f"{version}::bigint as version, {_text(definition)} as definition, {_text(changelog)} as changelog, "
    f"(select count({column}) from {METRIC_TABLES[table]}) as filled_values"
    for name, table, column, grain, version, definition, changelog in METRICS])

# result set of the dashboard -> relation and the fields that are numbers
EXTRACTS = {
    "summary": ("dashboard", ("opps", "won", "closed", "pipeline_usd", "won_revenue_usd")),
    "monthly": ("funnel", ("sessions", "identified_sessions", "new_leads", "voice_meetings_booked", "opps_created",
                           "pipeline_created_usd", "deals_won", "deals_lost", "won_revenue_usd", "win_rate")),
    "channels": ("summary", ("credited_deals", "credited_wins", "pipeline_usd", "won_revenue_usd", "share_of_won_revenue",
                             "spend_usd", "pipeline_per_dollar", "cost_per_credited_win")),
    "disagreement": ("disagreement", ("first_touch", "last_non_direct", "linear", "w_shaped", "time_decay", "swing", "swing_rank")),
    "truth": ("(select *, dense_rank() over (order by model_mean_abs_error) as model_rank from truth_evaluation)",
              ("true_share", "model_share", "error", "model_mean_abs_error", "model_rank")),
    "velocity": ("velocity", ("opps", "closed_opps", "won_opps", "win_rate", "avg_won_deal_usd", "median_cycle_days_won")),
    "retention": ("retention", ("customers", "starting_mrr_usd", "expansion_mrr_usd", "contraction_mrr_usd", "churned_mrr_usd",
                                "current_mrr_usd", "net_revenue_retention", "gross_revenue_retention")),
    "quality": ("quality", ("value", "threshold")),
    "runs": ("(select e as run_id from ev order by e desc limit 14)", ("run_id",)),
}
EXTRACT_ROWS = _union([
    f"select '{n}' as result_set, '{c}' as field, (select count(*) from {r}) as rows, (select count({c}) from {r}) as filled, "
    f"(select cast(round(sum(cast({c} as decimal(38,10))), 4) as double) from {r}) as total" for n, (r, cs) in EXTRACTS.items() for c in cs])

WEIGHT = "select deal_id, touchpoint_id, channel, round(credit, 8) as credit from touch_credit where model = '{0}'"
# result set -> fields that are texts; those of one row are given as values
EXTRACT_TEXTS = {
    "summary": ("first_deal", "last_deal"), "monthly": ("month",), "channels": ("model", "channel", "channel_group"),
    "disagreement": ("channel",), "truth": ("model", "channel"), "velocity": ("first_touch_channel",),
    "retention": ("first_touch_channel",), "quality": ("check_name", "direction", "status"),
}
_RUN_TEXTS = {"started_at": "strftime(started_at, '%Y-%m-%dT%H:%M:%S.%gZ')", "finished_at": "strftime(finished_at, '%Y-%m-%dT%H:%M:%S.%gZ')",
              "status": "status", "summary": "cast(summary as varchar)"}


def _counted(name: str, field: str, text: str, relation: str) -> str:
    return (f"select '{name}' as result_set, '{field}' as field, {text} as text, count(*) as n from {relation} "
            f"where {text} is not null group by {text}")


def _dashboard_texts(runs: str) -> str:
    shown = {field: k for k, field in enumerate(("name", "source_table", "source_column", "grain", "version", "definition", "changelog"))}
    single = [("meta", "company", "Benchmark Ltd"), ("meta", "pitch", "Tables, not slides"), ("meta", "lookback_days", "90"),
              *[("quality", "description", v) for v in DESCRIPTIONS.values()],
              *[("metrics", field, m[k]) for m in METRICS for field, k in shown.items() if isinstance(m[k], str)]]
    return _union([
        *[_counted(name, f, f"cast({f} as varchar)", EXTRACTS[name][0]) for name, fields in EXTRACT_TEXTS.items() for f in fields],
        *[_counted("runs", f, text, f"({runs})") for f, text in _RUN_TEXTS.items()],
        *[f"select '{name}' as result_set, 'in order' as field, '' as text, greatest(count(*) - 1, 0) as n from {EXTRACTS[name][0]}"
          for name in EXTRACT_TEXTS if name != "summary"],
        "select result_set, field, text, count(*) as n from (values " + ", ".join(
            f"('{a}', '{b}', {_text(c)})" for a, b, c in single) + ") given(result_set, field, text) group by all"])


RUNS = ("select e as run_id, moment as started_at, moment + to_seconds(40) as finished_at, "
        "if(kind = 'error', 'failed', 'success') as status, {0} props as summary from ev")
DEAL_ROWS = """deal_id, deal_name, company_id, company_name, domain, industry, size_band, contact_id, is_missing_contact,
    cast(amount as double) as amount, created_at, current_stage, is_closed, is_won, closed_at, cycle_days, was_reopened"""

SELECTS = {
    "land_raw": LANDED,
    "land_raw_split": "select doc_id, lang, source, length(text) as n_chars, md5(text) as text_md5 from documents",
    "schema_drift": _drift(),
    "load_manifest": f"select coalesce(feed, 'all') as \"table\", cast(sum(rows) as bigint) as rows from ({MANIFEST}) group by rollup (feed)",
    "stg_companies": "select * from companies",
    "stg_contacts": "select * from contacts",
    "stg_deals": "select * replace (cast(amount as double) as amount) from deals",
    "stg_stage_history": "select * from stage_history",
    "stg_sessions": "select * from sessions",
    "stg_form_fills": "select * from form_fills",
    "stg_email_events": "select * from email_events",
    "stg_signals": "select * from signals",
    "stg_bot_threads": "select * from bot_threads",
    "stg_calls": "select * from calls",
    "stg_spend_daily": "select * replace (cast(spend_usd as double) as spend_usd, cast(clicks as bigint) as clicks) from spend",
    "stg_subscriptions": "select * replace (cast(current_mrr_usd as double) as current_mrr_usd) from subscriptions",
    "stg_subscription_events": "select * replace (cast(mrr_delta_usd as double) as mrr_delta_usd) from subscription_events",
    "classify_page_urls": """
select page_id, utm_source, utm_medium,
       case when utm_source in ('linkedin', 'linkedin_ads') then 'linkedin_ads' when utm_source = 'adroll' then 'retargeting_ads'
            when utm_source = 'google' and utm_medium = 'cpc' then 'google_ads' when utm_source is null then 'direct'
            else 'other' end as channel
from (select page_id, nullif(lower(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1)), '') as utm_source,
             nullif(lower(regexp_extract(url, '[?&]utm_medium=([^&#]*)', 1)), '') as utm_medium from pages)""",
    "identity_contacts": "select * from persons",
    "identity_people": "select * from people",
    "identity_email_map": "select email, person_id from email_map",
    "identity_client_map": "select * from client_map",
    "match_signals": "select * from signal_matches",
    "lead_events": "select person_id, lead_at, lead_source from leads",
    "touchpoints": "select * from touches",
    "opportunities": f"select {DEAL_ROWS} from opps",
    "deal_lead_moment": "select * from lead_moment",
    "deal_touch_window": "select * from journeys",
    "attr_first_touch": WEIGHT.format("first_touch"),
    "attr_last_non_direct": WEIGHT.format("last_non_direct"),
    "attr_linear": WEIGHT.format("linear"),
    "attr_w_shaped": WEIGHT.format("w_shaped"),
    "attr_time_decay": WEIGHT.format("time_decay"),
    "unpivot_models": "select deal_id, touchpoint_id, model, round(credit, 8) as credit from touch_credit",
    "attr_unattributed": "select deal_id, model, 'unattributed' as channel, 1.0::double as credit from unattributed",
    "fct_attribution": f"""
select * replace ({money('credited_pipeline')} as credited_pipeline,
                  {money('credited_won_revenue')} as credited_won_revenue) from attribution""",
    "fct_opportunities": f"select {DEAL_ROWS}, first_touch_channel, last_non_direct_channel from fct_opps",
    "channel_performance": """
select model, channel, channel_group, month, cast(credited_deals as double) as credited_deals,
       cast(credited_wins as double) as credited_wins, cast(pipeline_usd as double) as pipeline_usd,
       cast(won_revenue_usd as double) as won_revenue_usd, cast(spend_usd as double) as spend_usd,
       cast(clicks as bigint) as clicks from performance""",
    "channel_summary": """
select model, channel, channel_group, cast(credited_deals as double) as credited_deals,
       cast(credited_wins as double) as credited_wins, cast(pipeline_usd as double) as pipeline_usd,
       cast(won_revenue_usd as double) as won_revenue_usd, share_of_won_revenue, cast(spend_usd as double) as spend_usd,
       pipeline_per_dollar, cost_per_credited_win from summary""",
    "model_disagreement": "select * exclude (shares) from disagreement",
    "funnel_monthly": """
select * replace (cast(pipeline_created_usd as double) as pipeline_created_usd,
                  cast(won_revenue_usd as double) as won_revenue_usd) from funnel order by month""",
    "velocity": "select * from velocity",
    "subscription_movements": """
select subscription_id, domain, start_date, """ + ", ".join(
        f"cast({c} as double) as {c}"
        for c in ("current_mrr_usd", "starting_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr")) + " from subscription_movements",
    "retention": "select * from retention",
    "truth_evaluation": "select *, dense_rank() over (order by model_mean_abs_error) as model_rank from truth_evaluation",
    "incremental_lift": "select * from lift",
    "dashboard_summary": "select * from dashboard",
    "run_summary": """
select count(*) as opps, count(*) filter (is_won) as won, cast(sum(amount) filter (is_won) as double) as won_revenue_usd,
       (select count(*) from quality where status = 'warn') as data_quality_warnings from fct_opps""",
    "recent_runs": RUNS.format("") + " order by e desc limit 14",
    "truth_evaluation_exported": "select *, dense_rank() over (order by model_mean_abs_error) as model_rank from truth_evaluation",
    "data_quality": "select quality.*, case check_name " + " ".join(
        f"when '{k}' then {_text(v)}" for k, v in DESCRIPTIONS.items()) + " end as description from quality",
    "metric_catalogue": METRIC_ROWS,
    "dashboard_extract": EXTRACT_ROWS,
    "dashboard_texts": _dashboard_texts(RUNS.format("") + " order by e desc limit 14"),
    "credited_pipeline_by_company": f"select domain, {money('pipeline')} as attributed_pipeline from company_pipeline",
    "channel_score": "select channel, round(win_rank, 9) as win_rank, round(rev_rank, 9) as rev_rank from channel_score",
    "latest_deal_per_company": "select * from latest_deal",
    "crm_payload": "select * from payload",
    "existing_by_domain": "select * from crm_records",
    "changed_rows": "select * from changed_rows",
    "split_upserts": "select * from split_upserts",
    "batch_ids": """
select domain, action, (row_number() over (partition by action order by attributed_pipeline desc, domain) - 1) // 100 as batch_id
from split_upserts""",
    "append_write_log": """
select 'hubspot' as system, 'company' as object, domain, 'dry_run' as mode, first_touch_channel,
       cast(attributed_pipeline as varchar) as attributed_pipeline, cast(source_quality_score as varchar) as source_quality_score
from changed_rows""",
    "append_run_log": RUNS.format("""'[{"step":"load"}]' as steps,"""),
    "contract_unique": _union(_unique()),
    "contract_not_null": _union(_not_null()),
    "contract_relationship": _union(_relationships()),
    "contract_accepted_values": _union(_accepted()),
    "contract_credit_sum": _broken("credit_sums_to_one"),
    "contract_every_deal": _broken("every_deal_in_every_model"),
    "contract_no_late_credit": _broken("no_credit_after_deal_created"),
    "contract_credit_range": _broken("credit_in_unit_interval"),
    "contract_reconcile": _broken("won_revenue_reconciles"),
    "contract_gate": _union(_gate()),
}


def oracle_sql() -> dict[str, str]:
    return {name: with_relations(select) for name, select in SELECTS.items()}
