"""DuckDB counterparts of the registered queries.

Each query is assembled from named relations; a relation states its result in plain SQL over the benchmark
tables, without the physical choices (buckets, landmarks, partial sums) of the Spark side.
"""

from __future__ import annotations

import re

MODELS = ("first_touch", "last_non_direct", "linear", "w_shaped", "time_decay")
MODEL_LIST = "['" + "', '".join(MODELS) + "']"


def ratio(num: str, den: str, scale: int) -> str:
    return f"cast(round(cast(cast({num} as double) / nullif(cast({den} as double), 0) as decimal(38,10)), {scale}) as double)"


def money(value: str) -> str:
    return f"cast(round(round(cast({value} as decimal(28,8)), 6), 2) as double)"


def key(*cols: str) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(cast({c} as varchar), '')" for c in cols) + "))"


def pick(k: str, *values: str | None) -> str:
    items = ", ".join("null" if v is None else f"'{v}'" for v in values)
    return f"list_extract([{items}], cast({k} % {len(values)} as int) + 1)"


INSTANT = "'%Y-%m-%dT%H:%M:%S.%fZ'"
DOMAIN = "'c' || {0} || '.example.com'"
EMAIL = "'u' || {0} || '@c' || {0} || '.example.com'"
TYPED = "' U' || {0} || '@c' || {0} || '.example.com'"
DEAL_DAY = "timestamp '2024-02-01' + to_days(cast({0} % 90 as int)) + to_hours({0} % 24)"

RELATIONS: dict[str, str] = {}

# ---------------------------------------------------------------------------------------------- staging
RELATIONS["ev"] = """
select event_id as e, user_id as u, event_type as kind, props,
       ts + to_days(cast((event_id // 10) % 4 * 30 as int)) as moment
from events"""

RELATIONS["companies"] = f"""
select c_custkey as company_id, c_name as company_name, {DOMAIN.format('c_custkey')} as domain,
       upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) || ' Goods' as industry,
       15 + (c_custkey * 37) % 3000 as employees,
       if((c_custkey * 37) % 3000 < 85, 'small', if((c_custkey * 37) % 3000 <= 985, 'mid', 'large')) as size_band,
       timestamp '2023-01-01' + to_days(cast(c_custkey % 365 as int)) as created_at
from customer"""

RELATIONS["contacts"] = f"""
select 2 * c_custkey + p as contact_id,
       if(p = 1, 'u' || c_custkey || '@gmail.com', {EMAIL.format('c_custkey')}) as email,
       if(p = 1, 'gmail.com', {DOMAIN.format('c_custkey')}) as email_domain,
       p = 1 as is_personal_email,
       'User' as first_name, cast(c_custkey as varchar) as last_name, 'user ' || c_custkey as full_name_key,
       if(p = 0, 'Counsel', null) as job_title,
       if(p = 0 or c_custkey % 5 <> 0, lpad(cast(c_custkey as varchar), 10, '0'), null) as phone_key,
       if(p = 0, c_custkey, null) as company_id,
       if(p = 0, 'lead', 'subscriber') as lifecycle_stage,
       timestamp '2023-01-01' + to_days(cast(c_custkey % 365 as int)) as created_at
from customer, (select unnest([0, 1]) as p)"""

RELATIONS["deals"] = f"""
select o_orderkey as deal_id, 'Deal ' || o_orderkey as deal_name, cast(o_totalprice as decimal(12,2)) as amount,
       case o_orderstatus when 'F' then 'closedwon' when 'P' then 'closedlost' else 'contractsent' end as current_stage,
       {DEAL_DAY.format('o_orderkey')} as created_at,
       {DEAL_DAY.format('o_orderkey')} + to_days(60) as close_date,
       o_orderstatus in ('F', 'P') as is_closed, o_orderstatus = 'F' as is_won,
       o_custkey as company_id, if(o_orderkey % 13 = 0, null, 2 * o_custkey) as contact_id
from orders"""

RELATIONS["stage_history"] = f"""
select l_orderkey as deal_id,
       case l_returnflag when 'R' then 'closedlost' when 'A' then 'closedwon' else 'qualifiedtobuy' end as stage,
       {DEAL_DAY.format('l_orderkey')} + to_days(cast(l_linenumber * 9 as int)) as changed_at
from lineitem"""

RELATIONS["web_raw"] = f"""
select e, u, moment, 'ck' || u || '.' || e % 2 as client_id, kind,
       if(kind = 'click', {pick('e', 'linkedin', 'linkedin_ads', 'google', 'adroll', 'newsletter')}, null) as utm_source,
       if(kind = 'click', {pick('e', 'cpc', 'email', 'cpc')}, null) as utm_medium,
       if(kind = 'view', {pick('e', 'google.com', 'bing.com', 'g2.com', 'capterra.com', 'linkedin.com', 'blog.example.org')}, null) as referrer
from ev where kind in ('click', 'view', 'signup')"""

RELATIONS["sessions"] = """
select cast(e as varchar) as session_id, client_id, moment as started_at, utm_source, utm_medium,
       if(kind = 'click', 'Launch-' || e % 10, null) as utm_campaign, referrer, '/' || kind as landing_page,
       case when utm_source like 'linkedin%' then 'linkedin_ads'
            when utm_source = 'adroll' then 'retargeting_ads'
            when utm_source = 'google' and utm_medium = 'cpc' then 'google_ads'
            when kind = 'signup' then 'direct'
            when referrer = 'linkedin.com' then 'organic_social'
            when referrer in ('bing.com', 'google.com') then 'organic_search'
            when referrer in ('capterra.com', 'g2.com') then 'referral'
            else 'other' end as channel
from web_raw"""

RELATIONS["form_fills"] = f"""
select cast(e as varchar) as session_id, client_id,
       if(e % 2 = 1, 'guest' || e || '@unknown.example.org',
          if(u % 17 = 0, 'u' || u || '@gmail.com', {EMAIL.format('u')})) as email,
       'demo_request' as form_name, moment as submitted_at
from web_raw where kind = 'signup'"""

RELATIONS["mail_raw"] = f"""
select e, u, moment, {TYPED.format('u')} as lead_email,
       {pick('e', 'outbound_seq', 'clay_signal_x', 'sig_post')} as campaign_name,
       {pick('e', 'sent', 'open', 'click', 'reply', 'reply')} as event_type
from ev where kind = 'purchase'"""

RELATIONS["email_events"] = f"""
select {key('campaign_name', 'lead_email', 'event_type', f'strftime(moment, {INSTANT})')} as email_event_id,
       campaign_name, if(campaign_name = 'outbound_seq', 'cold_email', 'signal_engine') as channel,
       {EMAIL.format('u')} as email, event_type, moment as event_at,
       case e % 5 when 3 then if(e % 2 = 0, 'interested', 'not_interested') when 4 then 'out_of_office' end as reply_category
from mail_raw"""

RELATIONS["error_raw"] = f"""
select e, u, moment, {TYPED.format('u')} as lead_email, strftime(moment, {INSTANT}) as instant,
       if(e % 11 = 0, 'nowhere.example.org', {DOMAIN.format('u')}) as spotted_domain,
       'https://social.example.com/posts/' || e % 40 as post
from ev where kind = 'error'"""

RELATIONS["signals"] = f"""
select {key('post', "' User ' || u", 'spotted_domain', 'instant')} as signal_id, post as linkedin_post_url,
       'user ' || u as full_name_key, 'Counsel' as commenter_title, spotted_domain as company_domain,
       if(e % 3 = 0, null, {EMAIL.format('u')}) as email, moment as detected_at
from error_raw"""

RELATIONS["bot_threads"] = f"""
select {key('lead_email', 'instant')} as thread_id, {EMAIL.format('u')} as email, moment as inbound_at,
       {pick('e', 'pricing', 'demo', 'other')} as intent_label,
       if(e % 3 = 0, null, moment + to_minutes(5)) as bot_replied_at, e % 2 = 0 as handed_off_to_human
from error_raw"""

# India is 5:30 ahead of UTC all year
RELATIONS["calls"] = f"""
select 'call' || e as call_id, {EMAIL.format('u')} as email,
       date_trunc('second', moment) - interval 330 minutes as called_at, e % 600 as duration_sec,
       {pick('e', 'meeting_booked', 'no_answer', 'not_qualified', 'call_back_later')} as outcome
from error_raw"""

RELATIONS["spend"] = """
select cast(timestamp '2024-02-01' + to_days(cast(l_orderkey % 90 as int)) as date) as spend_date,
       case l_returnflag when 'A' then 'linkedin_ads' when 'N' then 'google_ads' else 'retargeting_ads' end as channel,
       'cmp_' || l_linenumber as campaign_name, cast(l_quantity as int) as clicks,
       cast(l_extendedprice as decimal(12,2)) as spend_usd
from lineitem"""

RELATIONS["subscriptions"] = f"""
select 'sub' || c_custkey as subscription_id, {DOMAIN.format('c_custkey')} as domain,
       if(c_custkey % 5 = 0, 'canceled', 'active') as status, date '2024-05-01' as start_date,
       cast(case c_custkey % 5 when 0 then 0 when 1 then 120 else 90 end as decimal(18,2)) as current_mrr_usd
from customer"""

RELATIONS["subscription_events"] = """
select 'sub' || c_custkey as subscription_id, m.kind as event_type, cast(m.usd as decimal(18,2)) as mrr_delta_usd,
       m.day as occurred_on
from (select c_custkey, unnest(
          [{'kind': 'new', 'usd': 100, 'day': date '2024-05-01'}]
          || case c_custkey % 5
                 when 0 then [{'kind': 'expansion', 'usd': 20, 'day': date '2024-08-01'},
                              {'kind': 'churn', 'usd': -120, 'day': date '2024-11-01'}]
                 when 1 then [{'kind': 'expansion', 'usd': 20, 'day': date '2024-08-01'}]
                 else [{'kind': 'contraction', 'usd': -10, 'day': date '2024-08-01'}] end) as m
      from customer)"""

RELATIONS["channels"] = """
select * from (values ('linkedin_ads', 'paid'), ('google_ads', 'paid'), ('retargeting_ads', 'paid'),
    ('organic_search', 'organic'), ('organic_social', 'organic'), ('referral', 'organic'), ('direct', 'direct'),
    ('other', 'direct'), ('cold_email', 'outbound'), ('signal_engine', 'gtm_system'), ('reply_bot', 'gtm_system'),
    ('voice_agent', 'gtm_system'), ('unattributed', 'none')) as d(channel, channel_group)"""

# --------------------------------------------------------------------------------------------- identity
RELATIONS["persons"] = """
select a.contact_id, a.email,
       coalesce(b.contact_id, a.contact_id) as person_id,
       if(b.contact_id is not null, 'phone_match', if(a.is_personal_email, 'unmatched_personal', 'self')) as match_rule
from contacts a left join contacts b
     on a.is_personal_email and not b.is_personal_email and a.phone_key = b.phone_key"""

RELATIONS["people"] = """
select k.contact_id as person_id, k.email as work_email, k.full_name_key, k.job_title, k.company_id,
       f.domain as company_domain, k.created_at
from contacts k left join companies f on f.company_id = k.company_id
where k.company_id is not null and k.contact_id in (select person_id from persons)"""

RELATIONS["email_map"] = """
select distinct persons.email, persons.person_id, people.company_id
from persons join people on people.person_id = persons.person_id"""

RELATIONS["client_map"] = """
select client_id, min(person_id) as person_id, min(submitted_at) as first_identified_at
from form_fills natural join email_map group by client_id"""

RELATIONS["signal_matches"] = """
select s.signal_id, s.detected_at, p.person_id, p.company_id,
       if(s.email is null, 'name_and_domain', 'work_email') as match_rule
from signals s, people p
where if(s.email is null, p.full_name_key = s.full_name_key and p.company_domain = s.company_domain,
         p.work_email = s.email)"""

RELATIONS["leads"] = """
select m.person_id, x.lead_at, x.lead_source, m.company_id
from (select email, submitted_at as lead_at, 'demo_form' as lead_source from form_fills
      union all by name
      select email, event_at as lead_at, 'interested_reply' as lead_source from email_events
      where event_type = 'reply' and reply_category = 'interested') x
join email_map m on m.email = x.email"""

# -------------------------------------------------------------------------------------- touches and deals
RELATIONS["touches"] = f"""
select {key('r.source_system', 'r.source_record_id')} as touchpoint_id, r.source_record_id, r.person_id, p.company_id,
       r.touched_at, r.channel, r.touch_type, r.source_system
from (
    select session_id as source_record_id, person_id, started_at as touched_at, channel, 'web_session' as touch_type,
           'ga4' as source_system
    from sessions join client_map on client_map.client_id = sessions.client_id
    union all by name
    select x.*, person_id
    from (select email, email_event_id as source_record_id, event_at as touched_at, channel,
                 'email_' || event_type as touch_type, 'smartlead' as source_system
          from email_events where event_type not in ('sent', 'open')
          union all by name
          select email, thread_id as source_record_id, bot_replied_at as touched_at, 'reply_bot' as channel,
                 'bot_reply' as touch_type, 'reply_bot' as source_system
          from bot_threads where bot_replied_at is not null
          union all by name
          select email, call_id as source_record_id, called_at as touched_at, 'voice_agent' as channel,
                 'voice_call' as touch_type, 'voice_agent' as source_system
          from calls where outcome <> 'no_answer') x
    join email_map on email_map.email = x.email
    union all by name
    select signal_id as source_record_id, person_id, detected_at as touched_at, 'signal_engine' as channel,
           'signal_detected' as touch_type, 'clay' as source_system
    from signal_matches
) r join people p on p.person_id = r.person_id"""

RELATIONS["opps"] = """
select d.deal_id, d.deal_name, d.company_id, f.company_name, f.domain, f.industry, f.size_band, d.contact_id,
       d.contact_id is null as is_missing_contact, d.amount, d.created_at, d.current_stage, d.is_closed, d.is_won,
       h.ended as closed_at,
       cast(trunc((epoch_us(h.ended) - epoch_us(d.created_at)) / 86400000000.0) as bigint) as cycle_days,
       if(d.is_won, h.losses > 0, false) as was_reopened
from deals d
left join companies f on f.company_id = d.company_id
left join (select s.deal_id, max(changed_at) filter (stage = x.current_stage and x.is_closed) as ended,
                  count(*) filter (stage = 'closedlost') as losses
           from stage_history s join deals x on x.deal_id = s.deal_id group by s.deal_id) h on h.deal_id = d.deal_id"""

RELATIONS["lead_moment"] = """
select o.deal_id, min(l.lead_at) as lead_at
from opps o join leads l on l.company_id = o.company_id
     and l.lead_at <= o.created_at and l.lead_at + to_days(90) > o.created_at
group by o.deal_id"""

RELATIONS["journeys"] = """
select o.deal_id, t.touchpoint_id, t.person_id, t.touched_at, t.channel, t.touch_type,
       (epoch_us(o.created_at) - epoch_us(t.touched_at)) / 86400000000.0::double as days_before_deal,
       row_number() over timeline as touch_number, count(*) over deal as touch_count, m.lead_at
from opps o
join touches t on t.company_id = o.company_id
     and t.touched_at <= o.created_at and t.touched_at + to_days(90) > o.created_at
left join lead_moment m on m.deal_id = o.deal_id
window deal as (partition by o.deal_id),
       timeline as (partition by o.deal_id order by t.touched_at, t.touchpoint_id)"""

# -------------------------------------------------------------------------------------------- attribution
# A deal's touches as lists in order of time; a model is a list of weights, one for each touch.
RELATIONS["deal_timelines"] = """
select deal_id, count(*) as n, list(touchpoint_id order by touch_number) as ids, list(channel order by touch_number) as channels,
       list(touched_at order by touch_number) as times, list(days_before_deal order by touch_number) as ages,
       coalesce(max(touch_number) filter (channel not in ('direct', 'other')), count(*)) as last_non_direct_place,
       coalesce(max(touch_number) filter (touched_at <= lead_at), 1) as lead_place
from journeys group by deal_id"""

RELATIONS["deal_weights"] = """
select deal_id, ids, channels, times, [
       {'model': 'first_touch', 'weights': [if(i = 1, 1.0::double, 0) for i in range(1, n + 1)]},
       {'model': 'last_non_direct', 'weights': [if(i = last_non_direct_place, 1.0::double, 0) for i in range(1, n + 1)]},
       {'model': 'linear', 'weights': [1.0::double for i in range(1, n + 1)]},
       {'model': 'w_shaped', 'weights': [
           if(i = 1 or i = lead_place or i = n,
              0.3::double * ((i = 1)::int + (i = lead_place)::int + (i = n)::int),
              (1 - 3 * 0.3::double) / nullif(n - 3, 0)) for i in range(1, n + 1)]},
       {'model': 'time_decay', 'weights': [pow(0.5::double, a / 7.0::double) for a in ages]}] as models
from deal_timelines"""

RELATIONS["touch_credit"] = """
select deal_id, model, ids[i] as touchpoint_id, channels[i] as channel, times[i] as touched_at, weights[i] / list_sum(weights) as credit
from (select deal_id, ids, channels, times, m.model, m.weights, unnest(range(1, len(ids) + 1)) as i
      from (select deal_id, ids, channels, times, unnest(models) as m from deal_weights))
where weights[i] > 0"""

RELATIONS["unattributed"] = f"""
select deal_id, unnest({MODEL_LIST}) as model from opps where deal_id not in (select deal_id from journeys)"""

RELATIONS["attribution"] = f"""
select {key('a.deal_id', 'a.model', 'a.touchpoint_id')} as attribution_id, a.deal_id, a.model, a.touchpoint_id,
       coalesce(a.channel, 'unattributed') as channel, a.touched_at, round(a.credit, 8) as credit,
       o.created_at as deal_created_at, o.closed_at, o.is_won,
       cast(o.amount as double) * a.credit as credited_pipeline,
       if(o.is_won, cast(o.amount as double) * a.credit, 0) as credited_won_revenue
from (select * from touch_credit union all by name select *, 1.0::double as credit from unattributed) a
join opps o on o.deal_id = a.deal_id"""

RELATIONS["fct_opps"] = """
select o.*, x.first_touch_channel, x.last_non_direct_channel
from opps o left join (
    pivot (select deal_id, model || '_channel' as which, channel from attribution)
    on which in ('first_touch_channel', 'last_non_direct_channel') using max(channel) group by deal_id) x
on x.deal_id = o.deal_id"""

# -------------------------------------------------------------------------------------------------- marts
RELATIONS["dashboard"] = """
select count(*) as opps, count(*) filter (is_won) as won, count(*) filter (is_closed) as closed,
       cast(sum(amount) as double) as pipeline_usd, cast(sum(amount) filter (is_won) as double) as won_revenue_usd,
       cast(min(created_at) as date) as first_deal, cast(max(created_at) as date) as last_deal from fct_opps"""

RELATIONS["performance"] = """
select c.*, g.channel_group, s.spend_usd, s.clicks
from (select model, channel, cast(date_trunc('month', deal_created_at) as date) as month,
             round(sum(cast(credit as decimal(9,8))), 3) as credited_deals,
             round(coalesce(sum(cast(credit as decimal(9,8))) filter (is_won), 0), 3) as credited_wins,
             round(round(sum(cast(credited_pipeline as decimal(28,8))), 6), 2) as pipeline_usd,
             round(round(sum(cast(credited_won_revenue as decimal(28,8))), 6), 2) as won_revenue_usd
      from attribution group by all) c
left join channels g on g.channel = c.channel
left join (select channel, cast(date_trunc('month', spend_date) as date) as month, sum(spend_usd) as spend_usd,
                  sum(clicks) as clicks from spend group by all) s on s.channel = c.channel and s.month = c.month"""

RELATIONS["summary"] = f"""
select t.*, {ratio('won_revenue_usd', 'sum(won_revenue_usd) over (partition by model)', 4)} as share_of_won_revenue,
       s.spend_usd, {ratio('pipeline_usd', 's.spend_usd', 2)} as pipeline_per_dollar,
       {ratio('s.spend_usd', 'credited_wins', 0)} as cost_per_credited_win
from (select model, channel, channel_group, sum(credited_deals) as credited_deals, sum(credited_wins) as credited_wins,
             sum(pipeline_usd) as pipeline_usd, sum(won_revenue_usd) as won_revenue_usd
      from performance group by all) t
left join (select channel, sum(spend_usd) as spend_usd from spend group by channel) s on s.channel = t.channel"""

RELATIONS["disagreement"] = """
select *, rank() over (order by swing desc) as swing_rank
from (select v.*, round(list_max(shares) - list_min(shares), 4) as swing
      from (select channel, """ + ", ".join(
    f"max(if(model = '{m}', share_of_won_revenue, null)) as {m}" for m in MODELS) + """,
                   [""" + ", ".join(
    f"coalesce(max(if(model = '{m}', share_of_won_revenue, null)), 0)" for m in MODELS) + """] as shares
            from summary group by channel) v)"""

RELATIONS["funnel"] = f"""
select m.month, coalesce(s.sessions, 0) as sessions, coalesce(s.identified, 0) as identified_sessions,
       (select count(*) from (select min(lead_at) as moment from leads group by person_id)
        where date_trunc('month', moment) = m.month) as new_leads,
       (select count(*) from calls where outcome = 'meeting_booked' and date_trunc('month', called_at) = m.month)
           as voice_meetings_booked,
       coalesce(o.n, 0) as opps_created, coalesce(o.usd, 0) as pipeline_created_usd,
       coalesce(w.won, 0) as deals_won, coalesce(w.lost, 0) as deals_lost, coalesce(w.usd, 0) as won_revenue_usd,
       {ratio('w.won', 'w.won + w.lost', 3)} as win_rate
from (select cast(unnest(range(date_trunc('month', min(started_at)), max(started_at) + to_microseconds(1), to_months(1))) as date) as month
      from sessions) m
left join (select cast(date_trunc('month', started_at) as date) as month, count(*) as sessions,
                  count(client_map.client_id) as identified
           from sessions left join client_map on client_map.client_id = sessions.client_id group by 1) s
       on s.month = m.month
left join (select cast(date_trunc('month', created_at) as date) as month, count(*) as n, sum(amount) as usd
           from opps group by 1) o on o.month = m.month
left join (select cast(date_trunc('month', closed_at) as date) as month, count(*) filter (is_won) as won,
                  count(*) filter (not is_won) as lost, sum(amount) filter (is_won) as usd
           from opps where is_closed group by 1) w on w.month = m.month"""

RELATIONS["velocity"] = f"""
select coalesce(first_touch_channel, 'unattributed') as first_touch_channel, count(*) as opps,
       count(*) filter (is_closed) as closed_opps, count(*) filter (is_won) as won_opps,
       {ratio('count(*) filter (is_won)', 'count(*) filter (is_closed)', 3)} as win_rate,
       {ratio('sum(amount) filter (is_won)', 'count(amount) filter (is_won)', 0)} as avg_won_deal_usd,
       quantile_cont(cycle_days, 0.5) filter (is_won) as median_cycle_days_won
from fct_opps group by 1"""

RELATIONS["subscription_movements"] = """
select s.subscription_id, s.domain, s.start_date, s.current_mrr_usd,
       sum(mrr_delta_usd) filter (event_type = 'new') as starting_mrr,
       sum(mrr_delta_usd) filter (event_type = 'expansion') as expansion_mrr,
       sum(-mrr_delta_usd) filter (event_type = 'contraction') as contraction_mrr,
       sum(-mrr_delta_usd) filter (event_type = 'churn') as churned_mrr
from subscription_events v join subscriptions s on s.subscription_id = v.subscription_id group by all"""

RELATIONS["subscription_customers"] = """
select m.*, coalesce(w.first_touch_channel, 'unattributed') as source
from subscription_movements m
left join (select domain, first_touch_channel from fct_opps where is_won
           qualify row_number() over (partition by domain order by closed_at desc nulls first, deal_id desc) = 1) w
       on w.domain = m.domain"""

RELATIONS["retention"] = f"""
select first_touch_channel, count(*) as customers, cast(sum(starting_mrr) as double) as starting_mrr_usd,
       cast(sum(coalesce(expansion_mrr, 0)) as double) as expansion_mrr_usd,
       cast(sum(coalesce(contraction_mrr, 0)) as double) as contraction_mrr_usd,
       cast(sum(coalesce(churned_mrr, 0)) as double) as churned_mrr_usd,
       cast(sum(current_mrr_usd) as double) as current_mrr_usd,
       {ratio('sum(current_mrr_usd)', 'sum(starting_mrr)', 3)} as net_revenue_retention,
       {ratio('sum(least(starting_mrr, current_mrr_usd))', 'sum(starting_mrr)', 3)} as gross_revenue_retention
from (select *, unnest([source, 'all_customers']) as first_touch_channel from subscription_customers) group by first_touch_channel"""

RELATIONS["runs_off"] = f"""
select o_orderkey % 12 as replicate,
       {pick('o_orderkey', 'none', 'linkedin_ads', 'google_ads', 'retargeting_ads', 'organic_search', 'direct', 'referral',
             'cold_email', 'signal_engine', 'reply_bot', 'voice_agent')} as disabled_channel,
       sum(cast(o_totalprice as decimal(12,2))) as won_revenue
from orders group by all"""

RELATIONS["lift"] = """
select a.disabled_channel as channel, count(*) as replicates,
       cast(round(cast(avg(cast(b.won_revenue - a.won_revenue as double)) as decimal(28,6)), 2) as double) as expected_incremental_revenue,
       cast(round(cast(stddev_samp(cast(b.won_revenue - a.won_revenue as double)) / sqrt(count(*)) as decimal(28,6)), 2) as double) as std_error,
       cast(round(cast(avg(cast(b.won_revenue as double)) as decimal(28,6)), 2) as double) as expected_won_revenue
from runs_off a join runs_off b on b.replicate = a.replicate and b.disabled_channel = 'none'
where a.disabled_channel <> 'none' group by a.disabled_channel"""

RELATIONS["truth_shares"] = """
select *, avg(abs(model_share - true_share)) over (partition by model) as mae
from (select m.model, t.channel, t.true_share, coalesce(s.share_of_won_revenue, 0) as model_share
      from (select channel, greatest(expected_incremental_revenue, 0)
                   / (select sum(greatest(expected_incremental_revenue, 0)) from lift) as true_share from lift) t
      cross join (select distinct model from summary) m
      left join summary s on s.model = m.model and s.channel = t.channel)"""

RELATIONS["truth_evaluation"] = """
select model, channel, cast(round(cast(true_share as decimal(28,10)), 4) as double) as true_share, model_share,
       cast(round(cast(model_share - true_share as decimal(28,10)), 4) as double) as error,
       cast(round(cast(mae as decimal(28,10)), 4) as double) as model_mean_abs_error
from truth_shares"""

RELATIONS["checks"] = f"""
select 'utm_coverage_paid_clicks' as check_name, 0.80 as threshold, 'min' as direction,
       (select {ratio("count(*) filter (channel in ('linkedin_ads', 'google_ads', 'retargeting_ads'))", '(select sum(clicks) from spend)', 3)} from sessions) as value
union all by name
select 'identified_session_share' as check_name, 0.10 as threshold, 'min' as direction,
       (select {ratio('count(*) filter (client_id in (select client_id from client_map))', 'count(*)', 3)} from sessions) as value
union all by name
select 'unattributed_won_revenue_share' as check_name, 0.20 as threshold, 'max' as direction,
       (select {ratio("coalesce(sum(credited_won_revenue) filter (channel = 'unattributed'), 0)", '(select sum(amount) from opps where is_won)', 3)}
        from attribution where model = 'linear') as value
union all by name
select 'deals_missing_contact_share' as check_name, 0.10 as threshold, 'max' as direction,
       (select {ratio('count(*) - count(contact_id)', 'count(*)', 3)} from opps) as value
union all by name
select 'personal_email_contacts_merged' as check_name, null as threshold, 'info' as direction,
       (select count(*) from persons where match_rule = 'phone_match') as value
union all by name
select 'personal_email_contacts_unmatched' as check_name, 5 as threshold, 'max' as direction,
       (select count(*) from persons where match_rule = 'unmatched_personal') as value
union all by name
select 'clay_signals_matched_share' as check_name, 0.90 as threshold, 'min' as direction,
       (select {ratio('count(distinct signal_id)', '(select count(*) from signals)', 3)} from signal_matches) as value
union all by name
select 'reopened_won_deals' as check_name, null as threshold, 'info' as direction,
       (select count(*) from opps where was_reopened) as value"""

RELATIONS["quality"] = """
select check_name, cast(value as double) as value, cast(threshold as double) as threshold, direction,
       if((direction = 'min' and value < threshold) or (direction = 'max' and value > threshold), 'warn', 'ok') as status
from checks"""

# ---------------------------------------------------------------------------------------------------- CRM
RELATIONS["company_pipeline"] = """
select o.domain, sum(cast(a.credited_pipeline as decimal(28,8))) as pipeline
from attribution a join opps o on o.deal_id = a.deal_id where a.model = 'w_shaped' group by o.domain"""

RELATIONS["channel_results"] = """
select first_touch_channel as channel, coalesce(win_rate, 0) as win_rate,
       coalesce((select cast(won_revenue_usd as double) from summary
                 where summary.model = 'w_shaped' and summary.channel = velocity.first_touch_channel), 0) as revenue
from velocity"""

# A channel's rank is the share of the other channels that do worse.
RELATIONS["channel_score"] = """
select a.channel, coalesce(count(*) filter (b.win_rate < a.win_rate) / nullif(count(*) - 1, 0)::double, 0) as win_rank,
       coalesce(count(*) filter (b.revenue < a.revenue) / nullif(count(*) - 1, 0)::double, 0) as rev_rank
from channel_results a, channel_results b group by a.channel"""

RELATIONS["latest_deal"] = """
select domain, company_name, first_touch_channel, created_at, deal_id from fct_opps
qualify row_number() over (partition by domain order by created_at desc nulls first, deal_id desc) = 1"""

RELATIONS["payload"] = """
select n.domain, n.company_name, coalesce(n.first_touch_channel, 'unattributed') as first_touch_channel,
       cast(round(round(coalesce(p.pipeline, 0), 6), 0) as bigint) as attributed_pipeline,
       cast(round_even(round(100 * (0.6::double * coalesce(s.win_rank, 0) + 0.4::double * coalesce(s.rev_rank, 0)), 9), 0) as bigint)
           as source_quality_score
from latest_deal n left join company_pipeline p on p.domain = n.domain
left join channel_score s on s.channel = n.first_touch_channel"""

RELATIONS["crm_records"] = f"""
select c_custkey * 2 as record_id, {DOMAIN.format('c_custkey')} as domain, 'unattributed' as current_first_touch_channel,
       '0' as current_attributed_pipeline, '0.0' as current_source_quality_score
from customer where c_custkey % 2 = 0"""

RELATIONS["changed_rows"] = """
select p.*, r.record_id
from payload p left join crm_records r on r.domain = p.domain
where r.record_id is null or not (p.first_touch_channel = r.current_first_touch_channel
      and p.attributed_pipeline = cast(r.current_attributed_pipeline as double)
      and p.source_quality_score = cast(r.current_source_quality_score as double))"""

RELATIONS["split_upserts"] = "select *, if(record_id is null, 'create', 'update') as action from changed_rows"


def with_relations(select: str) -> str:
    """The select preceded by the relations it needs, directly or through others, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in RELATIONS:
            if name not in needed and re.search(rf"(?<![\w.']){name}(?![\w'(])", text):
                needed.add(name)
                visit(RELATIONS[name])

    visit(select)
    # a base table and a relation never share a name, so a plain word match finds the references
    parts = [f"{n} as ({RELATIONS[n].strip()})" for n in RELATIONS if n in needed]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + select.strip()
