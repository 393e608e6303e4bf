"""What the engine is to define, stated on its own: exports, contracts, checks and metrics."""

# Export name -> columns in export order.
RAW_FEEDS = {'hubspot_companies': ['hs_object_id', 'name', 'domain', 'industry', 'numberofemployees', 'createdate'],
 'hubspot_contacts': ['hs_object_id', 'email', 'firstname', 'lastname', 'jobtitle', 'phone', 'associatedcompanyid',
                      'lifecyclestage', 'createdate'],
 'hubspot_deals': ['hs_object_id', 'dealname', 'amount', 'pipeline', 'dealstage', 'createdate', 'closedate',
                   'hs_is_closed', 'associatedcompanyid', 'associatedcontactid'],
 'hubspot_deal_stage_history': ['deal_id', 'dealstage', 'changed_at'],
 'ga4_sessions': ['session_id', 'client_id', 'session_start', 'utm_source', 'utm_medium', 'utm_campaign', 'referrer',
                  'landing_page'],
 'ga4_form_fills': ['session_id', 'client_id', 'email', 'form_name', 'submitted_at'],
 'linkedin_ads_daily': ['date', 'campaign_name', 'impressions', 'clicks', 'cost_in_usd'],
 'google_ads_daily': ['segments_date', 'campaign_name', 'metrics_clicks', 'metrics_cost_micros'],
 'adroll_daily': ['day', 'campaign', 'clicks', 'spend'],
 'smartlead_email_events': ['campaign_name', 'lead_email', 'event_type', 'event_time', 'reply_category'],
 'clay_signal_leads': ['linkedin_post_url', 'commenter_name', 'commenter_title', 'company_domain', 'work_email',
                       'detected_at'],
 'reply_bot_threads': ['lead_email', 'inbound_at', 'intent_label', 'bot_replied_at', 'handed_off_to_human'],
 'voice_agent_calls': ['call_id', 'lead_email', 'phone', 'called_at_ist', 'duration_sec', 'outcome'],
 'stripe_subscriptions': ['id', 'customer_domain', 'status', 'start_date', 'current_mrr_cents'],
 'stripe_subscription_events': ['subscription_id', 'event_type', 'mrr_delta_cents', 'occurred_on']}

# Columns that must be unique, filled, known to a parent, or from a vocabulary.
UNIQUE = {'stg_companies': ['company_id', 'domain'],
 'stg_contacts': ['contact_id'],
 'stg_deals': ['deal_id'],
 'stg_sessions': ['session_id'],
 'stg_calls': ['call_id'],
 'identity_contacts': ['contact_id'],
 'identity_email_map': ['email'],
 'identity_client_map': ['client_id'],
 'touchpoints': ['touchpoint_id'],
 'opportunities': ['deal_id'],
 'fct_attribution': ['attribution_id'],
 'fct_opportunities': ['deal_id'],
 'data_quality': ['check_name']}
NOT_NULL = {'stg_companies': ['company_id', 'domain'],
 'stg_contacts': ['contact_id', 'email'],
 'stg_deals': ['deal_id', 'amount', 'company_id'],
 'stg_sessions': ['session_id'],
 'stg_calls': ['call_id'],
 'identity_contacts': ['contact_id'],
 'identity_email_map': ['email'],
 'identity_client_map': ['client_id'],
 'touchpoints': ['touchpoint_id', 'company_id'],
 'opportunities': ['deal_id'],
 'fct_attribution': ['attribution_id'],
 'fct_opportunities': ['deal_id']}
RELATIONSHIPS = (('stg_deals', 'company_id', 'stg_companies', 'company_id'), ('stg_sessions', 'channel', 'dim_channel', 'channel'),
 ('touchpoints', 'channel', 'dim_channel', 'channel'), ('fct_attribution', 'channel', 'dim_channel', 'channel'))
ACCEPTED = (('stg_deals', 'current_stage',
  ('appointmentscheduled', 'qualifiedtobuy', 'presentationscheduled', 'decisionmakerboughtin', 'contractsent',
   'closedwon', 'closedlost')),
 ('stg_email_events', 'event_type', ('sent', 'open', 'click', 'reply')),
 ('fct_attribution', 'model', ('first_touch', 'last_non_direct', 'linear', 'w_shaped', 'time_decay')))

# Data-quality checks and what they say.
DESCRIPTIONS = {'utm_coverage_paid_clicks': 'Paid ad clicks that reached the site with their tags, as a share of all paid clicks',
 'identified_session_share': 'Web sessions that belong to a known person, as a share of all sessions',
 'unattributed_won_revenue_share': 'Won revenue without any touch in the look-back window',
 'deals_missing_contact_share': 'Deals the CRM links to no contact',
 'personal_email_contacts_merged': 'Personal-email contacts merged into a work contact by phone',
 'personal_email_contacts_unmatched': 'Personal-email contacts left without a work contact',
 'clay_signals_matched_share': 'Buying signals matched to a known person',
 'reopened_won_deals': 'Won deals that had been marked lost before'}

# Metric name, table, column, grain, version, definition, history.
METRICS = (('won_revenue_by_model', 'channel_summary', 'won_revenue_usd', 'model, channel', 2,
  "Won deal amounts split over channels by the chosen model; won means the deal's current stage",
  'v1 took any closedlost in the history as lost; v2 looks at the current stage, so that reopened deals count once'),
 ('pipeline_by_model', 'channel_summary', 'pipeline_usd', 'model, channel', 1,
  'Amounts of all deals created, open or closed, split over channels by the chosen model', None),
 ('share_of_won_revenue', 'channel_summary', 'share_of_won_revenue', 'model, channel', 1,
  "A channel's part of all won revenue under one model, unattributed revenue included", None),
 ('pipeline_per_dollar', 'channel_summary', 'pipeline_per_dollar', 'model, channel', 1,
  'Credited pipeline per dollar of ad spend of the same channel, all time', None),
 ('cost_per_credited_win', 'channel_summary', 'cost_per_credited_win', 'model, channel', 1,
  'Ad spend per credited (possibly fractional) win', None),
 ('model_swing', 'model_disagreement', 'swing', 'channel', 1,
  'Highest minus lowest share of won revenue over the five models', None),
 ('win_rate', 'funnel_monthly', 'win_rate', 'month', 1, 'Won deals among the deals closed in the month', None),
 ('median_cycle_days_won', 'velocity', 'median_cycle_days_won', 'first_touch_channel', 1,
  'Median days from creation to win, by the channel of the first touch', None),
 ('new_leads', 'funnel_monthly', 'new_leads', 'month', 1,
  'People whose first demo form or interested reply fell in the month', None),
 ('net_revenue_retention', 'retention', 'net_revenue_retention', 'first_touch_channel', 1,
  'Current over starting recurring revenue, by the first-touch channel of the winning deal', None),
 ('gross_revenue_retention', 'retention', 'gross_revenue_retention', 'first_touch_channel', 2,
  'As net retention, but a customer counts with at most the starting revenue',
  'v1 subtracted contraction and churn and could fall below zero; v2 caps each customer at the starting revenue'),
 ('unattributed_won_revenue_share', 'data_quality', 'value', 'check_name', 1,
  'Part of won revenue whose deals have no touch in the look-back window', None),
 ('model_mean_abs_error', 'truth_evaluation', 'model_mean_abs_error', 'model, channel', 1,
  "Mean distance of a model's channel shares from the measured incremental shares", None),
 ('attributed_pipeline', 'crm_payload', 'attributed_pipeline', 'company', 1,
  'W-shaped pipeline of all deals of a company, as pushed to the CRM', None),
 ('source_quality_score', 'crm_payload', 'source_quality_score', 'company', 1,
  '0 to 100 score of the first-touch channel: 60% win rate rank, 40% W-shaped won revenue rank', None))
