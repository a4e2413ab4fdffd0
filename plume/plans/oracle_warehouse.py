"""DuckDB oracle SQL for the warehouse pipeline (upstream -> staging -> marts).

Written as direct SQL over the driver tables: per-user order uses plain
``PARTITION BY user_id`` windows here, which the Spark side replaces with
bucketed windows; both must give the same rows.
"""

from __future__ import annotations

import re

from ..params import FIXTURE as P
from .oracle_reviews import rnd

GAP_US = P.session_gap_minutes * 60_000_000
START, END, AS_OF = P.start_date.isoformat(), P.end_date.isoformat(), P.as_of.isoformat()


def _div(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


def _top(grain: str, member: str, out: str) -> str:
    return (f"SELECT date_key, {member} AS {out}, rev AS {out}_measure FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY date_key ORDER BY rev DESC NULLS LAST, {member} ASC NULLS FIRST) AS rn FROM {grain}) "
            f"WHERE rn = 1")


DAILY_SALES = f"""
ds_o AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS date_key FROM orders),
ds_lo AS (SELECT l.l_orderkey, l.l_partkey, l.l_extendedprice * (1 - l.l_discount) AS rev, l.l_quantity,
                 o.o_custkey, o.date_key
          FROM lineitem l JOIN ds_o o ON l.l_orderkey = o.o_orderkey),
ds_day_o AS (SELECT date_key, count(*) AS total_orders, count(DISTINCT o_custkey) AS unique_customers,
                    count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS delivered_orders FROM ds_o GROUP BY 1),
ds_day_li AS (SELECT date_key, sum(rev) AS revenue, sum(l_quantity) AS items FROM ds_lo GROUP BY 1),
ds_cat AS (SELECT g.date_key, p.p_type, sum(g.rev) AS rev
           FROM (SELECT date_key, l_partkey, sum(rev) AS rev FROM ds_lo GROUP BY 1, 2) g
           JOIN part p ON g.l_partkey = p.p_partkey GROUP BY 1, 2),
ds_state AS (SELECT g.date_key, n.n_name, sum(g.rev) AS rev
             FROM (SELECT date_key, o_custkey, sum(rev) AS rev FROM ds_lo GROUP BY 1, 2) g
             JOIN customer c ON g.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
             GROUP BY 1, 2),
ds_top_cat AS ({_top('ds_cat', 'p_type', 'top_product_category')}),
ds_top_state AS ({_top('ds_state', 'n_name', 'top_state')}),
daily_sales AS (
  SELECT d.date_key, total_orders, {rnd('coalesce(revenue, 0.0)', 4)} AS total_revenue,
    {rnd('coalesce(items, 0.0)', 4)} AS total_items_sold, unique_customers,
    {rnd(_div(rnd('coalesce(revenue, 0.0)', 4), 'total_orders'), 6)} AS avg_order_value,
    {rnd(_div(rnd('coalesce(items, 0.0)', 4), 'total_orders'), 6)} AS avg_items_per_order,
    top_product_category, top_state, delivered_orders,
    {rnd(_div('delivered_orders * 100.0', 'total_orders'), 6)} AS delivery_performance_score
  FROM ds_day_o d LEFT JOIN ds_day_li USING (date_key) LEFT JOIN ds_top_cat USING (date_key)
  LEFT JOIN ds_top_state USING (date_key))"""

DAILY_MARKETING = f"""
dm_lines AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date_key, l.l_partkey % 40 AS campaign, c.c_mktsegment AS channel,
         l.l_extendedprice * (1 - l.l_discount) AS rev,
         0.1 * l.l_extendedprice * (1 + (CAST(l.l_shipdate AS DATE) - DATE '1970-01-01') % 10) AS spend,
         l.l_quantity
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey),
dm_grain AS (SELECT date_key, campaign, channel, sum(spend) AS spend, sum(rev) AS rev, sum(l_quantity) AS clicks,
                    count(*) AS conversions FROM dm_lines GROUP BY 1, 2, 3),
dm_day AS (SELECT date_key, sum(spend) AS spend, sum(rev) AS rev, sum(clicks) AS clicks,
                  CAST(sum(conversions) AS BIGINT) AS conversions, count(DISTINCT campaign) AS unique_campaigns,
                  count(DISTINCT channel) AS active_channels FROM dm_grain GROUP BY 1),
dm_ch AS (SELECT date_key, channel, sum(rev) AS rev FROM dm_grain GROUP BY 1, 2),
dm_cp AS (SELECT date_key, 'Campaign ' || CAST(campaign AS VARCHAR) AS campaign_name, sum(rev) AS rev
          FROM dm_grain GROUP BY 1, 2),
dm_top_ch AS ({_top('dm_ch', 'channel', 'top_performing_channel')}),
dm_top_cp AS ({_top('dm_cp', 'campaign_name', 'top_performing_campaign')}),
daily_marketing AS (
  SELECT date_key, {rnd('spend', 4)} AS total_spend, {rnd('clicks * 100.0', 4)} AS total_impressions,
    {rnd('clicks', 4)} AS total_clicks, conversions AS total_conversions, unique_campaigns, active_channels,
    {rnd(_div('clicks * 100.0', 'clicks * 100.0'), 6)} AS avg_ctr,
    {rnd(_div('conversions * 100.0', 'clicks'), 6)} AS avg_conversion_rate,
    {rnd(_div('spend', 'clicks'), 6)} AS avg_cpc, {rnd(_div('spend', 'conversions'), 6)} AS avg_cpa,
    top_performing_channel, top_performing_campaign,
    {rnd(_div('top_performing_channel_measure * 100.0', 'rev'), 6)} AS channel_performance_score,
    {rnd(_div('rev', 'spend'), 6)} AS roas
  FROM dm_day LEFT JOIN dm_top_ch USING (date_key) LEFT JOIN dm_top_cp USING (date_key))"""


def sessions_sql(name: str, events: str) -> str:
    """Sessions of ``events`` with a plain per-user window (new session when gap > G)."""
    return f"""
{name}_ev AS (SELECT *, epoch_us(ts) AS t FROM {events}),
{name}_flag AS (SELECT *, CASE WHEN lag(t) OVER w IS NULL OR t - lag(t) OVER w > {GAP_US} THEN 1 ELSE 0 END AS st
                FROM {name}_ev WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)),
{name}_sid AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS sn
               FROM {name}_flag),
{name} AS (
  SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events,
    count(CASE WHEN event_type = 'view' THEN 1 END) AS page_views,
    count(CASE WHEN event_type = 'click' THEN 1 END) AS clicks,
    count(CASE WHEN event_type = 'purchase' THEN 1 END) > 0 AS converted,
    {rnd("coalesce(sum(CASE WHEN event_type = 'purchase' THEN value END), 0.0)", 6)} AS session_value,
    (max(t) - min(t)) / 60000000.0 AS duration_minutes
  FROM {name}_sid GROUP BY user_id, sn)"""


DAILY_ENGAGEMENT = sessions_sql("sessions", "events") + f""",
de_s AS (SELECT *, CAST(session_start AS DATE) - 9496 AS date_key FROM sessions),
de_g AS (SELECT date_key, count(DISTINCT user_id) AS active_users, count(*) AS total_sessions,
                sum(duration_minutes) AS minutes, CAST(sum(page_views) AS BIGINT) AS total_page_views,
                count(CASE WHEN n_events = 1 THEN 1 END) AS bounce_sessions,
                count(CASE WHEN converted THEN 1 END) AS conversion_sessions, sum(session_value) AS value
         FROM de_s GROUP BY 1),
daily_engagement AS (
  SELECT date_key, active_users, total_sessions, {rnd('minutes', 4)} AS total_session_minutes,
    {rnd(_div('minutes', 'total_sessions'), 6)} AS avg_session_duration, total_page_views,
    {rnd(_div('total_page_views', 'total_sessions'), 6)} AS avg_page_views_per_session,
    bounce_sessions, conversion_sessions, {rnd('value', 4)} AS total_session_value,
    {rnd(_div('bounce_sessions * 100.0', 'total_sessions'), 6)} AS bounce_rate,
    {rnd(_div('conversion_sessions * 100.0', 'total_sessions'), 6)} AS conversion_rate
  FROM de_g)"""


def _ratio(cond: str, num: str, den: str, default: str = "0.0") -> str:
    return f"CASE WHEN {cond} THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE {default} END"


def _roas_tier(r: str) -> str:
    return (f"CASE WHEN {r} >= {P.excellent_roas_threshold} THEN 'Excellent' WHEN {r} >= {P.good_roas_threshold} "
            f"THEN 'Good' WHEN {r} >= {P.breakeven_roas_threshold} THEN 'Break-even' ELSE 'Poor' END")


_DATE_FILTER = f"WHERE date_key IS NOT NULL AND date_key BETWEEN DATE '{START}' AND DATE '{END}'"

STG_SALES = f"""
stg_sales AS (
  SELECT date_key, coalesce(total_orders, 0) AS total_orders, coalesce(total_revenue, 0.0) AS total_revenue,
    coalesce(total_items_sold, 0.0) AS total_items_sold, coalesce(unique_customers, 0) AS unique_customers,
    coalesce(avg_order_value, 0.0) AS avg_order_value, coalesce(avg_items_per_order, 0.0) AS avg_items_per_order,
    coalesce(top_product_category, 'Unknown') AS top_product_category, coalesce(top_state, 'Unknown') AS top_state,
    coalesce(delivered_orders, 0) AS delivered_orders,
    coalesce(delivery_performance_score, 0.0) AS delivery_performance_score,
    coalesce(total_revenue > 0, false) AS has_revenue_data, coalesce(unique_customers > 0, false) AS has_customer_data,
    {rnd(_ratio('total_orders > 0', 'total_revenue', 'total_orders'), 6)} AS calculated_aov,
    {rnd(_ratio('delivered_orders > 0 AND total_orders > 0', 'delivered_orders * 100.0', 'total_orders'), 6)}
      AS delivery_rate_pct
  FROM daily_sales {_DATE_FILTER})"""

STG_MARKETING = f"""
stg_marketing AS (
  SELECT date_key, coalesce(total_spend, 0.0) AS total_spend, coalesce(total_impressions, 0.0) AS total_impressions,
    coalesce(total_clicks, 0.0) AS total_clicks, coalesce(total_conversions, 0) AS total_conversions,
    coalesce(unique_campaigns, 0) AS unique_campaigns, coalesce(active_channels, 0) AS active_channels,
    coalesce(avg_ctr, 0.0) AS avg_ctr, coalesce(avg_conversion_rate, 0.0) AS avg_conversion_rate,
    coalesce(avg_cpc, 0.0) AS avg_cpc, coalesce(avg_cpa, 0.0) AS avg_cpa,
    coalesce(top_performing_channel, 'Unknown') AS top_performing_channel,
    coalesce(top_performing_campaign, 'Unknown') AS top_performing_campaign,
    coalesce(channel_performance_score, 0.0) AS channel_performance_score, coalesce(roas, 0.0) AS roas,
    coalesce(total_spend > 0, false) AS has_spend_data, coalesce(total_impressions > 0, false) AS has_impression_data,
    coalesce(total_conversions > 0, false) AS has_conversion_data,
    {_roas_tier('roas')} AS roas_tier,
    {rnd(_ratio('total_impressions > 0', 'total_clicks * 100.0', 'total_impressions'), 6)} AS calculated_ctr,
    {rnd(_ratio('total_clicks > 0', 'total_conversions * 100.0', 'total_clicks'), 6)} AS calculated_conversion_rate,
    {rnd(_ratio('total_spend > 0 AND total_conversions > 0', 'total_spend', 'total_conversions', 'NULL'), 6)}
      AS calculated_cpa
  FROM daily_marketing {_DATE_FILTER})"""


def _part(cond: str, value: str) -> str:
    return f"(CASE WHEN {cond} THEN {value} ELSE 0.0 END)"


_ENG_SCORE = ("least(100.0, " + " + ".join([
    _part("avg_session_duration > 0", "least(avg_session_duration * 2.0, 20.0)"),
    _part("bounce_rate < 100", "(100.0 - bounce_rate) * 0.3"),
    _part("conversion_rate > 0", "least(conversion_rate * 5.0, 25.0)"),
    _part("avg_page_views_per_session > 1", "least((avg_page_views_per_session - 1.0) * 5.0, 15.0)"),
    "(CASE WHEN active_users > 100 THEN 20.0 WHEN active_users > 50 THEN 15.0 WHEN active_users > 10 THEN 10.0 "
    "ELSE 5.0 END)"]) + ")")

STG_ENGAGEMENT = f"""
stg_engagement AS (
  SELECT date_key, coalesce(active_users, 0) AS active_users, coalesce(total_sessions, 0) AS total_sessions,
    coalesce(total_session_minutes, 0.0) AS total_session_minutes,
    coalesce(avg_session_duration, 0.0) AS avg_session_duration, coalesce(total_page_views, 0) AS total_page_views,
    coalesce(avg_page_views_per_session, 0.0) AS avg_page_views_per_session,
    coalesce(bounce_sessions, 0) AS bounce_sessions, coalesce(conversion_sessions, 0) AS conversion_sessions,
    coalesce(total_session_value, 0.0) AS total_session_value, coalesce(bounce_rate, 0.0) AS bounce_rate,
    coalesce(conversion_rate, 0.0) AS conversion_rate,
    coalesce(active_users > 0, false) AS has_user_data, coalesce(total_sessions > 0, false) AS has_session_data,
    coalesce(total_session_value > 0, false) AS has_value_data,
    {rnd(_ratio('total_sessions > 0', 'active_users', 'total_sessions'), 6)} AS users_per_session_ratio,
    {rnd(_ratio('active_users > 0', 'total_page_views', 'active_users'), 6)} AS page_views_per_user,
    {rnd(_ratio('conversion_sessions > 0', 'total_session_value', 'conversion_sessions'), 6)} AS avg_conversion_value,
    CASE WHEN avg_session_duration >= 10 AND bounce_rate <= 30 AND conversion_rate >= 5 THEN 'High'
         WHEN avg_session_duration >= 5 AND bounce_rate <= 50 AND conversion_rate >= 2 THEN 'Medium'
         WHEN avg_session_duration >= 2 AND bounce_rate <= 70 THEN 'Low' ELSE 'Very Low' END AS engagement_quality,
    {rnd(_ENG_SCORE, 6)} AS engagement_score
  FROM daily_engagement {_DATE_FILTER})"""

SPINE = f"""
date_spine AS (SELECT CAST(range AS DATE) AS date_day
               FROM range(TIMESTAMP '{START}', TIMESTAMP '{END}', INTERVAL 1 DAY))"""

UNIFIED = f"""
unified_daily AS (
  SELECT ds.date_day AS date_key,
    coalesce(s.total_orders, 0) AS total_orders, coalesce(s.total_revenue, 0.0) AS total_revenue,
    coalesce(s.total_items_sold, 0.0) AS total_items_sold, coalesce(s.unique_customers, 0) AS unique_customers,
    coalesce(s.avg_order_value, 0.0) AS avg_order_value, coalesce(s.delivery_rate_pct, 0.0) AS delivery_rate_pct,
    s.has_revenue_data,
    coalesce(m.total_spend, 0.0) AS total_marketing_spend, coalesce(m.total_impressions, 0.0) AS total_impressions,
    coalesce(m.total_clicks, 0.0) AS total_clicks, coalesce(m.total_conversions, 0) AS total_conversions,
    coalesce(m.roas, 0.0) AS marketing_roas, coalesce(m.calculated_ctr, 0.0) AS marketing_ctr,
    coalesce(m.calculated_conversion_rate, 0.0) AS marketing_conversion_rate, m.roas_tier, m.has_spend_data,
    coalesce(e.active_users, 0) AS active_users, coalesce(e.total_sessions, 0) AS total_sessions,
    coalesce(e.avg_session_duration, 0.0) AS avg_session_duration, coalesce(e.total_page_views, 0) AS total_page_views,
    coalesce(e.bounce_rate, 0.0) AS bounce_rate, coalesce(e.conversion_rate, 0.0) AS engagement_conversion_rate,
    coalesce(e.engagement_score, 0.0) AS engagement_score, e.engagement_quality, e.has_user_data,
    s.date_key IS NOT NULL AS sales_data_available, m.date_key IS NOT NULL AS marketing_data_available,
    e.date_key IS NOT NULL AS engagement_data_available,
    {rnd("(CASE WHEN s.date_key IS NOT NULL THEN 33.33 ELSE 0.0 END + CASE WHEN m.date_key IS NOT NULL THEN 33.33 ELSE 0.0 END + CASE WHEN e.date_key IS NOT NULL THEN 33.34 ELSE 0.0 END)", 2)}
      AS data_completeness_score
  FROM date_spine ds LEFT JOIN stg_sales s ON ds.date_day = s.date_key
  LEFT JOIN stg_marketing m ON ds.date_day = m.date_key LEFT JOIN stg_engagement e ON ds.date_day = e.date_key)"""

_BIZ_SCORE = ("least(100.0, " + " + ".join([
    _part("total_revenue > 0", "least(total_revenue / 1000.0, 30.0)"),
    _part("marketing_roas > 0", "least(marketing_roas * 5.0, 25.0)"),
    _part("engagement_score > 0", "engagement_score * 0.25"),
    _part("delivery_rate_pct > 0", "delivery_rate_pct * 0.2")]) + ")")

KPIS = f"""
business_kpis AS (
  SELECT date_key, total_orders, total_revenue, total_items_sold, unique_customers, avg_order_value,
    delivery_rate_pct, total_marketing_spend, total_impressions, total_clicks, total_conversions, marketing_roas,
    marketing_ctr, marketing_conversion_rate, roas_tier, active_users, total_sessions, avg_session_duration,
    total_page_views, bounce_rate, engagement_conversion_rate, engagement_score, engagement_quality,
    {rnd(_ratio('unique_customers > 0 AND total_marketing_spend > 0', 'total_marketing_spend', 'unique_customers'), 6)}
      AS customer_acquisition_cost,
    {rnd(_ratio('active_users > 0 AND total_revenue > 0', 'total_revenue', 'active_users'), 6)} AS revenue_per_user,
    {rnd(_ratio('total_marketing_spend > 0 AND total_revenue > 0', '(total_revenue - total_marketing_spend) * 100.0', 'total_marketing_spend'), 6)}
      AS marketing_roi_percentage,
    {rnd(_ratio('total_marketing_spend > 0 AND total_revenue > 0', 'total_revenue', 'total_marketing_spend'), 6)}
      AS marketing_efficiency_ratio,
    {rnd(_ratio('total_sessions > 0 AND total_revenue > 0', 'total_revenue', 'total_sessions'), 6)} AS revenue_per_session,
    {rnd(_BIZ_SCORE, 6)} AS overall_business_score,
    {rnd('avg_order_value * 3.5', 6)} AS estimated_customer_lifetime_value,
    {rnd(_ratio('unique_customers > 0 AND total_orders > 0', 'total_orders', 'unique_customers'), 6)}
      AS orders_per_customer,
    sales_data_available, marketing_data_available, engagement_data_available, data_completeness_score,
    marketing_roas >= {P.excellent_roas_threshold} AS is_high_roas_day,
    engagement_score >= {P.high_engagement_score} AS is_high_engagement_day,
    coalesce(total_revenue > 0 AND total_marketing_spend > 0
             AND ({_ratio('total_marketing_spend > 0', 'total_revenue', 'total_marketing_spend')}) > 2, false)
      AS is_profitable_day
  FROM unified_daily)"""

CAMPAIGNS = f"""
cp_g AS (SELECT l_partkey % 40 AS campaign_id,
                sum(0.1 * l_extendedprice * (1 + (l_partkey % 40) % 10)) AS spend,
                sum(l_extendedprice * (1 - l_discount)) AS rev, sum(l_quantity) AS clicks, count(*) AS conversions,
                min(CAST(l_shipdate AS DATE)) AS first_day, max(CAST(l_shipdate AS DATE)) AS last_day
         FROM lineitem GROUP BY 1),
campaigns AS (
  SELECT campaign_id, 'Campaign ' || CAST(campaign_id AS VARCHAR) AS campaign_name,
    ['Search', 'Display', 'Social', 'Video'][((campaign_id % 4) + 4) % 4 + 1] AS campaign_type,
    {rnd('spend', 4)} AS total_spend, {rnd('clicks * 100.0', 4)} AS total_impressions, {rnd('clicks', 4)} AS total_clicks,
    conversions AS total_conversions, {rnd('rev', 4)} AS attributed_revenue,
    CAST(last_day - first_day + 1 AS INTEGER) AS campaign_duration_days,
    {rnd(_div('clicks * 100.0', 'clicks * 100.0'), 6)} AS overall_ctr,
    {rnd(_div('conversions * 100.0', 'clicks'), 6)} AS overall_conversion_rate,
    {rnd(_div('spend', 'clicks'), 6)} AS overall_cpc, {rnd(_div('spend', 'conversions'), 6)} AS overall_cpa,
    {rnd(_div('rev', 'spend'), 6)} AS roas, {_roas_tier(_div('rev', 'spend'))} AS performance_tier,
    {rnd(f"least(100.0, {_div('rev', 'spend')} * 20.0)", 2)} AS efficiency_score
  FROM cp_g)"""

CAMPAIGN_SUMMARY = f"""
campaign_summary AS (
  SELECT *,
    row_number() OVER (ORDER BY roas DESC NULLS FIRST, campaign_id) AS roas_rank,
    row_number() OVER (ORDER BY attributed_revenue DESC NULLS FIRST, campaign_id) AS revenue_rank,
    row_number() OVER (ORDER BY efficiency_score DESC NULLS FIRST, campaign_id) AS efficiency_rank,
    CASE WHEN roas >= {P.excellent_roas_threshold} AND efficiency_score >= 80 THEN 'Excellent'
         WHEN roas >= {P.good_roas_threshold} AND efficiency_score >= 60 THEN 'Good'
         WHEN roas >= {P.breakeven_roas_threshold} AND efficiency_score >= 40 THEN 'Average'
         ELSE 'Needs Improvement' END AS campaign_health_status,
    {rnd(_ratio('total_spend > 0 AND attributed_revenue > 0', '(attributed_revenue - total_spend) * 100.0', 'total_spend'), 6)}
      AS roi_percentage
  FROM campaigns)"""

ATTRIBUTION = f"""
at_e AS (SELECT event_id, ts, user_id, event_type, value, event_type = 'purchase' AS is_purchase,
                coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (
                  PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                  AS epoch
         FROM events),
at_conv AS (SELECT user_id, epoch, ts AS conv_ts, value AS conv_value FROM at_e WHERE is_purchase),
at_touch AS (SELECT user_id, epoch, event_id, ts, event_type AS channel,
                    count(*) OVER (PARTITION BY user_id, epoch) AS n_touch,
                    row_number() OVER (PARTITION BY user_id, epoch ORDER BY ts, event_id) = 1 AS is_first,
                    row_number() OVER (PARTITION BY user_id, epoch ORDER BY ts DESC, event_id DESC) = 1 AS is_last
             FROM at_e WHERE NOT is_purchase),
at_t AS (SELECT channel, 1.0 / n_touch AS w, conv_value / n_touch AS rv,
                (epoch_us(conv_ts) - epoch_us(ts)) / 86400000000.0 AS days, is_first, is_last
         FROM at_touch JOIN at_conv USING (user_id, epoch)),
at_g AS (SELECT channel, sum(w) AS conv, sum(rv) AS rev, count(CASE WHEN is_first THEN 1 END) AS first_touch_conversions,
                count(CASE WHEN is_last THEN 1 END) AS last_touch_conversions,
                count(CASE WHEN NOT is_first AND NOT is_last THEN 1 END) AS assisted_conversions,
                avg(days) AS days, count(*) AS touches FROM at_t GROUP BY channel),
attribution AS (
  SELECT channel, 'linear' AS attribution_model, {rnd('conv', 6)} AS total_attributed_conversions,
    {rnd('rev', 4)} AS total_attributed_revenue, first_touch_conversions, last_touch_conversions,
    assisted_conversions, {rnd('days', 6)} AS avg_time_to_conversion_days,
    {rnd(_div('conv * 100.0', '(SELECT sum(conv) FROM at_g)'), 6)} AS channel_contribution_score,
    CAST(touches AS DOUBLE) AS attribution_weight_total
  FROM at_g)"""


def _touch_model(model: str, touch: str) -> str:
    """The attribution blocks for a model that gives all to one touch; names get the model's in front."""
    text = ATTRIBUTION.replace("1.0 / n_touch AS w, conv_value / n_touch AS rv", f"CASE WHEN {touch} THEN 1.0 ELSE 0.0 END AS w, "
                               f"CASE WHEN {touch} THEN conv_value ELSE 0.0 * conv_value END AS rv").replace("'linear'", f"'{model}'")
    for name in ("at_e", "at_conv", "at_touch", "at_t", "at_g"):
        text = re.sub(rf"\b{name}\b", f"{model}_{name}", text)
    return text.replace("\nattribution AS", f"\n{model} AS")


ATTRIBUTION_MODELS = """
attribution_models AS (SELECT * FROM first_touch UNION ALL SELECT * FROM last_touch)"""

CHANNEL_SUMMARY = f"""
channel_summary AS (
  SELECT *,
    row_number() OVER (ORDER BY total_attributed_revenue DESC NULLS FIRST, channel) AS channel_revenue_rank,
    row_number() OVER (ORDER BY channel_contribution_score DESC NULLS FIRST, channel) AS channel_contribution_rank,
    {rnd(_ratio('total_attributed_conversions > 0', 'total_attributed_revenue', 'total_attributed_conversions'), 6)}
      AS revenue_per_conversion,
    CASE WHEN channel_contribution_score >= 20 THEN 'Primary' WHEN channel_contribution_score >= 10 THEN 'Secondary'
         WHEN channel_contribution_score >= 5 THEN 'Supporting' ELSE 'Minor' END AS channel_importance_tier
  FROM attribution)"""

MONTHLY = f"""
mt_g AS (SELECT CAST(month(date_key) AS INTEGER) AS month_num, CAST(quarter(date_key) AS INTEGER) AS quarter_num,
                CAST(year(date_key) AS INTEGER) AS year_num, sum(total_spend) AS spend, avg(roas) AS roas,
                CAST(sum(total_conversions) AS BIGINT) AS monthly_conversions
         FROM stg_marketing GROUP BY 1, 2, 3),
monthly_trends AS (
  SELECT month_num, quarter_num, year_num, {rnd('spend', 4)} AS monthly_spend, {rnd('roas', 6)} AS avg_monthly_roas,
    monthly_conversions, {rnd('lag(spend) OVER (ORDER BY year_num, month_num)', 4)} AS prev_month_spend,
    {rnd('CASE WHEN lag(spend) OVER (ORDER BY year_num, month_num) > 0 THEN (spend - lag(spend) OVER (ORDER BY year_num, month_num)) / lag(spend) OVER (ORDER BY year_num, month_num) * 100.0 ELSE 0.0 END', 6)}
      AS spend_growth_pct
  FROM mt_g)"""

DIM_MARKETING = f"""
dim_marketing AS (
  SELECT cs.campaign_id, cs.campaign_name, cs.campaign_type, cs.total_spend AS campaign_spend,
    cs.attributed_revenue AS campaign_revenue, cs.roas AS campaign_roas, cs.performance_tier AS campaign_tier,
    cs.campaign_health_status, cs.roas_rank, cs.revenue_rank, cs.efficiency_rank, cs.roi_percentage AS campaign_roi_pct,
    tc.channel AS top_channel, tc.channel_contribution_score AS top_channel_contribution,
    tc.channel_importance_tier AS top_channel_tier, mt.total_annual_spend, mt.avg_annual_roas, mt.avg_monthly_growth_pct
  FROM campaign_summary cs
  CROSS JOIN (SELECT channel, channel_contribution_score, channel_importance_tier FROM channel_summary
              ORDER BY channel_revenue_rank LIMIT 1) tc
  CROSS JOIN (SELECT {rnd('sum(monthly_spend)', 4)} AS total_annual_spend, {rnd('avg(avg_monthly_roas)', 6)} AS avg_annual_roas,
                     {rnd('avg(spend_growth_pct) FILTER (WHERE spend_growth_pct IS NOT NULL)', 6)} AS avg_monthly_growth_pct
              FROM monthly_trends) mt)"""


def _shifted_events_sql(events: str) -> str:
    """Every event kept; users with user_id % 10 = 0 squeezed into the last 11 days, then shifted."""
    return ("SELECT event_id, CASE WHEN user_id % 10 = 0 THEN TIMESTAMP '2024-01-20' + "
            "to_microseconds(((epoch_us(ts) - 1704067200000000) * 11) // 30) ELSE ts END "
            f"- to_days(CAST(user_id % 45 AS INTEGER)) AS ts, user_id, event_type, value, props FROM {events}")


def profiles_sql(name: str, events: str, as_of: str) -> str:
    """U6 over ``events`` as of ``as_of``."""
    return f"""
{name}_sev AS ({_shifted_events_sql(events)}),""" + \
        sessions_sql(f"{name}_ss", f"{name}_sev") + f""",
{name}_s AS (SELECT user_id, count(*) AS total_sessions, sum(duration_minutes) AS minutes FROM {name}_ss GROUP BY 1),
{name}_u AS (SELECT user_id, CAST(min(ts) AS DATE) AS signup_date, CAST(max(ts) AS DATE) AS last_login_date,
                    count(CASE WHEN event_type = 'view' THEN 1 END) AS total_page_views,
                    count(CASE WHEN event_type = 'click' THEN 1 END) AS total_feature_interactions
             FROM {name}_sev GROUP BY 1),
{name} AS (
  SELECT u.user_id, u.user_id AS customer_id, ['Consumer', 'SMB', 'Enterprise'][((u.user_id % 3) + 3) % 3 + 1] AS user_segment,
    ['Premium', 'Pro', 'Free', 'Trial'][((u.user_id % 4) + 4) % 4 + 1] AS subscription_tier,
    CASE WHEN DATE '{as_of}' - last_login_date > 30 THEN 'Churned' WHEN DATE '{as_of}' - last_login_date > 14 THEN 'At Risk'
         WHEN DATE '{as_of}' - signup_date <= 20 THEN 'New' ELSE 'Active' END AS user_lifecycle_stage,
    {rnd('least(100.0, 10 * ln(1 + coalesce(total_sessions, 0)) + 5 * ln(1 + total_page_views) + 5 * ln(1 + total_feature_interactions))', 2)}
      AS engagement_score,
    CAST(coalesce(total_sessions, 0) AS BIGINT) AS total_sessions,
    {rnd('coalesce(minutes, 0.0)', 4)} AS total_session_duration_minutes,
    total_page_views, total_feature_interactions, last_login_date,
    CAST(DATE '{as_of}' - last_login_date AS INTEGER) AS days_since_last_login, signup_date
  FROM {name}_u u LEFT JOIN {name}_s s ON u.user_id = s.user_id)"""


PROFILES = profiles_sql("user_profiles", "events", AS_OF)

METRICS = f"""
um_sev AS (""" + _shifted_events_sql("events") + """),""" + sessions_sql("um_ss", "um_sev") + f""",
um_s AS (SELECT user_id, count(*) AS recent_sessions, {rnd('sum(duration_minutes)', 4)} AS recent_session_minutes,
                max(session_start) AS last_session_timestamp
         FROM um_ss WHERE session_start >= TIMESTAMP '2024-01-02' AND session_start < TIMESTAMP '2024-02-01'
         GROUP BY 1),
um_f AS (SELECT user_id, count(DISTINCT TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS features_used
         FROM um_sev WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-02-01'
         GROUP BY 1),
user_engagement_metrics AS (
  SELECT user_id, coalesce(recent_sessions, 0) AS recent_sessions,
    coalesce(recent_session_minutes, 0.0) AS recent_session_minutes, coalesce(features_used, 0) AS features_used,
    last_session_timestamp
  FROM um_s FULL JOIN um_f USING (user_id))"""

FEATURES = f"""
fe_g AS (SELECT TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS total_interactions,
                count(DISTINCT user_id) AS unique_users
         FROM events WHERE TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) IS NOT NULL GROUP BY 1),
feature_summary AS (
  SELECT 'k' || CAST(k AS VARCHAR) AS feature_name, 'category_' || CAST(k % 5 AS VARCHAR) AS feature_category,
    total_interactions, unique_users, {rnd(_div('total_interactions', 'unique_users'), 6)} AS interactions_per_user
  FROM fe_g)"""

USER_SUMMARY = f"""
user_summary AS (
  SELECT up.user_id, customer_id, user_segment, subscription_tier, user_lifecycle_stage,
    engagement_score AS profile_engagement_score, total_sessions AS lifetime_sessions,
    total_session_duration_minutes AS lifetime_session_minutes, total_page_views AS lifetime_page_views,
    total_feature_interactions AS lifetime_feature_interactions, last_login_date, days_since_last_login, signup_date,
    coalesce(recent_sessions, 0) AS recent_sessions_30d, coalesce(recent_session_minutes, 0.0) AS recent_session_minutes_30d,
    coalesce(features_used, 0) AS features_used_30d, last_session_timestamp,
    {rnd(_ratio('total_sessions > 0', 'total_session_duration_minutes', 'total_sessions'), 6)} AS avg_session_duration_lifetime,
    {rnd(_ratio('total_sessions > 0', 'total_page_views', 'total_sessions'), 6)} AS avg_page_views_per_session,
    {rnd(_ratio('total_sessions > 0', 'total_feature_interactions', 'total_sessions'), 6)} AS avg_interactions_per_session,
    {rnd(f"CASE WHEN coalesce(recent_sessions, 0) > 0 AND total_sessions > 0 THEN coalesce(recent_sessions, 0) * 30.0 / total_sessions * (DATE '{AS_OF}' - signup_date) ELSE 0.0 END", 6)}
      AS engagement_trend_score,
    CASE WHEN engagement_score >= {P.high_engagement_score} THEN 'High Value'
         WHEN engagement_score >= {P.medium_engagement_score} THEN 'Medium Value'
         WHEN engagement_score >= 20 THEN 'Low Value' ELSE 'At Risk' END AS user_value_tier,
    CASE WHEN user_lifecycle_stage = 'Active' AND engagement_score >= {P.high_engagement_score} THEN 'Champion'
         WHEN user_lifecycle_stage = 'Active' AND engagement_score >= {P.medium_engagement_score} THEN 'Loyal'
         WHEN user_lifecycle_stage = 'New' AND engagement_score >= {P.medium_engagement_score} THEN 'Potential'
         WHEN user_lifecycle_stage = 'At Risk' THEN 'At Risk' WHEN user_lifecycle_stage = 'Churned' THEN 'Lost'
         ELSE 'Casual' END AS user_persona,
    CAST(CASE subscription_tier WHEN 'Premium' THEN 100 WHEN 'Pro' THEN 50 WHEN 'Free' THEN 10 ELSE 0 END AS BIGINT)
      AS subscription_value_score
  FROM user_profiles up LEFT JOIN user_engagement_metrics uem ON up.user_id = uem.user_id)"""

PLATFORM = f"""
platform_percentiles AS (
  SELECT count(*) AS total_users, count(CASE WHEN user_lifecycle_stage = 'Active' THEN 1 END) AS active_users,
    count(CASE WHEN user_lifecycle_stage = 'At Risk' THEN 1 END) AS at_risk_users,
    count(CASE WHEN user_lifecycle_stage = 'Churned' THEN 1 END) AS churned_users,
    count(CASE WHEN user_value_tier = 'High Value' THEN 1 END) AS high_value_users,
    {rnd('avg(profile_engagement_score)', 6)} AS avg_engagement_score,
    {rnd('avg(lifetime_sessions)', 6)} AS avg_lifetime_sessions,
    {rnd('avg(avg_session_duration_lifetime)', 6)} AS avg_session_duration,
    {rnd('quantile_cont(profile_engagement_score, 0.25)', 6)} AS engagement_score_p25,
    {rnd('quantile_cont(profile_engagement_score, 0.5)', 6)} AS engagement_score_p50,
    {rnd('quantile_cont(profile_engagement_score, 0.75)', 6)} AS engagement_score_p75,
    {rnd('quantile_cont(profile_engagement_score, 0.9)', 6)} AS engagement_score_p90
  FROM user_summary)"""

TOP_FEATURES = """
tf_ranked AS (SELECT feature_name,
                row_number() OVER (ORDER BY total_interactions DESC NULLS FIRST, feature_name) AS popularity_rank,
                row_number() OVER (ORDER BY interactions_per_user DESC NULLS FIRST, feature_name) AS engagement_rank
              FROM feature_summary),
top_features AS (
  SELECT string_agg(feature_name, ', ' ORDER BY popularity_rank) AS top_features_by_volume,
    string_agg(CASE WHEN engagement_rank <= 5 THEN feature_name END, ', ' ORDER BY engagement_rank)
      AS top_features_by_engagement
  FROM tf_ranked WHERE popularity_rank <= 10)"""

DIM_USER = """
dim_user AS (
  SELECT us.user_id, customer_id, user_segment, subscription_tier, user_lifecycle_stage, user_persona, user_value_tier,
    profile_engagement_score, lifetime_sessions, lifetime_session_minutes, recent_sessions_30d,
    recent_session_minutes_30d, features_used_30d, avg_session_duration_lifetime, avg_page_views_per_session,
    avg_interactions_per_session, engagement_trend_score, subscription_value_score, last_login_date,
    days_since_last_login, signup_date,
    CASE WHEN profile_engagement_score >= engagement_score_p90 THEN 'Top 10%'
         WHEN profile_engagement_score >= engagement_score_p75 THEN 'Top 25%'
         WHEN profile_engagement_score >= engagement_score_p50 THEN 'Top 50%' ELSE 'Bottom 50%' END
      AS engagement_percentile,
    CASE WHEN days_since_last_login > 30 THEN 'High Risk' WHEN days_since_last_login > 14 THEN 'Medium Risk'
         WHEN days_since_last_login > 7 THEN 'Low Risk' ELSE 'Active' END AS churn_risk_level,
    CASE WHEN features_used_30d >= 10 THEN 'Power User' WHEN features_used_30d >= 5 THEN 'Regular User'
         WHEN features_used_30d >= 2 THEN 'Light User' ELSE 'Minimal User' END AS feature_adoption_level,
    total_users AS total_platform_users, avg_engagement_score AS platform_avg_engagement,
    top_features_by_volume, top_features_by_engagement
  FROM user_summary us CROSS JOIN platform_percentiles CROSS JOIN top_features)"""

SNAPSHOT = profiles_sql("sp_early", "(SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-21')", "2024-01-20") + "," \
    + profiles_sql("sp_now", "events", AS_OF) + """,
sp_old AS (SELECT user_id, user_lifecycle_stage, total_sessions, CAST(last_login_date AS TIMESTAMP) AS updated_timestamp,
                  CAST(last_login_date AS TIMESTAMP) AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to
           FROM sp_early),
sp_cur AS (SELECT user_id, user_lifecycle_stage, total_sessions, CAST(last_login_date AS TIMESTAMP) AS updated_timestamp
           FROM sp_now),
profile_snapshot AS (
  SELECT o.user_id, o.user_lifecycle_stage, o.total_sessions, o.updated_timestamp, o.dbt_valid_from,
         CASE WHEN c.updated_timestamp IS NOT NULL AND c.updated_timestamp > o.updated_timestamp
              THEN c.updated_timestamp ELSE o.dbt_valid_to END AS dbt_valid_to
  FROM sp_old o LEFT JOIN sp_cur c ON o.user_id = c.user_id
  UNION ALL
  SELECT c.user_id, c.user_lifecycle_stage, c.total_sessions, c.updated_timestamp, c.updated_timestamp,
         CAST(NULL AS TIMESTAMP)
  FROM sp_cur c LEFT JOIN sp_old o ON c.user_id = o.user_id
  WHERE o.user_id IS NULL OR c.updated_timestamp > o.updated_timestamp)"""

CUSTOMER_TIERS = f"""
customer_value_tiers AS (
  SELECT o_custkey AS customer_id, count(*) AS orders, {rnd('sum(o_totalprice)', 4)} AS lifetime_value,
    CASE WHEN sum(o_totalprice) >= {P.high_value_customer_threshold} THEN 'High Value'
         WHEN sum(o_totalprice) >= {P.medium_value_customer_threshold} THEN 'Medium Value'
         WHEN sum(o_totalprice) >= {P.low_value_customer_threshold} THEN 'Low Value' ELSE 'Minimal Value' END
      AS customer_value_tier
  FROM orders GROUP BY o_custkey)"""

# CTE dependencies: each name lists the CTE blocks it needs, in order.
_BLOCKS = {
    "daily_sales": [DAILY_SALES],
    "daily_marketing": [DAILY_MARKETING],
    "daily_engagement": [DAILY_ENGAGEMENT],
    "stg_sales": [DAILY_SALES, STG_SALES],
    "stg_marketing": [DAILY_MARKETING, STG_MARKETING],
    "stg_engagement": [DAILY_ENGAGEMENT, STG_ENGAGEMENT],

    "unified_daily": [DAILY_SALES, STG_SALES, DAILY_MARKETING, STG_MARKETING, DAILY_ENGAGEMENT, STG_ENGAGEMENT,
                      SPINE, UNIFIED],
    "campaigns": [CAMPAIGNS],
    "campaign_summary": [CAMPAIGNS, CAMPAIGN_SUMMARY],
    "attribution": [ATTRIBUTION],
    "attribution_models": [_touch_model("first_touch", "is_first"), _touch_model("last_touch", "is_last"), ATTRIBUTION_MODELS],
    "channel_summary": [ATTRIBUTION, CHANNEL_SUMMARY],
    "monthly_trends": [DAILY_MARKETING, STG_MARKETING, MONTHLY],
    "user_profiles": [PROFILES],
    "user_engagement_metrics": [METRICS],
    "feature_summary": [FEATURES],
    "user_summary": [PROFILES, METRICS, USER_SUMMARY],
    "top_features": [FEATURES, TOP_FEATURES],
    "profile_snapshot": [SNAPSHOT],
    "customer_value_tiers": [CUSTOMER_TIERS],
}
_BLOCKS["business_kpis"] = _BLOCKS["unified_daily"] + [KPIS]
_BLOCKS["dim_marketing"] = [CAMPAIGNS, CAMPAIGN_SUMMARY, ATTRIBUTION, CHANNEL_SUMMARY, DAILY_MARKETING,
                            STG_MARKETING, MONTHLY, DIM_MARKETING]
_BLOCKS["platform_percentiles"] = _BLOCKS["user_summary"] + [PLATFORM]
_BLOCKS["dim_user"] = _BLOCKS["user_summary"] + [PLATFORM, FEATURES, TOP_FEATURES, DIM_USER]


def _stmt(name: str, body: str | None = None) -> str:
    ctes = ",".join(b.strip("\n") for b in _BLOCKS[name])
    return f"WITH {ctes.strip()}\n{body or f'SELECT * FROM {name}'}"


SQL = {name: _stmt(name) for name in _BLOCKS}
SQL["sessions"] = ("WITH " + sessions_sql("sessions", "events").strip() +
                   "\nSELECT user_id, session_start, session_end, n_events, page_views, clicks, converted, "
                   "session_value, duration_minutes FROM sessions")
SQL["campaign_percentiles"] = _stmt("campaigns", f"""
SELECT campaign_id,
  {rnd('percent_rank() OVER (ORDER BY roas ASC NULLS LAST)', 6)} AS roas_percentile,
  {rnd('percent_rank() OVER (ORDER BY efficiency_score ASC NULLS LAST)', 6)} AS efficiency_percentile
FROM campaigns""")

SQL["date_spine"] = ("WITH " + ",".join(b.strip("\n") for b in (
    DAILY_SALES, STG_SALES, DAILY_MARKETING, STG_MARKETING, DAILY_ENGAGEMENT, STG_ENGAGEMENT, SPINE)) + """
SELECT ds.date_day, s.date_key IS NOT NULL AS has_sales, m.date_key IS NOT NULL AS has_marketing,
  e.date_key IS NOT NULL AS has_engagement
FROM date_spine ds LEFT JOIN stg_sales s ON ds.date_day = s.date_key
LEFT JOIN stg_marketing m ON ds.date_day = m.date_key LEFT JOIN stg_engagement e ON ds.date_day = e.date_key""")

SQL["part_revenue_ranks"] = """
WITH revenue AS (
  SELECT l_partkey AS part_key, sum(CAST(round(l_extendedprice * (1 - l_discount) * 100) AS BIGINT)) AS revenue_cents
  FROM lineitem GROUP BY 1)
SELECT part_key, revenue_cents,
  CAST(row_number() OVER (ORDER BY revenue_cents DESC, part_key) AS INTEGER) AS revenue_rank,
  round(percent_rank() OVER (ORDER BY revenue_cents), 6) AS revenue_percentile
FROM revenue"""

SQL["daily_sales_rebuilt"] = "WITH changed_lines AS (" + """
SELECT * REPLACE (CASE WHEN CAST(o_orderdate AS DATE) = (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)
                       THEN 2 * l_quantity ELSE l_quantity END AS l_quantity)
FROM lineitem JOIN (SELECT o_orderkey AS l_orderkey, o_orderdate FROM orders) USING (l_orderkey)),""" \
    + re.sub(r"\blineitem\b", "changed_lines", DAILY_SALES) + "\nSELECT * FROM daily_sales"

SQL["feature_ranks"] = _stmt("feature_summary", """
SELECT feature_name, total_interactions, interactions_per_user,
  CAST(row_number() OVER (ORDER BY total_interactions DESC NULLS FIRST, feature_name) AS INT) AS popularity_rank,
  CAST(row_number() OVER (ORDER BY interactions_per_user DESC NULLS FIRST, feature_name) AS INT) AS engagement_rank
FROM feature_summary""")
