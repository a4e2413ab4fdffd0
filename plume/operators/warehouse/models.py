"""Warehouse models W1-W10 as functions of DataFrames and ``Params``.

Staging and intermediate models are lazy frames (views); marts are what a
caller writes.  Each model builds its columns in one ``select`` from the
input columns, so flags read the raw value even where an output alias has
the same name (trap T11).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ...functions import bins
from ...functions.columns import ntz_lit, percent_rank_distributed, rnd, row_number_distributed
from ...sources.store import shared


def _date_filter(df: DataFrame, params) -> DataFrame:
    return df.where(F.col("date_key").isNotNull()
                    & F.col("date_key").between(F.lit(params.start_date), F.lit(params.end_date)))


def _z(c: str, default=0) -> Column:
    return F.coalesce(F.col(c), F.lit(default))


def _ratio(cond: Column, num: Column, den: Column, default=0.0) -> Column:
    """CASE WHEN cond THEN num / den ELSE default END, as double."""
    return F.when(cond, num.cast("double") / den.cast("double")).otherwise(
        F.lit(default) if default is not None else F.lit(None).cast("double"))


# ---- W1-W3 staging -----------------------------------------------------------

def stg_sales(src: DataFrame, params) -> DataFrame:
    """W1."""
    r, o, d = F.col("total_revenue"), F.col("total_orders"), F.col("delivered_orders")
    return _date_filter(src, params).select(
        "date_key", _z("total_orders").alias("total_orders"), _z("total_revenue", 0.0).alias("total_revenue"),
        _z("total_items_sold", 0.0).alias("total_items_sold"), _z("unique_customers").alias("unique_customers"),
        _z("avg_order_value", 0.0).alias("avg_order_value"), _z("avg_items_per_order", 0.0).alias("avg_items_per_order"),
        _z("top_product_category", "Unknown").alias("top_product_category"),
        _z("top_state", "Unknown").alias("top_state"), _z("delivered_orders").alias("delivered_orders"),
        _z("delivery_performance_score", 0.0).alias("delivery_performance_score"),
        F.coalesce(r > 0, F.lit(False)).alias("has_revenue_data"),
        F.coalesce(F.col("unique_customers") > 0, F.lit(False)).alias("has_customer_data"),
        rnd(_ratio(o > 0, r, o), 6).alias("calculated_aov"),
        rnd(_ratio((d > 0) & (o > 0), d * 100.0, o), 6).alias("delivery_rate_pct"))


def stg_marketing(src: DataFrame, params) -> DataFrame:
    """W2 (CPA is NULL when undefined)."""
    s, i, c, v = (F.col(x) for x in ("total_spend", "total_impressions", "total_clicks", "total_conversions"))
    return _date_filter(src, params).select(
        "date_key", _z("total_spend", 0.0).alias("total_spend"), _z("total_impressions", 0.0).alias("total_impressions"),
        _z("total_clicks", 0.0).alias("total_clicks"), _z("total_conversions").alias("total_conversions"),
        _z("unique_campaigns").alias("unique_campaigns"), _z("active_channels").alias("active_channels"),
        _z("avg_ctr", 0.0).alias("avg_ctr"), _z("avg_conversion_rate", 0.0).alias("avg_conversion_rate"),
        _z("avg_cpc", 0.0).alias("avg_cpc"), _z("avg_cpa", 0.0).alias("avg_cpa"),
        _z("top_performing_channel", "Unknown").alias("top_performing_channel"),
        _z("top_performing_campaign", "Unknown").alias("top_performing_campaign"),
        _z("channel_performance_score", 0.0).alias("channel_performance_score"),
        _z("roas", 0.0).alias("roas"),
        F.coalesce(s > 0, F.lit(False)).alias("has_spend_data"),
        F.coalesce(i > 0, F.lit(False)).alias("has_impression_data"),
        F.coalesce(v > 0, F.lit(False)).alias("has_conversion_data"),
        bins.roas_tier("roas", params).alias("roas_tier"),
        rnd(_ratio(i > 0, c * 100.0, i), 6).alias("calculated_ctr"),
        rnd(_ratio(c > 0, v * 100.0, c), 6).alias("calculated_conversion_rate"),
        rnd(_ratio((s > 0) & (v > 0), s, v, None), 6).alias("calculated_cpa"))


def stg_engagement(src: DataFrame, params) -> DataFrame:
    """W3 with quality tier (W3a) and 0-100 score."""
    u, n, pv, cv, val = (F.col(x) for x in ("active_users", "total_sessions", "total_page_views",
                                            "conversion_sessions", "total_session_value"))
    return _date_filter(src, params).select(
        "date_key", _z("active_users").alias("active_users"), _z("total_sessions").alias("total_sessions"),
        _z("total_session_minutes", 0.0).alias("total_session_minutes"),
        _z("avg_session_duration", 0.0).alias("avg_session_duration"),
        _z("total_page_views").alias("total_page_views"),
        _z("avg_page_views_per_session", 0.0).alias("avg_page_views_per_session"),
        _z("bounce_sessions").alias("bounce_sessions"), _z("conversion_sessions").alias("conversion_sessions"),
        _z("total_session_value", 0.0).alias("total_session_value"),
        _z("bounce_rate", 0.0).alias("bounce_rate"), _z("conversion_rate", 0.0).alias("conversion_rate"),
        F.coalesce(u > 0, F.lit(False)).alias("has_user_data"),
        F.coalesce(n > 0, F.lit(False)).alias("has_session_data"),
        F.coalesce(val > 0, F.lit(False)).alias("has_value_data"),
        rnd(_ratio(n > 0, u, n), 6).alias("users_per_session_ratio"),
        rnd(_ratio(u > 0, pv, u), 6).alias("page_views_per_user"),
        rnd(_ratio(cv > 0, val, cv), 6).alias("avg_conversion_value"),
        bins.engagement_quality("avg_session_duration", "bounce_rate", "conversion_rate").alias("engagement_quality"),
        rnd(bins.engagement_score("avg_session_duration", "bounce_rate", "conversion_rate",
                                  "avg_page_views_per_session", "active_users"), 6).alias("engagement_score"))


# ---- W4-W5 intermediate ------------------------------------------------------

def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day in [start, end) -- the end is exclusive (trap T10).

    The spine is generated by ``sequence``; its size is the number of days
    in the range, which also bounds the broadcast joins that use it.
    """
    if end <= start:
        return spark.range(0).select(F.lit(None).cast("date").alias("date_day")).limit(0)
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(start), F.date_sub(F.lit(end), 1), F.expr("INTERVAL 1 DAY"))).alias("date_day"))


def unified_daily(spine: DataFrame, sales: DataFrame, mkt: DataFrame, eng: DataFrame) -> DataFrame:
    """Spine left-joined to the three staged sources.

    Each staged source has at most one row per day of the range, so every
    side of these joins is bounded by the spine length: broadcast joins.
    """
    s = sales.select(*[F.col(c).alias(f"s_{c}") for c in sales.columns])
    m = mkt.select(*[F.col(c).alias(f"m_{c}") for c in mkt.columns])
    e = eng.select(*[F.col(c).alias(f"e_{c}") for c in eng.columns])
    j = (spine.join(F.broadcast(s), spine.date_day == s.s_date_key, "left")
              .join(F.broadcast(m), spine.date_day == m.m_date_key, "left")
              .join(F.broadcast(e), spine.date_day == e.e_date_key, "left"))
    sa, ma, ea = (F.col(f"{p}_date_key").isNotNull() for p in "sme")
    return j.select(
        F.col("date_day").alias("date_key"),
        _z("s_total_orders").alias("total_orders"), _z("s_total_revenue", 0.0).alias("total_revenue"),
        _z("s_total_items_sold", 0.0).alias("total_items_sold"), _z("s_unique_customers").alias("unique_customers"),
        _z("s_avg_order_value", 0.0).alias("avg_order_value"), _z("s_delivery_rate_pct", 0.0).alias("delivery_rate_pct"),
        F.col("s_has_revenue_data").alias("has_revenue_data"),
        _z("m_total_spend", 0.0).alias("total_marketing_spend"), _z("m_total_impressions", 0.0).alias("total_impressions"),
        _z("m_total_clicks", 0.0).alias("total_clicks"), _z("m_total_conversions").alias("total_conversions"),
        _z("m_roas", 0.0).alias("marketing_roas"), _z("m_calculated_ctr", 0.0).alias("marketing_ctr"),
        _z("m_calculated_conversion_rate", 0.0).alias("marketing_conversion_rate"),
        F.col("m_roas_tier").alias("roas_tier"), F.col("m_has_spend_data").alias("has_spend_data"),
        _z("e_active_users").alias("active_users"), _z("e_total_sessions").alias("total_sessions"),
        _z("e_avg_session_duration", 0.0).alias("avg_session_duration"),
        _z("e_total_page_views").alias("total_page_views"), _z("e_bounce_rate", 0.0).alias("bounce_rate"),
        _z("e_conversion_rate", 0.0).alias("engagement_conversion_rate"),
        _z("e_engagement_score", 0.0).alias("engagement_score"),
        F.col("e_engagement_quality").alias("engagement_quality"), F.col("e_has_user_data").alias("has_user_data"),
        sa.alias("sales_data_available"), ma.alias("marketing_data_available"),
        ea.alias("engagement_data_available"),
        rnd(F.when(sa, 33.33).otherwise(0.0) + F.when(ma, 33.33).otherwise(0.0)
            + F.when(ea, 33.34).otherwise(0.0), 2).alias("data_completeness_score"))


# ---- W6 ----------------------------------------------------------------------

def business_kpis(daily: DataFrame, params, created_at: dt.datetime | None = None) -> DataFrame:
    """The KPI fact table (clock columns only when a time is passed)."""
    rev, spend, cust, users, sess, orders = (F.col(c) for c in (
        "total_revenue", "total_marketing_spend", "unique_customers", "active_users", "total_sessions",
        "total_orders"))
    roas, eng = F.col("marketing_roas"), F.col("engagement_score")
    keep = ["date_key", "total_orders", "total_revenue", "total_items_sold", "unique_customers",
            "avg_order_value", "delivery_rate_pct", "total_marketing_spend", "total_impressions",
            "total_clicks", "total_conversions", "marketing_roas", "marketing_ctr",
            "marketing_conversion_rate", "roas_tier", "active_users", "total_sessions",
            "avg_session_duration", "total_page_views", "bounce_rate", "engagement_conversion_rate",
            "engagement_score", "engagement_quality"]
    out = daily.select(
        *keep,
        rnd(_ratio((cust > 0) & (spend > 0), spend, cust), 6).alias("customer_acquisition_cost"),
        rnd(_ratio((users > 0) & (rev > 0), rev, users), 6).alias("revenue_per_user"),
        rnd(_ratio((spend > 0) & (rev > 0), (rev - spend) * 100.0, spend), 6).alias("marketing_roi_percentage"),
        rnd(_ratio((spend > 0) & (rev > 0), rev, spend), 6).alias("marketing_efficiency_ratio"),
        rnd(_ratio((sess > 0) & (rev > 0), rev, sess), 6).alias("revenue_per_session"),
        rnd(bins.business_score(rev, roas, eng, "delivery_rate_pct"), 6).alias("overall_business_score"),
        rnd(F.col("avg_order_value") * 3.5, 6).alias("estimated_customer_lifetime_value"),
        rnd(_ratio((cust > 0) & (orders > 0), orders, cust), 6).alias("orders_per_customer"),
        "sales_data_available", "marketing_data_available", "engagement_data_available",
        "data_completeness_score",
        (roas >= params.excellent_roas_threshold).alias("is_high_roas_day"),
        (eng >= params.high_engagement_score).alias("is_high_engagement_day"),
        F.coalesce((rev > 0) & (spend > 0) & (_ratio(spend > 0, rev, spend) > 2), F.lit(False)).alias("is_profitable_day"))
    if created_at is not None:
        out = out.withColumn("created_at", ntz_lit(created_at)).withColumn("updated_at", ntz_lit(created_at))
    return out


# ---- W7 ----------------------------------------------------------------------

def campaign_summary(campaigns: DataFrame, params) -> DataFrame:
    """Ranks (explicit NULL order + id tie-break), health, ROI.

    Each rank is a row number over a total order, computed by a distributed
    prefix count rather than a global window, so the campaign table is never
    gathered into one task.
    """
    spend, rev = F.col("total_spend"), F.col("attributed_revenue")
    df = campaigns.select(
        "*", bins.campaign_health("roas", "efficiency_score", params).alias("campaign_health_status"),
        rnd(_ratio((spend > 0) & (rev > 0), (rev - spend) * 100.0, spend), 6).alias("roi_percentage"))
    for col_name, out in (("roas", "roas_rank"), ("attributed_revenue", "revenue_rank"),
                          ("efficiency_score", "efficiency_rank")):
        df = row_number_distributed(df, [F.col(col_name).desc_nulls_first(), F.col("campaign_id")], out,
                                    "campaign_id", [col_name])
    return df


def campaign_percentiles(campaigns: DataFrame) -> DataFrame:
    """Percent ranks of ROAS and efficiency, ascending with NULLs last
    (where Snowflake's ascending order puts them); ties share a rank."""
    df = campaigns.select("campaign_id", "roas", "efficiency_score")
    df = percent_rank_distributed(df, "roas", "_p1")
    df = percent_rank_distributed(df, "efficiency_score", "_p2")
    return df.select("campaign_id", rnd("_p1", 6).alias("roas_percentile"), rnd("_p2", 6).alias("efficiency_percentile"))


def channel_summary(channels: DataFrame) -> DataFrame:
    """Channel ranks (distributed row numbers), revenue per conversion, tier."""
    conv, rev = F.col("total_attributed_conversions"), F.col("total_attributed_revenue")
    df = channels.select(
        "*", rnd(_ratio(conv > 0, rev, conv), 6).alias("revenue_per_conversion"),
        bins.channel_importance("channel_contribution_score").alias("channel_importance_tier"))
    for col_name, out in (("total_attributed_revenue", "channel_revenue_rank"),
                          ("channel_contribution_score", "channel_contribution_rank")):
        df = row_number_distributed(df, [F.col(col_name).desc_nulls_first(), F.col("channel")], out, "channel", [col_name])
    return df


def monthly_trends(stg_mkt: DataFrame) -> DataFrame:
    """Monthly spend, ROAS, conversions and LAG growth (0 for the first month)."""
    g = stg_mkt.groupBy(F.month("date_key").alias("month_num"), F.quarter("date_key").alias("quarter_num"),
                        F.year("date_key").alias("year_num")).agg(
        F.sum("total_spend").alias("spend"), F.avg("roas").alias("roas"),
        F.sum("total_conversions").alias("monthly_conversions"))
    w = Window.orderBy("year_num", "month_num")
    prev = F.lag("spend").over(w)
    return g.select("month_num", "quarter_num", "year_num", rnd("spend", 4).alias("monthly_spend"),
                    rnd("roas", 6).alias("avg_monthly_roas"), "monthly_conversions",
                    rnd(prev, 4).alias("prev_month_spend"),
                    rnd(F.when(prev > 0, (F.col("spend") - prev) / prev * 100.0).otherwise(0.0), 6)
                    .alias("spend_growth_pct"))


def dim_marketing(campaigns: DataFrame, channels: DataFrame, stg_mkt: DataFrame, params,
                  created_at: dt.datetime | None = None) -> DataFrame:
    """Campaign rows with the top channel and annual totals attached.

    The six scalar subqueries become two one-row aggregates (``max_by`` for
    the top channel) attached by broadcast cross joins of exactly one row.
    """
    cs = campaign_summary(campaigns, params)
    ch = channel_summary(channels)
    top = ch.agg(F.min_by(F.struct("channel", "channel_contribution_score", "channel_importance_tier"),
                          "channel_revenue_rank").alias("t")).select(
        F.col("t.channel").alias("top_channel"), F.col("t.channel_contribution_score").alias("top_channel_contribution"),
        F.col("t.channel_importance_tier").alias("top_channel_tier"))
    mt = monthly_trends(stg_mkt).agg(
        rnd(F.sum("monthly_spend"), 4).alias("total_annual_spend"),
        rnd(F.avg("avg_monthly_roas"), 6).alias("avg_annual_roas"),
        rnd(F.avg(F.when(F.col("spend_growth_pct").isNotNull(), F.col("spend_growth_pct"))), 6)
        .alias("avg_monthly_growth_pct"))
    out = cs.crossJoin(F.broadcast(top)).crossJoin(F.broadcast(mt)).select(
        "campaign_id", "campaign_name", "campaign_type", F.col("total_spend").alias("campaign_spend"),
        F.col("attributed_revenue").alias("campaign_revenue"), F.col("roas").alias("campaign_roas"),
        F.col("performance_tier").alias("campaign_tier"), "campaign_health_status", "roas_rank",
        "revenue_rank", "efficiency_rank", F.col("roi_percentage").alias("campaign_roi_pct"),
        "top_channel", "top_channel_contribution", "top_channel_tier", "total_annual_spend",
        "avg_annual_roas", "avg_monthly_growth_pct")
    if created_at is not None:
        out = out.withColumn("created_at", ntz_lit(created_at))
    return out


# ---- W8 ----------------------------------------------------------------------

def user_summary(profiles: DataFrame, metrics: DataFrame, params) -> DataFrame:
    """Profile left-joined to 30-day metrics; tiers and scores."""
    m = metrics.select("user_id", "recent_sessions", "recent_session_minutes", "features_used",
                       "last_session_timestamp")
    j = profiles.join(m, "user_id", "left")
    n = F.col("total_sessions")
    recent = F.coalesce(F.col("recent_sessions"), F.lit(0))
    tenure = F.datediff(F.lit(params.as_of), F.col("signup_date"))
    return j.select(
        "user_id", "customer_id", "user_segment", "subscription_tier", "user_lifecycle_stage",
        F.col("engagement_score").alias("profile_engagement_score"), n.alias("lifetime_sessions"),
        F.col("total_session_duration_minutes").alias("lifetime_session_minutes"),
        F.col("total_page_views").alias("lifetime_page_views"),
        F.col("total_feature_interactions").alias("lifetime_feature_interactions"),
        "last_login_date", "days_since_last_login", "signup_date",
        recent.alias("recent_sessions_30d"),
        F.coalesce(F.col("recent_session_minutes"), F.lit(0.0)).alias("recent_session_minutes_30d"),
        F.coalesce(F.col("features_used"), F.lit(0)).alias("features_used_30d"), "last_session_timestamp",
        rnd(_ratio(n > 0, F.col("total_session_duration_minutes"), n), 6).alias("avg_session_duration_lifetime"),
        rnd(_ratio(n > 0, F.col("total_page_views"), n), 6).alias("avg_page_views_per_session"),
        rnd(_ratio(n > 0, F.col("total_feature_interactions"), n), 6).alias("avg_interactions_per_session"),
        rnd(F.when((recent > 0) & (n > 0), recent * 30.0 / n * tenure).otherwise(0.0), 6)
        .alias("engagement_trend_score"),
        bins.user_value_tier("engagement_score", params).alias("user_value_tier"),
        bins.user_persona("user_lifecycle_stage", "engagement_score", params).alias("user_persona"),
        bins.subscription_value("subscription_tier").alias("subscription_value_score"))


def platform_percentiles(users: DataFrame) -> DataFrame:
    """One row of platform counts, averages and exact P25/50/75/90.

    One aggregation: ``percentile`` keeps a value -> count map (merged
    map-side), so its state is bounded by the number of distinct scores,
    and it runs in the same pass as the counts.
    """
    st = F.col("user_lifecycle_stage")
    m = users.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.count(F.when(st == "Active", 1)).alias("active_users"),
        F.count(F.when(st == "At Risk", 1)).alias("at_risk_users"),
        F.count(F.when(st == "Churned", 1)).alias("churned_users"),
        F.count(F.when(F.col("user_value_tier") == "High Value", 1)).alias("high_value_users"),
        rnd(F.avg("profile_engagement_score"), 6).alias("avg_engagement_score"),
        rnd(F.avg("lifetime_sessions"), 6).alias("avg_lifetime_sessions"),
        rnd(F.avg("avg_session_duration_lifetime"), 6).alias("avg_session_duration"),
        F.percentile("profile_engagement_score", [0.25, 0.5, 0.75, 0.9]).alias("_p"))
    names = ("engagement_score_p25", "engagement_score_p50", "engagement_score_p75", "engagement_score_p90")
    return m.select(*[c for c in m.columns if c != "_p"],
                    *[rnd(F.col("_p")[i], 6).alias(n) for i, n in enumerate(names)])


def top_features(features: DataFrame, k: int = 10, k_engagement: int = 5) -> DataFrame:
    """Ordered feature lists; the engagement top-5 is taken inside the volume top-10.

    Both rankings are distributed top-k (``orderBy().limit()``: each task
    keeps k rows, the driver merges k per task), never a global window over
    the feature table: the volume top-k, and the global engagement top-k,
    whose members inside the volume top-k keep their global engagement rank.
    """
    by_volume = features.orderBy(F.col("total_interactions").desc_nulls_first(), F.col("feature_name")).limit(k)
    by_engagement = features.orderBy(F.col("interactions_per_user").desc_nulls_first(),
                                     F.col("feature_name")).limit(k_engagement)
    vol = by_volume.select("feature_name", F.row_number().over(
        Window.orderBy(F.col("total_interactions").desc_nulls_first(), F.col("feature_name"))).alias("popularity_rank"))
    eng = by_engagement.select("feature_name", F.row_number().over(
        Window.orderBy(F.col("interactions_per_user").desc_nulls_first(), F.col("feature_name"))).alias("engagement_rank"))
    ranked = vol.join(eng, "feature_name", "left")

    def ordered(rank: str) -> Column:
        items = F.collect_list(F.when(F.col(rank).isNotNull(),
                                      F.struct(F.col(rank).alias("r"), F.col("feature_name").alias("n"))))
        joined = F.array_join(F.transform(F.array_sort(items), lambda x: x["n"]), ", ")
        return F.when(F.size(items) > 0, joined)
    return ranked.agg(ordered("popularity_rank").alias("top_features_by_volume"),
                      ordered("engagement_rank").alias("top_features_by_engagement"))


def feature_ranks(features: DataFrame) -> DataFrame:
    """Both ranks of every feature, by volume and by interactions per user; nulls first, ties by name."""
    df = features.select("feature_name", "total_interactions", "interactions_per_user")
    for column, out in (("total_interactions", "popularity_rank"), ("interactions_per_user", "engagement_rank")):
        df = row_number_distributed(df, [F.col(column).desc_nulls_first(), F.col("feature_name")], out, "feature_name", [column])
    return df


def dim_user(profiles: DataFrame, metrics: DataFrame, features: DataFrame, params,
             created_at: dt.datetime | None = None) -> DataFrame:
    """User rows with platform statistics and top features attached.

    The two attached frames are single-row aggregates: broadcast cross joins
    of one row each.
    """
    us = shared(user_summary(profiles, metrics, params))  # one join, read by three branches
    ea = platform_percentiles(us)
    tf = top_features(features)
    j = us.crossJoin(F.broadcast(ea)).crossJoin(F.broadcast(tf))
    out = j.select(
        "user_id", "customer_id", "user_segment", "subscription_tier", "user_lifecycle_stage", "user_persona",
        "user_value_tier", "profile_engagement_score", "lifetime_sessions", "lifetime_session_minutes",
        "recent_sessions_30d", "recent_session_minutes_30d", "features_used_30d",
        "avg_session_duration_lifetime", "avg_page_views_per_session", "avg_interactions_per_session",
        "engagement_trend_score", "subscription_value_score", "last_login_date", "days_since_last_login",
        "signup_date",
        bins.percentile_band("profile_engagement_score", "engagement_score_p90", "engagement_score_p75",
                             "engagement_score_p50").alias("engagement_percentile"),
        bins.churn_risk("days_since_last_login").alias("churn_risk_level"),
        bins.adoption_level("features_used_30d").alias("feature_adoption_level"),
        F.col("total_users").alias("total_platform_users"),
        F.col("avg_engagement_score").alias("platform_avg_engagement"),
        "top_features_by_volume", "top_features_by_engagement")
    if created_at is not None:
        out = out.withColumn("created_at", ntz_lit(created_at))
    return out


# ---- W9, W10 -----------------------------------------------------------------

def snapshot_scd2(current: DataFrame, snapshot: DataFrame | None, key: str, updated_at: str,
                  run_ts: Column | None = None) -> DataFrame:
    """Type-2 snapshot with the timestamp strategy.

    ``snapshot`` has the current columns plus dbt_valid_from / dbt_valid_to
    (NULL = open).  A key whose ``updated_at`` moved closes its open version
    at the new time and opens a new one; new keys open a version; history
    rows pass through.  Returns the full new snapshot (Parquet tables have no
    MERGE, so callers overwrite the snapshot or its changed partitions).
    """
    cols = current.columns
    fresh = current.select(*cols, F.col(updated_at).alias("dbt_valid_from"),
                           F.lit(None).cast(current.schema[updated_at].dataType).alias("dbt_valid_to"))
    if snapshot is None:
        return fresh
    is_open = F.col("dbt_valid_to").isNull()
    history = snapshot.where(~is_open)
    open_v = snapshot.where(is_open)
    cur = current.select(F.col(key).alias("_k"), F.col(updated_at).alias("_u"))
    o = open_v.join(cur, open_v[key] == cur["_k"], "left")
    changed = F.coalesce(F.col("_u") > F.col(updated_at), F.lit(False))  # a null time moves nothing
    still_open = o.where(~changed).select(*snapshot.columns)
    closed = o.where(changed).withColumn("dbt_valid_to", F.col("_u")).select(*snapshot.columns)
    open_keys = open_v.select(F.col(key).alias("_k"), F.col(updated_at).alias("_old"))
    n = fresh.join(open_keys, fresh[key] == open_keys["_k"], "left")
    new_versions = n.where(F.col("_k").isNull() | (F.col(updated_at) > F.col("_old"))).select(*fresh.columns)
    return history.unionByName(still_open).unionByName(closed).unionByName(new_versions)


def customer_value_tiers(orders: DataFrame, params) -> DataFrame:
    """Lifetime order value per customer and its tier (1000 / 500 / 100)."""
    g = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"),
                                        F.sum("o_totalprice").alias("total"))
    return g.select(F.col("o_custkey").alias("customer_id"), "orders", rnd("total", 4).alias("lifetime_value"),
                    bins.customer_value_tier("total", params).alias("customer_value_tier"))
