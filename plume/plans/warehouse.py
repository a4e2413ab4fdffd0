"""Pipeline W as registered queries: driver tables -> upstream sources ->
staging -> unified daily -> marts.  Staging and intermediate frames stay
lazy; every query is one plan from the Parquet scans.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import percent_rank_distributed, row_number_distributed
from ..operators.warehouse import models as M
from ..operators.warehouse import upstream as U
from ..operators.warehouse.incremental import refresh_days
from ..params import FIXTURE
from ..sources.store import materialized, shared, table_root
from ..sources.tables import Tables

P = FIXTURE


def _t(spark, d) -> Tables:
    return Tables(spark, d)


def _paths(d: str, *names: str) -> list[str]:
    return [f"{d.rstrip('/')}/{n}.parquet" for n in names]


def order_lines(spark: SparkSession, d: str) -> DataFrame:
    """The one join of line items, orders and customers, written once for both daily sources."""
    t = _t(spark, d)
    return materialized(spark, "order_lines", _paths(d, "orders", "lineitem", "customer"),
                        lambda: U.order_lines(t.lineitem, t.orders, t.customer))


def daily_sales(spark: SparkSession, d: str) -> DataFrame:
    """``ext_redshift_daily_sales``: exported once as Parquet, then read."""
    t = _t(spark, d)
    return materialized(spark, "ext_daily_sales", _paths(d, "orders", "lineitem", "customer", "nation", "part"),
                        lambda: U.daily_sales(t.orders, t.lineitem, t.customer, t.nation, t.part,
                                              lines=order_lines(spark, d)))


def refresh_daily_sales(orders: DataFrame, lines: DataFrame, customer: DataFrame, nation: DataFrame, part: DataFrame,
                        target: str, months: bool = False) -> DataFrame:
    """U1 as a partitioned table, of which only the days with changed orders or lines are built.

    ``months``: a partition (and what is built anew) is a month; one row a day
    makes tiny files when a table has thousands of days.
    """
    slot = lambda c: F.trunc(F.to_date(c), "month") if months else F.to_date(c)
    inputs = {"orders": (orders.withColumn("slot", slot("o_orderdate")), "slot"), "lines": (lines.withColumn("slot", slot("order_day")), "slot")}

    def build(i: dict[str, DataFrame]) -> DataFrame:
        days = U.daily_sales(i["orders"], None, customer, nation, part, lines=i["lines"])
        return days.withColumn("month", slot("date_key")) if months else days

    return refresh_days(inputs, build, target, "month" if months else "date_key", whole={"nation": nation, "part": part})


def daily_sales_rebuilt(spark: SparkSession, d: str) -> DataFrame:
    """A full build, a change (the newest day's quantities are doubled) and a rebuild of that day's month alone."""
    t, lines = _t(spark, d), order_lines(spark, d)
    target = f"{table_root(spark)}/daily_sales_rebuilt/{uuid.uuid4().hex}"
    refresh_daily_sales(t.orders, lines, t.customer, t.nation, t.part, target, months=True)
    newest = t.orders.agg(F.to_date(F.max("o_orderdate")).alias("newest"))
    changed = lines.crossJoin(F.broadcast(newest)).withColumn(
        "l_quantity", F.col("l_quantity") * F.when(F.col("order_day") == F.col("newest"), 2).otherwise(1)).drop("newest")
    return refresh_daily_sales(t.orders, changed, t.customer, t.nation, t.part, target, months=True).select(*U.DAILY_SALES_COLUMNS)


def daily_marketing(spark, d):
    t = _t(spark, d)
    return materialized(spark, "ext_daily_marketing", _paths(d, "lineitem", "orders", "customer"),
                        lambda: U.daily_marketing(t.lineitem, t.orders, t.customer, lines=order_lines(spark, d)))


def sessions(spark, d):
    return materialized(spark, "sessions", _paths(d, "events"), lambda: U.event_sessions(
        _t(spark, d).events, P.session_gap_minutes).select(
        "user_id", "session_start", "session_end", "n_events", "page_views", "clicks", "converted",
        "session_value", "duration_minutes"))


def daily_engagement(spark, d):
    return materialized(spark, "daily_product_engagement", _paths(d, "events"),
                        lambda: U.daily_engagement_from_sessions(sessions(spark, d)))


def stg_sales(spark, d):
    return M.stg_sales(daily_sales(spark, d), P)


def stg_marketing(spark, d):
    return M.stg_marketing(daily_marketing(spark, d), P)


def stg_engagement(spark, d):
    return M.stg_engagement(daily_engagement(spark, d), P)


def _spine(spark):
    return M.date_spine(spark, P.start_date, P.end_date)


def date_spine(spark, d):
    """W4 as a query over the data: each spine day with the sources that cover it."""
    spine = _spine(spark)
    for name, src in (("has_sales", stg_sales), ("has_marketing", stg_marketing),
                      ("has_engagement", stg_engagement)):
        days = src(spark, d).select(F.col("date_key").alias("date_day"), F.lit(True).alias(name))
        spine = spine.join(F.broadcast(days), "date_day", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return spine


def unified_daily(spark, d):
    return M.unified_daily(_spine(spark), stg_sales(spark, d), stg_marketing(spark, d),
                           stg_engagement(spark, d))


def unified_table(spark, d):
    """The unified daily metrics as a written table, for consumers that read them more than once."""
    return materialized(spark, "int_daily_unified_metrics", _paths(d, "lineitem", "orders", "customer", "nation", "part", "events"),
                        lambda: unified_daily(spark, d))


def business_kpis(spark, d):
    return M.business_kpis(unified_daily(spark, d), P)


def campaigns(spark, d):
    return materialized(spark, "ext_campaigns", _paths(d, "lineitem"),
                        lambda: U.campaign_performance(_t(spark, d).lineitem, P))


def attribution(spark, d):
    return materialized(spark, "ext_attribution", _paths(d, "events"),
                        lambda: U.channel_attribution(_t(spark, d).events))


def attribution_models(spark, d):
    """U5 by the first and by the last touch."""
    events = _t(spark, d).events
    return U.channel_attribution(events, "first_touch").unionByName(U.channel_attribution(events, "last_touch"))


def dim_marketing(spark, d):
    return M.dim_marketing(campaigns(spark, d), attribution(spark, d), stg_marketing(spark, d), P)


def user_sessions(spark, d):
    """Sessions of the user history, built once for profiles and 30-day metrics."""
    return materialized(spark, "user_sessions", _paths(d, "events"),
                        lambda: U.user_sessions(_t(spark, d).events, P.session_gap_minutes))


def user_profiles(spark, d):
    return materialized(spark, "user_profiles", _paths(d, "events"),
                        lambda: U.user_profiles_from_sessions(user_sessions(spark, d), P.as_of))


def user_metrics(spark, d):
    return materialized(spark, "user_engagement_metrics", _paths(d, "events"),
                        lambda: U.user_engagement_metrics_from(user_sessions(spark, d), _t(spark, d).events,
                                                               P.as_of, P.recent_days))


def features(spark, d):
    return materialized(spark, "feature_engagement_summary", _paths(d, "events"),
                        lambda: U.feature_engagement_summary(_t(spark, d).events))


def user_summary(spark, d):
    return M.user_summary(user_profiles(spark, d), user_metrics(spark, d), P)


def dim_user(spark, d):
    return M.dim_user(user_profiles(spark, d), user_metrics(spark, d), features(spark, d), P)


SNAPSHOT_AS_OF = dt.date(2024, 1, 20)


def profile_snapshot(spark, d):
    """W9 on real data: the profile table as of 2024-01-20 is the existing
    snapshot, the profile as of the fixture date is the current state; the
    day of the last login is the update timestamp."""
    ev = _t(spark, d).events
    early = ev.where(F.col("ts") < F.lit("2024-01-21").cast("timestamp_ntz"))

    def state(profiles):
        return profiles.select("user_id", "user_lifecycle_stage", "total_sessions",
                               F.col("last_login_date").cast("timestamp_ntz").alias("updated_timestamp"))
    # the earlier state is one row per user, read by several branches of the merge
    earlier = shared(state(U.user_profiles(early, SNAPSHOT_AS_OF, P.session_gap_minutes)))
    snap = M.snapshot_scd2(earlier, None, "user_id", "updated_timestamp")
    return M.snapshot_scd2(state(user_profiles(spark, d)), snap, "user_id", "updated_timestamp")


def part_revenue_ranks(spark: SparkSession, d: str) -> DataFrame:
    """E7/E8 over a domain that grows with the data: parts by revenue (exact cents)."""
    cents = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100).cast("long")
    revenue = _t(spark, d).lineitem.groupBy(F.col("l_partkey").alias("part_key")).agg(F.sum(cents).alias("revenue_cents"))
    ranked = row_number_distributed(revenue, [F.col("revenue_cents").desc(), F.col("part_key")], "revenue_rank",
                                    "part_key", ["revenue_cents"])
    return percent_rank_distributed(ranked, "revenue_cents", "p").select(
        "part_key", "revenue_cents", "revenue_rank", F.round("p", 6).alias("revenue_percentile"))


QUERIES = {
    "daily_sales": daily_sales,
    "daily_sales_rebuilt": daily_sales_rebuilt,
    "daily_marketing": daily_marketing,
    "sessions": sessions,
    "daily_engagement": daily_engagement,
    "stg_sales": stg_sales,
    "stg_marketing": stg_marketing,
    "stg_engagement": stg_engagement,
    "date_spine": date_spine,
    "unified_daily": unified_daily,
    "business_kpis": business_kpis,
    "campaigns": campaigns,
    "campaign_summary": lambda s, d: M.campaign_summary(campaigns(s, d), P),
    "campaign_percentiles": lambda s, d: M.campaign_percentiles(campaigns(s, d)),
    "part_revenue_ranks": part_revenue_ranks,
    "attribution": attribution,
    "attribution_models": attribution_models,
    "channel_summary": lambda s, d: M.channel_summary(attribution(s, d)),
    "monthly_trends": lambda s, d: M.monthly_trends(stg_marketing(s, d)),
    "dim_marketing": dim_marketing,
    "user_profiles": user_profiles,
    "user_engagement_metrics": user_metrics,
    "feature_summary": features,
    "user_summary": user_summary,
    "platform_percentiles": lambda s, d: M.platform_percentiles(user_summary(s, d)),
    "top_features": lambda s, d: M.top_features(features(s, d)),
    "feature_ranks": lambda s, d: M.feature_ranks(features(s, d)),
    "dim_user": dim_user,
    "profile_snapshot": profile_snapshot,
    "customer_value_tiers": lambda s, d: M.customer_value_tiers(_t(s, d).orders, P),
}
