"""Warehouse models on hand-made rows (traps T9-T16) and on the driver tables."""

import datetime as dt

from pyspark.sql import functions as F

from plume.operators.warehouse import models as M
from plume.params import DEFAULT, FIXTURE
from plume.plans import warehouse as W

from conftest import SF_SMALL


def test_date_spine_is_end_exclusive(spark):
    s = M.date_spine(spark, dt.date(2023, 1, 1), dt.date(2023, 12, 31))
    days = [r.date_day for r in s.orderBy("date_day").collect()]
    assert len(days) == 364 and days[0] == dt.date(2023, 1, 1) and days[-1] == dt.date(2023, 12, 30)


def _sales(spark, rows):
    return spark.createDataFrame(rows, "date_key date, total_orders long, total_revenue double, "
                                       "total_items_sold double, unique_customers long, avg_order_value double, "
                                       "avg_items_per_order double, top_product_category string, top_state string, "
                                       "delivered_orders long, delivery_performance_score double")


def test_stg_sales_filter_defaults_and_flags(spark):
    p = DEFAULT
    rows = [(dt.date(2022, 12, 31), 1, 1.0, 1.0, 1, 1.0, 1.0, "a", "s", 1, 1.0),
            (dt.date(2023, 1, 1), 4, 100.0, 8.0, 2, None, None, None, None, 2, None),
            (dt.date(2023, 12, 31), 0, None, None, 0, None, None, None, None, 0, None),
            (dt.date(2024, 1, 1), 1, 1.0, 1.0, 1, 1.0, 1.0, "a", "s", 1, 1.0),
            (None, 1, 1.0, 1.0, 1, 1.0, 1.0, "a", "s", 1, 1.0)]
    out = {r.date_key: r for r in M.stg_sales(_sales(spark, rows), p).collect()}
    assert set(out) == {dt.date(2023, 1, 1), dt.date(2023, 12, 31)}   # staging keeps the end day (T10)
    a, b = out[dt.date(2023, 1, 1)], out[dt.date(2023, 12, 31)]
    assert (a.calculated_aov, a.delivery_rate_pct, a.top_state, a.has_revenue_data) == (25.0, 50.0, "Unknown", True)
    assert (b.total_revenue, b.has_revenue_data, b.calculated_aov) == (0.0, False, 0.0)


def test_unified_daily_unmatched_days(spark):
    p = DEFAULT
    spine = M.date_spine(spark, dt.date(2023, 1, 1), dt.date(2023, 1, 4))
    sales = M.stg_sales(_sales(spark, [(dt.date(2023, 1, 2), 4, 100.0, 8.0, 2, 25.0, 2.0, "a", "s", 2, 50.0)]), p)
    empty_m = spark.createDataFrame([], M.stg_marketing(spark.createDataFrame(
        [], "date_key date, total_spend double, total_impressions double, total_clicks double, "
            "total_conversions long, unique_campaigns long, active_channels long, avg_ctr double, "
            "avg_conversion_rate double, avg_cpc double, avg_cpa double, top_performing_channel string, "
            "top_performing_campaign string, channel_performance_score double, roas double"), p).schema)
    empty_e = spark.createDataFrame([], M.stg_engagement(spark.createDataFrame(
        [], "date_key date, active_users long, total_sessions long, total_session_minutes double, "
            "avg_session_duration double, total_page_views long, avg_page_views_per_session double, "
            "bounce_sessions long, conversion_sessions long, total_session_value double, bounce_rate double, "
            "conversion_rate double"), p).schema)
    u = {r.date_key: r for r in M.unified_daily(spine, sales, empty_m, empty_e).collect()}
    assert len(u) == 3
    miss, hit = u[dt.date(2023, 1, 1)], u[dt.date(2023, 1, 2)]
    assert (miss.total_revenue, miss.has_revenue_data, miss.roas_tier, miss.data_completeness_score) == \
        (0.0, None, None, 0.0)                                       # T13
    assert (hit.total_revenue, hit.sales_data_available, hit.data_completeness_score) == (100.0, True, 33.33)
    k = {r.date_key: r for r in M.business_kpis(M.unified_daily(spine, sales, empty_m, empty_e), p).collect()}
    assert k[dt.date(2023, 1, 2)].estimated_customer_lifetime_value == 87.5
    assert 0 <= k[dt.date(2023, 1, 2)].overall_business_score <= 100


def test_user_tiers_and_risk_edges(spark):
    p = DEFAULT
    from plume.functions import bins
    df = spark.createDataFrame([(20.0, 7, 1), (40.0, 8, 2), (70.0, 14, 5), (None, 15, 10), (19.9, None, 0)],
                               "score double, days long, features long")
    got = [tuple(r) for r in df.select(bins.user_value_tier("score", p), bins.churn_risk("days"),
                                       bins.adoption_level("features")).collect()]
    assert got == [("Low Value", "Active", "Minimal User"), ("Medium Value", "Low Risk", "Light User"),
                   ("High Value", "Low Risk", "Regular User"), ("At Risk", "Medium Risk", "Power User"),
                   ("At Risk", "Active", "Minimal User")]                # T16: NULLs fall through


def test_scd2_closes_changed_and_opens_new(spark):
    ts = lambda d: dt.datetime(2024, 1, d)
    snap = spark.createDataFrame([(1, "a", ts(1), ts(1), None), (2, "b", ts(1), ts(1), None),
                                  (3, "c", ts(1), ts(1), ts(2))],
                                 "id long, v string, updated timestamp_ntz, dbt_valid_from timestamp_ntz, "
                                 "dbt_valid_to timestamp_ntz")
    cur = spark.createDataFrame([(1, "a", ts(1)), (2, "B", ts(5)), (4, "d", ts(6))],
                                "id long, v string, updated timestamp_ntz")
    out = sorted((r.id, r.v, r.dbt_valid_from.day, r.dbt_valid_to.day if r.dbt_valid_to else None)
                 for r in M.snapshot_scd2(cur, snap, "id", "updated").collect())
    assert out == [(1, "a", 1, None), (2, "B", 5, None), (2, "b", 1, 5), (3, "c", 1, 2), (4, "d", 6, None)]


def test_fixture_marts_properties(spark):
    k = W.business_kpis(spark, SF_SMALL)
    assert k.count() == 364
    bad = k.where((F.col("overall_business_score") < 0) | (F.col("overall_business_score") > 100)).count()
    assert bad == 0
    assert W.dim_user(spark, SF_SMALL).select("user_id").distinct().count() == W.user_profiles(spark, SF_SMALL).count()
    stg = W.stg_engagement(spark, SF_SMALL)
    assert stg.where((F.col("engagement_score") < 0) | (F.col("engagement_score") > 100)).count() == 0


def test_attribution_models(spark):
    import pytest
    from plume.operators.warehouse.upstream import channel_attribution
    t = lambda m: dt.datetime(2024, 1, 1, 10, m)
    rows = [(1, t(1), 7, "view", None), (2, t(2), 7, "click", None), (3, t(3), 7, "view", None), (4, t(4), 7, "purchase", 30.0),
            (5, t(5), 7, "click", None), (6, t(6), 7, "purchase", 10.0), (7, t(7), 7, "view", None)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
    got = {m: {r.channel: (r.total_attributed_conversions, r.total_attributed_revenue, r.attribution_model)
               for r in channel_attribution(events, m).collect()} for m in ("linear", "first_touch", "last_touch")}
    assert got["linear"] == {"view": (0.666667, 20.0, "linear"), "click": (1.333333, 20.0, "linear")}
    assert got["first_touch"] == {"view": (1.0, 30.0, "first_touch"), "click": (1.0, 10.0, "first_touch")}
    assert got["last_touch"] == {"view": (1.0, 30.0, "last_touch"), "click": (1.0, 10.0, "last_touch")}
    with pytest.raises(ValueError):
        channel_attribution(events, "time_decay")
