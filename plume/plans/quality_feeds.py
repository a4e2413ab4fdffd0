"""Registered data-quality checks (Q5-Q10) and dashboard feeds (V1-V8)."""

from __future__ import annotations

import datetime as dt

from ..operators import feeds as V
from ..operators import quality as Q
from ..operators import stats, transform
from ..operators.warehouse import models as M
from . import reviews, warehouse as W

CHECK_DAY = dt.date(1998, 6, 30)
EMPTY_DAY = dt.date(2005, 1, 1)
INDICATOR_AS_OF = dt.date(2024, 2, 1)

# model names of the declared tests -> builders
_MODELS = {
    "ext_redshift_daily_sales": W.daily_sales,
    "ext_bigquery_marketing_daily": W.daily_marketing,
    "daily_product_engagement": W.daily_engagement,
    "stg_redshift_sales": W.stg_sales,
    "stg_bigquery_marketing": W.stg_marketing,
    "stg_snowflake_engagement": W.stg_engagement,
}


def models(spark, d):
    return {name: fn(spark, d) for name, fn in _MODELS.items()}


def quality_suite(spark, d):
    return Q.run_suite(models(spark, d), Q.DECLARED_TESTS)


def freshness_checks(spark, d):
    s, m = W.daily_sales(spark, d), W.daily_marketing(spark, d)
    return (Q.freshness(s, CHECK_DAY, "daily_sales_summary")
            .unionByName(Q.freshness(m, CHECK_DAY, "daily_marketing_summary"))
            .unionByName(Q.freshness(s, EMPTY_DAY, "daily_sales_summary")))


def revenue_consistency(spark, d):
    return Q.revenue_consistency(W.daily_sales(spark, d), W.business_kpis(spark, d), CHECK_DAY)


def run_summary(spark, d):
    ms = models(spark, d)
    unified = W.unified_table(spark, d)
    ms["int_daily_unified_metrics"] = unified
    ms["fct_unified_business_kpis"] = M.business_kpis(unified, W.P)
    return Q.run_summary(ms, Q.DECLARED_TESTS)


def _ttest(s, d):
    return transform.ttest_data(reviews.analyzed(s, d))


QUERIES = {
    "quality_suite": quality_suite,
    "freshness_checks": freshness_checks,
    "revenue_consistency": revenue_consistency,
    "run_summary": run_summary,
    "quality_indicators": lambda s, d: Q.quality_indicators(reviews.analyzed(s, d), INDICATOR_AS_OF),
    "rating_by_sentiment": lambda s, d: V.rating_by_sentiment(reviews.analyzed(s, d)),
    "scatter_trend": lambda s, d: V.scatter_trend(reviews.correlation(s, d)),
    "box_plot": lambda s, d: V.box_plot(_ttest(s, d)),
    "quality_stack": lambda s, d: V.quality_stack(reviews.analyzed(s, d)),
    "mean_ci": lambda s, d: V.mean_ci(reviews.analyzed(s, d)),
    "filtered_reviews": lambda s, d: V.filter_reviews(
        reviews.analyzed(s, d), sentiments=("Positive", "Negative"), rating_range=(1, 5),
        length_categories=("Short", "Medium"), date_range=(dt.date(2024, 1, 5), dt.date(2024, 1, 20))
    ).select("review_id", "sentiment", "rating", "length_category", "ingestion_timestamp"),
    "drill_down": lambda s, d: V.drill_down(reviews.analyzed(s, d)),
    "kpi_weekly": lambda s, d: V.kpi_weekly(reviews.analyzed(s, d)),
    "capped_sample": lambda s, d: V.capped_sample(reviews.analyzed(s, d), "sentiment", cap=5000).select(
        "review_id", "sentiment", "rating"),
    "scatter_sample": lambda s, d: V.scatter_sample(reviews.analyzed(s, d)),
    "scatter_grid": lambda s, d: V.scatter_grid(reviews.analyzed(s, d)),
    "kpi_cards": lambda s, d: V.kpi_cards(stats.statistical_results(_ttest(s, d), reviews.correlation(s, d)),
                                          reviews.analyzed(s, d)),
}
