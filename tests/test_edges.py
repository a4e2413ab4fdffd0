"""Edge rows from FIXTURES.md section 3 not covered elsewhere."""

import datetime as dt

from pyspark.sql import functions as F

from plume.functions import bins
from plume.operators import quality as Q
from plume.operators import stats
from plume.operators.warehouse import models as M
from plume.params import DEFAULT


def test_suite_on_bad_daily_source(spark):
    d = dt.date(2023, 3, 1)
    df = spark.createDataFrame([(d, -5.0, 3), (d, 10.0, None), (None, 1.0, 2), (dt.date(2023, 3, 2), None, -1)],
                               "date_key date, total_revenue double, unique_customers long")
    tests = [t for t in Q.DECLARED_TESTS if t.model == "ext_redshift_daily_sales"]
    got = {(r.column_name, r.test_name): r.failures
           for r in Q.run_suite({"ext_redshift_daily_sales": df}, tests).collect()}
    assert got == {("date_key", "not_null"): 1, ("date_key", "unique"): 1,
                   ("total_revenue", "not_null"): 1, ("total_revenue", "accepted_range"): 1,
                   ("unique_customers", "not_null"): 1, ("unique_customers", "accepted_range"): 1}


def test_engagement_quality_and_score_edges(spark):
    rows = [(10.0, 30.0, 5.0, 2.0, 101), (9.99, 30.0, 5.0, 2.0, 100), (5.0, 50.0, 2.0, 1.0, 51),
            (2.0, 70.0, 0.0, 1.0, 50), (2.0, 70.01, 0.0, 1.0, 11), (None, None, None, None, 10)]
    df = spark.createDataFrame(rows, "d double, b double, c double, v double, u long")
    got = [(r[0], r[1]) for r in df.select(bins.engagement_quality("d", "b", "c"),
                                           bins.engagement_score("d", "b", "c", "v", "u")).collect()]
    assert [g[0] for g in got] == ["High", "Medium", "Medium", "Low", "Very Low", "Very Low"]
    # 20 + 21 + 25 + 5 + 20 = 91 for the first row; users 10 -> 5 points only
    assert abs(got[0][1] - 91.0) < 1e-9 and got[5][1] == 5.0


def test_campaign_ranks_ties_nulls_and_zero_spend(spark):
    rows = [(1, 2.0, 100.0, 50.0, 0.0, 10.0), (2, 2.0, 100.0, 50.0, 100.0, 200.0), (3, None, 0.0, None, 0.0, 0.0),
            (4, 5.0, 300.0, 90.0, 10.0, 50.0)]
    df = spark.createDataFrame(rows, "campaign_id long, roas double, attributed_revenue double, "
                                     "efficiency_score double, total_spend double, x double")
    out = {r.campaign_id: r for r in M.campaign_summary(df, DEFAULT).collect()}
    # Snowflake orders NULL as the largest value: DESC puts it first; ties by id
    assert [out[i].roas_rank for i in (3, 4, 1, 2)] == [1, 2, 3, 4]
    assert out[1].roi_percentage == 0.0 and out[3].campaign_health_status == "Needs Improvement"
    assert out[4].campaign_health_status == "Excellent"


def test_monthly_trends_first_month_and_zero_spend(spark):
    rows = [(dt.date(2023, 1, 5), 100.0, 2.0, 3), (dt.date(2023, 2, 5), 0.0, 0.0, 0), (dt.date(2023, 3, 5), 50.0, 1.0, 1)]
    df = spark.createDataFrame(rows, "date_key date, total_spend double, roas double, total_conversions long")
    got = {r.month_num: r.spend_growth_pct for r in M.monthly_trends(df).collect()}
    assert got == {1: 0.0, 2: -100.0, 3: 0.0}      # no predecessor -> 0; after a zero month -> 0


def test_statistics_on_empty_and_all_tied_input(spark):
    empty = spark.createDataFrame([], "sentiment string, rating double, review_length long")
    r = stats.t_test(empty, with_p=True).first()
    assert r.n_positive == 0 and r.t_statistic is None and r.p_value is None
    tied = spark.createDataFrame([("Positive", 3.0, 10)] * 5, "sentiment string, rating double, review_length long")
    s = stats.spearman(tied, "review_length", "rating").first()
    assert s.n == 5 and s.r is None
    a = stats.anova(tied, with_p=True).first()
    assert a.groups == 1 and a.f_statistic is None
