"""End-to-end jobs: what the reference's scripts and daily run do, as Spark jobs.

``run_reviews``   ingestion -> day-partitioned raw table -> post-load checks ->
                  analysis table -> summary statistics -> statistical results ->
                  dashboard feeds
``run_warehouse`` daily sources exported as Parquet -> staging (lazy) ->
                  unified daily (lazy) -> marts written -> declarative tests with
                  stored failures -> freshness / revenue checks -> summary

Every step is a distributed read or write; tables go to ``out`` (a shared
folder on a cluster).  Usage::

    python -m plume.plans.jobs reviews   --sf /data/sf --out /shared/out
    python -m plume.plans.jobs warehouse --sf /data/sf --out /shared/out
"""

from __future__ import annotations

import argparse
import datetime as dt
import uuid

from pyspark.sql import SparkSession

from ..operators import analysis as A
from ..operators import feeds as V
from ..operators import ingest, quality, stats, transform
from ..operators.warehouse import models as M
from ..operators.warehouse import upstream as U
from ..params import FIXTURE
from ..sources import io
from ..sources.fixtures import review_file
from ..sources.store import NAMESPACE_CONF, remove_folder, table_root
from ..sources.tables import Tables


def run_reviews(spark: SparkSession, sf_dir: str, out: str, run_ts: dt.datetime | None = None) -> dict:
    run_ts = run_ts or dt.datetime(2024, 2, 1)
    out = out.rstrip("/")
    raw = ingest.ingest_reviews(review_file(spark, sf_dir, even=True))
    io.write_raw_reviews(raw, f"{out}/raw_reviews")
    raw_t = io.read_raw_reviews(spark, f"{out}/raw_reviews").drop("ingestion_date")
    A.post_load_checks(raw_t).write.mode("overwrite").parquet(f"{out}/post_load_checks")
    transform.reviews_analyzed(raw_t, run_ts).write.mode("overwrite").parquet(f"{out}/reviews_analyzed")
    an = spark.read.parquet(f"{out}/reviews_analyzed")
    A.summary_statistics(an).write.mode("overwrite").parquet(f"{out}/summary_statistics")
    results = stats.statistical_results(transform.ttest_data(an), transform.length_rating_correlation(an))
    stored = io.save_statistical_results(results, f"{out}/statistical_results", run_ts)
    # dashboard feeds: one small pre-aggregated table per chart, refreshed with the data
    corr, ttest = transform.length_rating_correlation(an), transform.ttest_data(an)
    feeds = {
        "kpi_cards": V.kpi_cards(stored, an),
        "rating_by_sentiment": V.rating_by_sentiment(an),
        "scatter_sample": V.scatter_sample(an),
        "scatter_trend": V.scatter_trend(corr),
        "box_plot": V.box_plot(ttest),
        "quality_stack": V.quality_stack(an),
        "mean_ci": V.mean_ci(an),
        "kpi_weekly": V.kpi_weekly(an),
        "quality_indicators": quality.quality_indicators(an, run_ts.date()),
    }
    for name, df in feeds.items():
        df.write.mode("overwrite").parquet(f"{out}/feeds/{name}")
    paths = {name: f"{out}/{name}" for name in ("raw_reviews", "post_load_checks", "reviews_analyzed",
                                                "summary_statistics", "statistical_results")}
    paths.update({f"feeds/{name}": f"{out}/feeds/{name}" for name in feeds})
    return paths


def run_warehouse(spark: SparkSession, sf_dir: str, out: str, params=FIXTURE,
                  run_ts: dt.datetime | None = None, check_day: dt.date = dt.date(1998, 6, 30)) -> dict:
    run_ts = run_ts or dt.datetime(2024, 2, 1)
    out = out.rstrip("/")
    t = Tables(spark, sf_dir)
    # the user history is sessionized once and feeds profiles and 30-day metrics
    io.export_parquet(U.user_sessions(t.events, params.session_gap_minutes), f"{out}/sources/user_sessions")
    user_sess = spark.read.parquet(f"{out}/sources/user_sessions")
    # line items are joined with their orders once, for sales and marketing
    io.export_parquet(U.order_lines(t.lineitem, t.orders, t.customer), f"{out}/sources/order_lines")
    lines = spark.read.parquet(f"{out}/sources/order_lines")
    # sources: built from the facts and exported as Parquet, then read back
    exports = {
        "ext_redshift_daily_sales": U.daily_sales(t.orders, t.lineitem, t.customer, t.nation, t.part, lines=lines),
        "ext_bigquery_marketing_daily": U.daily_marketing(t.lineitem, t.orders, t.customer, lines=lines),
        "daily_product_engagement": U.daily_engagement(t.events, params.session_gap_minutes),
        "ext_bigquery_campaigns": U.campaign_performance(t.lineitem, params),
        "ext_bigquery_attribution": U.channel_attribution(t.events),
        "user_profiles": U.user_profiles_from_sessions(user_sess, params.as_of),
        "user_engagement_metrics": U.user_engagement_metrics_from(user_sess, t.events, params.as_of,
                                                                  params.recent_days),
        "feature_engagement_summary": U.feature_engagement_summary(t.events),
    }
    src = {}
    for name, df in exports.items():
        io.export_parquet(df, f"{out}/sources/{name}")
        src[name] = spark.read.parquet(f"{out}/sources/{name}")
    # staging and intermediate stay lazy (views)
    stg = {"stg_redshift_sales": M.stg_sales(src["ext_redshift_daily_sales"], params),
           "stg_bigquery_marketing": M.stg_marketing(src["ext_bigquery_marketing_daily"], params),
           "stg_snowflake_engagement": M.stg_engagement(src["daily_product_engagement"], params)}
    spine = M.date_spine(spark, params.start_date, params.end_date)
    daily = M.unified_daily(spine, stg["stg_redshift_sales"], stg["stg_bigquery_marketing"],
                            stg["stg_snowflake_engagement"])
    # marts are written
    marts = {
        "fct_unified_business_kpis": M.business_kpis(daily, params, run_ts),
        "dim_marketing_performance": M.dim_marketing(src["ext_bigquery_campaigns"], src["ext_bigquery_attribution"],
                                                     stg["stg_bigquery_marketing"], params, run_ts),
        "dim_user_engagement": M.dim_user(src["user_profiles"], src["user_engagement_metrics"],
                                          src["feature_engagement_summary"], params, run_ts),
    }
    for name, df in marts.items():
        df.write.mode("overwrite").parquet(f"{out}/marts/{name}")
    kpis = spark.read.parquet(f"{out}/marts/fct_unified_business_kpis")
    # declarative tests, failing rows stored per failing test
    tested = {**{k: src[k] for k in ("ext_redshift_daily_sales", "ext_bigquery_marketing_daily",
                                     "daily_product_engagement")}, **stg}
    quality.run_suite(tested, quality.DECLARED_TESTS).write.mode("overwrite").parquet(f"{out}/tests/results")
    results = spark.read.parquet(f"{out}/tests/results")
    failing = {(r.model, r.column_name, r.test_name) for r in results.where("status = 'FAIL'").collect()}
    failed = [t for t in quality.DECLARED_TESTS if (t.model, t.column, t.test) in failing]
    if failed:  # one scan per model that failed, one folder per test
        io.store_failures(quality.stored_failures(tested, failed), f"{out}/tests/failures")
    checks = (quality.freshness(src["ext_redshift_daily_sales"], check_day, "daily_sales_summary")
              .unionByName(quality.freshness(src["ext_bigquery_marketing_daily"], check_day,
                                             "daily_marketing_summary")))
    checks.write.mode("overwrite").parquet(f"{out}/checks/freshness")
    quality.revenue_consistency(src["ext_redshift_daily_sales"], kpis, check_day) \
        .write.mode("overwrite").parquet(f"{out}/checks/revenue_consistency")
    summary_models = {**tested, "int_daily_unified_metrics": daily, "fct_unified_business_kpis": kpis}
    quality.run_summary(summary_models, quality.DECLARED_TESTS) \
        .write.mode("overwrite").parquet(f"{out}/run_summary")
    return {"marts": sorted(marts), "failing_tests": sorted(failing)}


def main(argv=None) -> None:
    from ..session import build_session
    ap = argparse.ArgumentParser(prog="python -m plume.plans.jobs")
    ap.add_argument("pipeline", choices=["reviews", "warehouse"])
    ap.add_argument("--sf", required=True, help="folder with the input Parquet tables")
    ap.add_argument("--out", required=True, help="output folder (shared on a cluster)")
    ap.add_argument("--master", default=None)
    ap.add_argument("--cluster", action="store_true", help="use the large-cluster shuffle/AQE settings")
    a = ap.parse_args(argv)
    spark = build_session(a.master, cluster=a.cluster)
    # intermediates of this run live in their own namespace and go away with it
    spark.conf.set(NAMESPACE_CONF, f"job-{uuid.uuid4().hex}")
    try:
        result = (run_reviews if a.pipeline == "reviews" else run_warehouse)(spark, a.sf, a.out)
        print(result)
    finally:
        remove_folder(spark, table_root(spark))
        spark.stop()


if __name__ == "__main__":
    main()
