"""DuckDB oracle SQL for the quality checks and dashboard feeds."""

from __future__ import annotations

from ..operators.quality import DECLARED_TESTS, Test
from . import oracle_warehouse as OW
from .oracle_reviews import _with, rnd
from .quality_feeds import CHECK_DAY, EMPTY_DAY, INDICATOR_AS_OF

_CTE = {
    "ext_redshift_daily_sales": "daily_sales",
    "ext_bigquery_marketing_daily": "daily_marketing",
    "daily_product_engagement": "daily_engagement",
    "stg_redshift_sales": "stg_sales",
    "stg_bigquery_marketing": "stg_marketing",
    "stg_snowflake_engagement": "stg_engagement",
}
_SOURCES = [OW.DAILY_SALES, OW.STG_SALES, OW.DAILY_MARKETING, OW.STG_MARKETING, OW.DAILY_ENGAGEMENT,
            OW.STG_ENGAGEMENT]


def _lit(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def _fail(t: Test) -> str:
    c = t.column
    if t.test == "not_null":
        return f"{c} IS NULL"
    if t.test == "accepted_values":
        return f"{c} IS NOT NULL AND {c} NOT IN ({', '.join(_lit(v) for v in t.values)})"
    parts = []
    if t.min_value is not None:
        parts.append(f"{c} < {t.min_value!r}")
    if t.max_value is not None:
        parts.append(f"{c} > {t.max_value!r}")
    return f"{c} IS NOT NULL AND ({' OR '.join(parts)})"


def _test_sql(t: Test) -> str:
    src = _CTE[t.model]
    if t.test == "unique":
        body = (f"(SELECT count(*) FROM (SELECT {t.column} FROM {src} WHERE {t.column} IS NOT NULL "
                f"GROUP BY 1 HAVING count(*) > 1))")
        return f"SELECT '{t.model}' AS model, '{t.column}' AS column_name, 'unique' AS test_name, {body} AS failures"
    return (f"SELECT '{t.model}' AS model, '{t.column}' AS column_name, '{t.test}' AS test_name, "
            f"count(CASE WHEN {_fail(t)} THEN 1 END) AS failures FROM {src}")


SUITE_BODY = "\nUNION ALL ".join(_test_sql(t) for t in DECLARED_TESTS)
SUITE_CTE = f"""
quality_suite AS (
  SELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({SUITE_BODY}))"""


def _ctes(blocks) -> str:
    return ",".join(b.strip("\n") for b in blocks)


def _w(blocks, body: str) -> str:
    return f"WITH {_ctes(blocks)}\n{body}"


def _fresh(src: str, day, name: str) -> str:
    return (f"SELECT '{name}' AS table_name, DATE '{day}' AS check_date, count(*) AS rows_for_day, "
            f"CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS quality_check FROM {src} "
            f"WHERE date_key = DATE '{day}'")


_KPI_BLOCKS = OW._BLOCKS["business_kpis"]

SQL = {
    "quality_suite": _w(_SOURCES + [SUITE_CTE], "SELECT * FROM quality_suite"),
    "freshness_checks": _w([OW.DAILY_SALES, OW.DAILY_MARKETING], "\nUNION ALL ".join([
        _fresh("daily_sales", CHECK_DAY, "daily_sales_summary"),
        _fresh("daily_marketing", CHECK_DAY, "daily_marketing_summary"),
        _fresh("daily_sales", EMPTY_DAY, "daily_sales_summary")])),
    "revenue_consistency": _w(_KPI_BLOCKS, f"""
SELECT 'Revenue Consistency' AS check_name, DATE '{CHECK_DAY}' AS check_date,
  {rnd('a', 4)} AS source_revenue, {rnd('b', 4)} AS kpi_revenue, {rnd('abs(a - b)', 4)} AS variance,
  CASE WHEN abs(a - b) < 100.0 THEN 'PASS' ELSE 'FAIL' END AS validation_result
FROM (SELECT sum(total_revenue) AS a FROM daily_sales WHERE date_key = DATE '{CHECK_DAY}')
CROSS JOIN (SELECT sum(total_revenue) AS b FROM business_kpis
            WHERE date_key = DATE '{CHECK_DAY}' AND sales_data_available)"""),
    "run_summary": _w(_KPI_BLOCKS + [SUITE_CTE], f"""
SELECT c.model, c.row_count, coalesce(tests, 0) AS tests, coalesce(tests_passed, 0) AS tests_passed,
  coalesce(failing_records, 0) AS failing_records,
  {rnd('CASE WHEN tests > 0 THEN tests_passed * 100.0 / tests END', 2)} AS quality_score,
  coalesce(tests_passed, 0) < coalesce(tests, 0) AS alert
FROM (""" + "\n  UNION ALL ".join(
        f"SELECT '{m}' AS model, count(*) AS row_count FROM {cte}"
        for m, cte in list(_CTE.items()) + [("int_daily_unified_metrics", "unified_daily"),
                                            ("fct_unified_business_kpis", "business_kpis")]) + """) c
LEFT JOIN (SELECT model, count(*) AS tests, count(CASE WHEN status = 'PASS' THEN 1 END) AS tests_passed,
                  CAST(sum(failures) AS BIGINT) AS failing_records FROM quality_suite GROUP BY model) t ON c.model = t.model"""),
    "quality_indicators": _with(f"""
SELECT CASE WHEN least(pos, neg) >= 30 THEN 'Green' WHEN least(pos, neg) >= 15 THEN 'Yellow' ELSE 'Red' END
    AS sample_size_adequacy,
  CAST(latest AS DATE) AS last_updated, CAST(DATE '{INDICATOR_AS_OF}' - CAST(latest AS DATE) AS INTEGER)
    AS days_since_update,
  {rnd('complete * 100.0 / NULLIF(n, 0)', 4)} AS pct_complete, {rnd('outliers * 100.0 / NULLIF(n, 0)', 4)} AS pct_outliers,
  least(pos, neg) < 30 AS low_sample_warning
FROM (SELECT count(*) AS n, count(CASE WHEN sentiment = 'Positive' THEN 1 END) AS pos,
        count(CASE WHEN sentiment = 'Negative' THEN 1 END) AS neg,
        count(CASE WHEN review_text IS NOT NULL AND sentiment IS NOT NULL AND rating IS NOT NULL
                    AND app_name IS NOT NULL AND review_length IS NOT NULL AND word_count IS NOT NULL THEN 1 END)
          AS complete,
        count(CASE WHEN is_length_outlier THEN 1 END) AS outliers, max(ingestion_timestamp) AS latest
      FROM reviews_analyzed)"""),
    "rating_by_sentiment": _with(f"""
SELECT sentiment, {rnd('avg(rating)', 6)} AS avg_rating, count(*) AS count,
  {rnd('stddev_samp(rating) / sqrt(count(*))', 8)} AS standard_error
FROM reviews_analyzed GROUP BY sentiment"""),
    "scatter_trend": _with(f"""
SELECT count(*) AS n, {rnd('regr_slope(rating, review_length)', 10)} AS slope,
  {rnd('regr_intercept(rating, review_length)', 8)} AS intercept, {rnd('corr(review_length, rating)', 8)} AS r
FROM length_rating_correlation"""),
    "box_plot": _with(f"""
SELECT sentiment, n, {rnd('q1', 6)} AS q1, {rnd('median', 6)} AS median, {rnd('q3', 6)} AS q3,
  {rnd('lower_whisker', 6)} AS lower_whisker, {rnd('upper_whisker', 6)} AS upper_whisker, outliers,
  {rnd('mean', 6)} AS mean, {rnd('mean - 1.96 * sd / sqrt(n)', 6)} AS mean_ci_low,
  {rnd('mean + 1.96 * sd / sqrt(n)', 6)} AS mean_ci_high
FROM (SELECT t.sentiment, q1, median, q3, count(*) AS n, avg(rating) AS mean, stddev_samp(rating) AS sd,
        min(CASE WHEN rating >= lo AND rating <= hi THEN rating END) AS lower_whisker,
        max(CASE WHEN rating >= lo AND rating <= hi THEN rating END) AS upper_whisker,
        count(CASE WHEN NOT (rating >= lo AND rating <= hi) THEN 1 END) AS outliers
      FROM ttest_data t JOIN (
        SELECT sentiment, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
        FROM (SELECT sentiment, quantile_cont(rating, 0.25) AS q1, quantile_cont(rating, 0.5) AS median,
                     quantile_cont(rating, 0.75) AS q3 FROM ttest_data WHERE rating IS NOT NULL GROUP BY 1)) q
      ON t.sentiment = q.sentiment GROUP BY t.sentiment, q1, median, q3)"""),
    "quality_stack": _with(f"""
SELECT review_quality, rating_category, count,
  {rnd('CAST(count AS DOUBLE) * 100.0 / NULLIF(CAST(sum(count) OVER (PARTITION BY review_quality) AS DOUBLE), 0)', 4)}
    AS share_pct
FROM (SELECT review_quality, CASE WHEN rating <= 2 THEN 'Low' WHEN rating = 3 THEN 'Medium' ELSE 'High' END
        AS rating_category, count(*) AS count FROM reviews_analyzed GROUP BY 1, 2)"""),
    "mean_ci": _with(f"""
SELECT sentiment, n, {rnd('m', 6)} AS mean_rating, {rnd('sd', 6)} AS std_rating,
  {rnd('sd / sqrt(n)', 8)} AS standard_error, {rnd('m - 1.96 * sd / sqrt(n)', 6)} AS ci_low,
  {rnd('m + 1.96 * sd / sqrt(n)', 6)} AS ci_high
FROM (SELECT sentiment, count(*) AS n, avg(rating) AS m, stddev_samp(rating) AS sd FROM reviews_analyzed GROUP BY 1)"""),
    "filtered_reviews": _with("""
SELECT review_id, sentiment, rating, length_category, ingestion_timestamp FROM reviews_analyzed
WHERE sentiment IN ('Positive', 'Negative') AND rating BETWEEN 1 AND 5 AND length_category IN ('Short', 'Medium')
  AND CAST(ingestion_timestamp AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"""),
    "drill_down": _with("""
SELECT * FROM (SELECT sentiment, review_id, left(review_text, 100) AS review_preview, rating,
                      row_number() OVER (PARTITION BY sentiment ORDER BY review_id) AS sample_rank
               FROM reviews_analyzed) WHERE sample_rank <= 3"""),
    "scatter_sample": _with(f"""
SELECT review_length, rating, sentiment FROM (
  SELECT *, ('0x' || left(sha256(review_id || '|42'), 8))::BIGINT AS h FROM reviews_analyzed
  WHERE review_length IS NOT NULL)
WHERE h < {int(0.1 * 2 ** 32)}"""),
    "scatter_grid": _with("""
SELECT review_length, rating, sentiment, count(*) AS reviews FROM reviews_analyzed
WHERE review_length IS NOT NULL GROUP BY 1, 2, 3"""),
    "capped_sample": _with("""
SELECT review_id, sentiment, rating FROM (
  SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY sha256(review_id || '|42'), review_id) AS rn
  FROM reviews_analyzed) WHERE rn <= 5000"""),
    "kpi_weekly": _with(f"""
SELECT CAST(date_trunc('week', ingestion_timestamp) AS DATE) AS week_start, count(*) AS review_volume,
  {rnd('avg(review_length)', 4)} AS avg_length,
  {rnd("count(CASE WHEN sentiment = 'Positive' THEN 1 END) * 100.0 / count(*)", 4)} AS pct_positive,
  {rnd('count(CASE WHEN review_length > 100 THEN 1 END) * 100.0 / count(*)', 4)} AS pct_long_reviews,
  {rnd('stddev_samp(sentiment_score)', 6)} AS sentiment_volatility
FROM reviews_analyzed GROUP BY 1"""),
}
