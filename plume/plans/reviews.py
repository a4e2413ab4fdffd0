"""Pipeline R as registered queries: each takes (spark, sf_dir) -> DataFrame.

Every query starts from the driver tables, so its work grows with them:
documents -> review file -> raw_reviews (ingestion) -> reviews_analyzed
(transform) -> the analysis query.  All steps are one lazy plan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import analysis as A
from ..operators import cube, ingest, transform
from ..sources.fixtures import review_file
from ..sources import io
from ..sources.store import materialized, spread, written_once


def _inputs(sf_dir: str) -> list[str]:
    return [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("documents", "labels")]


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``raw_reviews`` table (ingestion output), written once and reused.

    Rows are clustered by (sentiment, rating) within files, as the original
    table is, so min/max statistics let Parquet skip row groups.
    """
    return materialized(spark, "raw_reviews", _inputs(sf_dir),
                        lambda: ingest.ingest_reviews(review_file(spark, sf_dir, even=True)),
                        sort_within=["sentiment", "rating"]).select(*ingest.RAW_REVIEW_COLUMNS)


def analyzed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``reviews_analyzed`` table (create-or-replace table as select)."""
    return materialized(spark, "reviews_analyzed", _inputs(sf_dir),
                        lambda: transform.reviews_analyzed(raw_reviews(spark, sf_dir)))


CSV_SCHEMA = T.StructType([T.StructField("rid", T.LongType())] + list(io.REVIEW_CSV_SCHEMA.fields)
                          + [T.StructField("ingestion_timestamp", T.TimestampNTZType())])


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 -> A1 -> ingestion: the review file exported as CSV, read back with
    the fixed-schema reader and ingested; equals ``reviews_clean``."""
    def write(path: str) -> None:
        io.write_csv(review_file(spark, sf_dir).select(*[f.name for f in CSV_SCHEMA.fields]), path)
    path = written_once(spark, "review_csv", _inputs(sf_dir), write)
    return ingest.ingest_reviews(spread(io.read_reviews_csv(spark, path, CSV_SCHEMA), "rid"))


def partitioned_raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: every day of the day-partitioned raw table."""
    return _by_day(spark, sf_dir, None)


def recent_raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 with partition pruning: the second half of the month (only those partition folders are read)."""
    return _by_day(spark, sf_dir, PRUNE_SINCE)


def _by_day(spark: SparkSession, sf_dir: str, since: dt.date | None) -> DataFrame:
    path = written_once(spark, "raw_reviews_by_day", _inputs(sf_dir),
                        lambda p: io.write_raw_reviews(raw_reviews(spark, sf_dir), p))
    return (io.read_raw_reviews(spark, path, since=since)
              .groupBy("ingestion_date", "sentiment").agg(F.count(F.lit(1)).alias("reviews"),
                                                          F.sum("review_length").alias("total_length")))


PRUNE_SINCE = dt.date(2024, 1, 16)


def correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.length_rating_correlation(analyzed(spark, sf_dir))


def moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The moments of ``reviews_analyzed``, written once; the reports over them read no review."""
    return materialized(spark, "review_moments", _inputs(sf_dir), lambda: cube.review_moments(analyzed(spark, sf_dir)))


def review_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The moments with their exact sums as doubles."""
    own = moments(spark, sf_dir)
    return own.select(*[F.col(c).cast("double").alias(c) if c.endswith(("_sum", "_squares")) else c for c in own.columns])


def _on_raw(fn):
    return lambda spark, d: fn(raw_reviews(spark, d))


def _on_analyzed(fn):
    return lambda spark, d: fn(analyzed(spark, d))


def _on_corr(fn):
    return lambda spark, d: fn(correlation(spark, d))


QUERIES = {
    "reviews_clean": raw_reviews,
    "csv_ingest": csv_ingest,
    "partitioned_raw_reviews": partitioned_raw_reviews,
    "recent_raw_reviews": recent_raw_reviews,
    "cleaning_audit": lambda spark, d: ingest.cleaning_audit(review_file(spark, d)),
    "raw_profile": _on_raw(A.raw_profile),
    "sentiment_distribution": _on_raw(lambda df: A.distribution(df, "sentiment", [F.desc("count")])),
    "rating_distribution": _on_raw(lambda df: A.distribution(df, "rating", ["rating"])),
    "raw_quality": _on_raw(A.raw_quality),
    "raw_preview": _on_raw(A.preview),
    "post_load_checks": _on_raw(A.post_load_checks),
    "reviews_dedup": _on_raw(lambda df: transform.dedup_reviews(transform.valid_reviews(df))),
    "reviews_analyzed": analyzed,
    "length_outliers": lambda spark, d: A.length_outliers(raw_reviews(spark, d), analyzed(spark, d)),
    "summary_statistics": _on_analyzed(A.summary_statistics),
    "sentiment_stats": _on_analyzed(lambda df: A.stats_by(df, "sentiment")),
    "length_category_distribution": _on_analyzed(lambda df: A.stats_by(df, "length_category")),
    "analyzed_rating_distribution": _on_analyzed(lambda df: A.distribution(df, "rating", ["rating"])),
    "basic_stats": _on_analyzed(A.basic_stats),
    "transform_validation": _on_analyzed(A.transform_validation),
    "data_issues": _on_analyzed(A.data_issues),
    "random_preview": _on_analyzed(A.random_preview),
    "ttest_data": _on_analyzed(transform.ttest_data),
    "length_rating_correlation": correlation,
    "sentiment_descriptive": _on_analyzed(A.sentiment_descriptive),
    "length_rating_crosstab": _on_corr(A.length_rating_crosstab),
    "quality_impact": _on_analyzed(A.quality_impact),
    "alignment_examples": _on_analyzed(A.alignment_examples),
    "executive_summary": _on_analyzed(A.executive_summary),
    "daily_trend": _on_analyzed(A.daily_trend),
    "sample_adequacy": _on_analyzed(A.sample_adequacy),
    "zscore_outliers": _on_analyzed(A.zscore_outliers),
    "validation_summary": _on_analyzed(A.validation_summary),
    "review_moments": review_moments,
    "moment_reports": lambda spark, d: cube.moment_reports(moments(spark, d)),
    "length_category_stats": _on_corr(A.length_category_stats),
}
