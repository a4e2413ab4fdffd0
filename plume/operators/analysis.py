"""Profiles, distributions and analysis queries over the review tables.

D1-D22, E2-E5, G1-G10.  Everything is an aggregation with map-side partial
combine; per-row outputs (z-scores) attach small per-group statistics with a
broadcast join whose size is bounded by the number of groups.  Several
filtered counts that the original wrote as scalar subqueries are folded into
one conditional aggregation (one scan instead of six).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bins
from ..functions.columns import count_if, long_rows, pct, rnd, safe_div, with_share_of_total
from ..params import REVIEWS
from ..sources.store import shared
from .transform import length_outlier_threshold, misaligned_example




# ---- raw table profile (D1-D4, G4, Q8) ------------------------------------

def raw_profile(raw: DataFrame) -> DataFrame:
    """D1."""
    return raw.agg(
        F.lit("raw_reviews").alias("table_name"),
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct("sentiment").alias("unique_sentiments"),
        F.min("rating").alias("min_rating"), F.max("rating").alias("max_rating"),
        rnd(F.avg("review_length"), 4).alias("avg_review_length"),
        F.min("ingestion_timestamp").alias("earliest_ingestion"),
        F.max("ingestion_timestamp").alias("latest_ingestion"))


def distribution(df: DataFrame, column: str, order_by=None) -> DataFrame:
    """Count and percent of total per value (optionally ordered, outermost)."""
    out = with_share_of_total(df.groupBy(column).agg(F.count(F.lit(1)).alias("count")))
    return out.orderBy(*order_by) if order_by else out


def raw_quality(raw: DataFrame) -> DataFrame:
    """Data-quality conditional counts."""
    t, r, n = F.col("review_text"), F.col("rating"), F.col("review_length")
    return raw.agg(
        F.lit("Data Quality Summary").alias("check_type"),
        F.count(F.lit(1)).alias("total_records"),
        count_if(t.isNull() | (F.length(t) == 0)).alias("empty_reviews"),
        count_if(F.col("sentiment").isNull()).alias("missing_sentiment"),
        count_if(r.isNull() | (r < 1) | (r > 5)).alias("invalid_ratings"),
        count_if(n.isNull() | (n <= 0)).alias("invalid_length"))


def preview(df: DataFrame, n: int = REVIEWS.preview_rows, order_by=("rid",)) -> DataFrame:
    """First rows in a stable order (a top-n, so each task keeps n rows)."""
    return df.orderBy(*order_by).limit(n).select(
        "review_text", "sentiment", "rating", "review_length", "review_length_category",
        "rating_category")


def post_load_checks(raw: DataFrame) -> DataFrame:
    """Q8: the five post-load checks as one long table (check, key, value)."""
    one = raw.agg(F.count(F.lit(1)).cast("double").alias("total"),
                  count_if(F.col("review_text").isNull()).cast("double").alias("null_text"),
                  F.avg("review_length").alias("avg_len"))
    none = F.lit(None).cast("string")
    head = one.select(long_rows(
        ("check_name", "check_key", "check_value"),
        (F.lit("Total Row Count"), none, F.col("total")),
        (F.lit("Null Review Text Count"), none, F.col("null_text")),
        (F.lit("Average Review Length"), none, rnd("avg_len", 4))))
    rating = raw.groupBy("rating").count().select(
        F.lit("Rating Distribution").alias("check_name"), F.col("rating").cast("string").alias("check_key"),
        F.col("count").cast("double").alias("check_value"))
    sentiment = raw.groupBy("sentiment").count().select(
        F.lit("Sentiment Distribution").alias("check_name"), F.col("sentiment").alias("check_key"),
        F.col("count").cast("double").alias("check_value"))
    return head.unionByName(rating).unionByName(sentiment)


# ---- analysis table statistics (D5-D8, G10, D17, D18, G5) ------------------

def basic_stats(df: DataFrame) -> DataFrame:
    """One row of overall statistics."""
    return df.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.countDistinct("app_name").alias("unique_apps"),
        rnd(F.avg("rating"), 6).alias("avg_rating"), rnd(F.stddev_samp("rating"), 6).alias("stddev_rating"),
        rnd(F.avg("review_length"), 6).alias("avg_review_length"),
        rnd(F.stddev_samp("review_length"), 6).alias("stddev_review_length"),
        rnd(F.avg("word_count"), 6).alias("avg_word_count"),
        F.min("rating").alias("min_rating"), F.max("rating").alias("max_rating"),
        F.min("review_length").alias("min_review_length"),
        F.max("review_length").alias("max_review_length"))


def stats_by(df: DataFrame, key: str, with_length: bool = True) -> DataFrame:
    """Count, percent, mean and sample std of rating per key."""
    aggs = [F.count(F.lit(1)).alias("count"), rnd(F.avg("rating"), 6).alias("avg_rating"),
            rnd(F.stddev_samp("rating"), 6).alias("stddev_rating")]
    if with_length:
        aggs.append(rnd(F.avg("review_length"), 6).alias("avg_length"))
    return with_share_of_total(df.groupBy(key).agg(*aggs))


def _fixed(c: Column, scale: int) -> Column:
    """Decimal text of a rounded number ('4.25', '3'), identical across engines."""
    return F.round(c.cast("decimal(38,10)"), scale).cast(f"decimal(38,{scale})").cast("string")


def summary_statistics(analyzed: DataFrame) -> DataFrame:
    """The six metric groups as one string table.

    The original unions six selects over four aggregations.  Here one
    aggregation at (sentiment, length_category, rating) grain, written once,
    feeds every group, so the analysis table is scanned once; numbers are
    printed through fixed-scale decimals so their text does not depend on
    the engine.
    """
    grain = shared(analyzed.groupBy("sentiment", "length_category", "rating").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("sum_rating"),
        F.sum("review_length").alias("sum_length")))
    overview = grain.agg(F.sum("n").alias("n"), (F.sum("sum_rating") / F.sum("n")).alias("avg_rating"),
                         (F.sum("sum_length") / F.sum("n")).alias("avg_length"))
    ov = overview.select(long_rows(
        ("metric_category", "metric_value", "description"),
        (F.lit("Dataset Overview"), F.col("n").cast("string"), F.lit("Total number of reviews analyzed")),
        (F.lit("Dataset Overview"), _fixed(F.col("avg_rating"), 2), F.lit("Average rating across all reviews")),
        (F.lit("Dataset Overview"), _fixed(F.col("avg_length"), 0), F.lit("Average review length (characters)"))))

    def dist(key: str, category: str, label: Column, desc) -> DataFrame:
        g = grain.groupBy(key).agg(F.sum("n").alias("count"), F.sum("sum_rating").alias("sr"))
        g = with_share_of_total(g)
        value = F.concat(label, F.lit(": "), F.col("count").cast("string"), F.lit(" ("),
                         _fixed(F.col("percentage"), 2), F.lit("%)"))
        description = desc if desc is not None else F.concat(
            F.lit("Average rating: "), _fixed(F.col("sr") / F.col("count"), 2))
        return g.select(F.lit(category).alias("metric_category"), value.alias("metric_value"),
                        description.alias("description"))

    return (ov.unionByName(dist("sentiment", "Sentiment Distribution", F.col("sentiment"), None))
              .unionByName(dist("length_category", "Length Category Distribution",
                                F.col("length_category"), None))
              .unionByName(dist("rating", "Rating Distribution",
                                F.concat(F.lit("Rating "), _fixed(F.col("rating"), 1)),
                                F.lit("Distribution of star ratings"))))


def transform_validation(analyzed: DataFrame) -> DataFrame:
    """D17."""
    return analyzed.agg(
        F.lit("Transformation Validation").alias("check_type"),
        F.count(F.lit(1)).alias("total_records"),
        count_if(F.col("sentiment").isin(*REVIEWS.valid_sentiments)).alias("valid_sentiment"),
        count_if(F.col("rating").between(1, 5)).alias("valid_rating"),
        count_if(F.col("review_length") > 0).alias("valid_length"),
        count_if(F.col("include_in_ttest")).alias("records_for_ttest"))


def data_issues(analyzed: DataFrame) -> DataFrame:
    """D18 (``zero_word_count`` is always 0, trap T17)."""
    s, r = F.col("sentiment"), F.col("rating")
    return analyzed.agg(
        F.lit("Data Quality Check").alias("check_type"),
        count_if(F.col("sentiment_rating_alignment") == "Misaligned").alias("misaligned_records"),
        count_if(F.col("is_length_outlier")).alias("length_outliers"),
        count_if(F.col("word_count") == 0).alias("zero_word_count"),
        rnd(F.avg(F.when(s == "Positive", r)), 2).alias("avg_positive_rating"),
        rnd(F.avg(F.when(s == "Negative", r)), 2).alias("avg_negative_rating"))


def random_preview(analyzed: DataFrame, n: int = REVIEWS.preview_rows, seed: int = 42) -> DataFrame:
    """N rows in a seeded pseudo-random order with a 100-character preview.

    The order key is a SHA-256 of (review_id, seed): reproducible, and the
    top-n keeps n rows per task before the final merge.
    """
    key = F.sha2(F.concat(F.col("review_id"), F.lit(f"|{seed}")), 256)
    return (analyzed.withColumn("_k", key).orderBy("_k").limit(n)
              .select("review_id", F.substring("review_text", 1, 100).alias("review_preview"),
                      "sentiment", "rating", "length_category", "sentiment_rating_alignment",
                      "include_in_ttest"))


# ---- analysis queries (D9-D16, E3, E5) -------------------------------------

def _disc(column: str, q: float) -> Column:
    return F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {column})")


def sentiment_descriptive(analyzed: DataFrame, exact: bool = True) -> DataFrame:
    """Descriptive statistics by sentiment over the t-test rows.

    Quartiles are exact discrete percentiles (value->count state, bounded by
    distinct values); ``exact=False`` uses the mergeable approximate sketch.
    """
    def q(c: str, p: float) -> Column:
        return _disc(c, p) if exact else F.percentile_approx(c, p, 10000)
    return (analyzed.where(F.col("include_in_ttest")).groupBy("sentiment").agg(
        F.count(F.lit(1)).alias("sample_size"),
        rnd(F.avg("rating"), 3).alias("mean_rating"),
        rnd(F.stddev_samp("rating"), 3).alias("std_rating"),
        rnd(F.min("rating"), 1).alias("min_rating"), rnd(F.max("rating"), 1).alias("max_rating"),
        rnd(q("rating", 0.25), 2).alias("q1_rating"),
        rnd(q("rating", 0.5), 2).alias("median_rating"),
        rnd(q("rating", 0.75), 2).alias("q3_rating"),
        rnd(F.avg("review_length"), 1).alias("mean_review_length"),
        rnd(F.stddev_samp("review_length"), 1).alias("std_review_length"),
        rnd(q("review_length", 0.5), 1).alias("median_review_length"),
        rnd(F.avg("word_count"), 1).alias("mean_word_count"),
        rnd(q("word_count", 0.5), 1).alias("median_word_count")).orderBy("sentiment"))


def length_rating_crosstab(corr: DataFrame) -> DataFrame:
    """Length bin x rating category with percent of total, custom order."""
    g = corr.groupBy("length_bin", "rating_category").agg(
        F.count(F.lit(1)).alias("count"), rnd(F.avg("rating"), 2).alias("avg_rating"))
    return (with_share_of_total(g, out="percentage_of_total")
             .orderBy(bins.order_rank("length_bin", bins.LENGTH_BIN_ORDER), "rating_category"))


def quality_impact(analyzed: DataFrame) -> DataFrame:
    """D11."""
    s = F.col("sentiment")
    n = F.count(F.lit(1))
    g = analyzed.groupBy("review_quality").agg(
        n.alias("review_count"), rnd(F.avg("rating"), 2).alias("avg_rating"),
        rnd(F.stddev_samp("rating"), 2).alias("rating_std"),
        rnd(pct(count_if(s == "Positive"), n), 1).alias("pct_positive"),
        rnd(pct(count_if(s == "Negative"), n), 1).alias("pct_negative"),
        rnd(pct(count_if(s == "Neutral"), n), 1).alias("pct_neutral"),
        rnd(F.avg("review_length"), 0).alias("avg_length"),
        rnd(F.avg("word_count"), 0).alias("avg_word_count"))
    return g.orderBy(bins.order_rank("review_quality", bins.QUALITY_ORDER))


def alignment_examples(analyzed: DataFrame, k: int = REVIEWS.example_count) -> DataFrame:
    """Alignment x sentiment counts with up to k misaligned examples.

    Examples are the k smallest ``review_id`` per group (stable, unlike an
    unordered LIMIT).  ``row_number() <= k`` lets Catalyst insert a partial
    WindowGroupLimit before the shuffle, so each task ships at most k rows per
    group even when one group holds most of the table.
    """
    keys = ["sentiment_rating_alignment", "sentiment"]
    counts = analyzed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"), rnd(F.avg("rating"), 2).alias("avg_rating"),
        rnd(F.avg("review_length"), 0).alias("avg_length"))
    w = Window.partitionBy(*keys).orderBy("review_id")
    ex = (analyzed.where(F.col("sentiment_rating_alignment") == "Misaligned")
                  .select(*keys, "review_id", misaligned_example(F.col("rating"), F.col("review_text")).alias("ex"))
                  .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
                  .groupBy(*keys).agg(F.array_join(F.transform(
                      F.array_sort(F.collect_list(F.struct("_rn", "ex"))), lambda x: x["ex"]), " || ")
                      .alias("misaligned_examples")))
    return counts.join(ex, keys, "left").orderBy(*keys)


def executive_summary(analyzed: DataFrame) -> DataFrame:
    """One row, nine conditional counts as percentages, readiness label."""
    s, q, r = F.col("sentiment"), F.col("review_quality"), F.col("rating")
    m = analyzed.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        rnd(F.avg("rating"), 2).alias("overall_avg_rating"),
        rnd(F.avg("review_length"), 0).alias("avg_review_length"),
        F.countDistinct("app_name").alias("apps_analyzed"),
        count_if(s == "Positive").alias("pos"), count_if(s == "Negative").alias("neg"),
        count_if(s == "Neutral").alias("neu"),
        count_if(q == "Detailed").alias("det"), count_if(q == "Moderate").alias("mod"),
        count_if(q == "Brief").alias("bri"),
        count_if(r >= 4).alias("hi"), count_if(r == 3).alias("me"), count_if(r <= 2).alias("lo"))
    t = F.col("total_reviews")

    def p(c: str) -> Column:
        return rnd(pct(c, t), 1)
    return m.select(
        "total_reviews", "overall_avg_rating", "avg_review_length", "apps_analyzed",
        p("pos").alias("pct_positive"), p("neg").alias("pct_negative"), p("neu").alias("pct_neutral"),
        p("det").alias("pct_detailed"), p("mod").alias("pct_moderate"), p("bri").alias("pct_brief"),
        p("hi").alias("pct_high_ratings"), p("me").alias("pct_medium_ratings"),
        p("lo").alias("pct_low_ratings"),
        F.when((F.col("pos") >= 30) & (F.col("neg") >= 30), "Sufficient for T-test")
         .otherwise("Insufficient sample size").alias("statistical_readiness"))


def daily_trend(analyzed: DataFrame) -> DataFrame:
    """D14."""
    s = F.col("sentiment")
    n = F.count(F.lit(1))
    return (analyzed.groupBy(F.to_date("ingestion_timestamp").alias("analysis_date")).agg(
        n.alias("daily_reviews"), rnd(F.avg("rating"), 2).alias("daily_avg_rating"),
        rnd(F.avg("review_length"), 0).alias("daily_avg_length"),
        rnd(pct(count_if(s == "Positive"), n), 1).alias("daily_pct_positive"),
        rnd(pct(count_if(s == "Negative"), n), 1).alias("daily_pct_negative"))
        .orderBy(F.desc("analysis_date")))


def sample_adequacy(analyzed: DataFrame) -> DataFrame:
    """Per-sentiment size and mean, LAG difference over sentiment descending."""
    g = analyzed.where(F.col("include_in_ttest")).groupBy("sentiment").agg(
        F.count(F.lit(1)).alias("sample_size"), rnd(F.avg("rating"), 3).alias("mean_rating"),
        rnd(F.stddev_samp("rating"), 3).alias("std_rating"))
    w = Window.orderBy(F.desc("sentiment"))
    return g.select(
        "sentiment", "sample_size", "mean_rating", "std_rating",
        rnd(F.col("mean_rating") - F.lag("mean_rating").over(w), 3).alias("mean_difference"),
        bins.adequacy_label("sample_size").alias("statistical_adequacy")).orderBy(F.desc("sentiment"))


def zscore_outliers(analyzed: DataFrame, by: str = "sentiment", threshold: float = REVIEWS.zscore_threshold) -> DataFrame:
    """Z-scores of rating and length within sentiment, outlier flag.

    Semantics of ``AVG/STDDEV OVER (PARTITION BY sentiment)``, planned as a
    group aggregate joined back: a window would put every row of a group into
    one task.  Cleaning leaves three sentiments, so the statistics by sentiment
    have three rows at most and are broadcast; for any other ``by`` the join
    is left to AQE.
    """
    base = analyzed.where(F.col("include_in_ttest"))
    st = base.groupBy(by).agg(
        F.avg("rating").alias("_mr"), F.nullif(F.stddev_samp("rating"), F.lit(0.0)).alias("_sr"),
        F.avg("review_length").alias("_ml"),
        F.nullif(F.stddev_samp("review_length"), F.lit(0.0)).alias("_sl"))
    z_r = (F.col("rating") - F.col("_mr")) / F.col("_sr")
    z_l = (F.col("review_length") - F.col("_ml")) / F.col("_sl")
    out = base.join(F.broadcast(st) if by == "sentiment" else st, by).select(
        by, "rating", "review_length", rnd(z_r, 2).alias("rating_zscore"),
        rnd(z_l, 2).alias("length_zscore"),
        F.coalesce(F.abs(z_r) > threshold, F.lit(False)).alias("is_rating_outlier"),
        "review_text")
    return out.orderBy(by, F.abs(F.col("rating_zscore")).desc_nulls_last())


def validation_summary(analyzed: DataFrame) -> DataFrame:
    """The six scalar subqueries as one conditional aggregation."""
    s, t = F.col("sentiment"), F.col("include_in_ttest")
    m = analyzed.agg(
        count_if((s == "Positive") & t).alias("positive_sample_size"),
        count_if((s == "Negative") & t).alias("negative_sample_size"),
        count_if(F.col("sentiment_rating_alignment") == "Aligned").alias("aligned_records"),
        count_if(~F.col("is_length_outlier")).alias("non_outlier_records"))
    return m.select(
        F.lit("Data Validation Summary").alias("validation_type"), "*",
        F.when((F.col("positive_sample_size") >= 30) & (F.col("negative_sample_size") >= 30),
               "READY FOR STATISTICAL ANALYSIS").otherwise("NEED MORE DATA").alias("analysis_readiness"))


def length_category_stats(corr: DataFrame) -> DataFrame:
    """Count, mean and std of rating per length category (3 decimals)."""
    return corr.groupBy("length_category").agg(
        F.count(F.lit(1)).alias("count"), rnd(F.avg("rating"), 3).alias("mean"),
        rnd(F.stddev_samp("rating"), 3).alias("std"))


def length_outliers(raw: DataFrame, analyzed: DataFrame) -> DataFrame:
    """B28 summary: the raw P95 and how many analysis rows exceed it."""
    t = length_outlier_threshold(raw)
    c = analyzed.agg(count_if(F.col("is_length_outlier")).alias("outliers"),
                     F.count(F.lit(1)).alias("total"))
    return t.crossJoin(c).select("p95_length", "outliers", "total",
                                 rnd(safe_div(F.col("outliers") * 100.0, "total"), 4).alias("outlier_pct"))
