"""Analysis table ``reviews_analyzed`` (B20-B36) and its two views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bins
from ..functions.columns import ntz_lit, strip_ws, word_count_space
from ..params import REVIEWS


def valid_reviews(raw: DataFrame) -> DataFrame:
    """Trimmed text of 3+ characters, rating 1..5, one of 3 sentiments."""
    return raw.where(
        F.col("review_text").isNotNull()
        & (F.length(strip_ws("review_text")) >= REVIEWS.min_text_length)
        & F.col("rating").between(1, 5)
        & F.col("sentiment").isin(*REVIEWS.valid_sentiments))


HOT_ROWS = 100_000  # rows of one text that a task takes without combining them first


def dedup_reviews(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per (text, rating, sentiment), newest ingestion first.

    Tie-break: ``app_name`` ascending (NULL first), then ``rid``.  Written
    as a grouped ``min_by`` over an ordering struct instead of ``row_number``;
    the group key is the 32-byte SHA-256 of the text instead of the text itself.

    The buffer holds strings, so the aggregate is sort-based, and combining
    map-side would sort every text before the shuffle and spill it.  Only texts
    of more than ``hot_rows`` rows, found by a count of their hashes, are
    combined there (one repeated millions of times ships one row per map task);
    the others are dealt by their hash and sorted once, a partition at a time.
    """
    keyed = df.withColumns({"_h": F.unhex(F.sha2(F.col("review_text"), 256)), "_k": F.xxhash64("review_text")})
    # at most one row per hot_rows rows of the input
    hot = F.broadcast(df.groupBy(F.xxhash64("review_text").alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
                        .where(F.col("_n") > hot_rows).select("_k"))
    cold = keyed.join(hot, "_k", "left_anti").repartition("_h")
    return _newest(cold, df.columns).unionByName(_newest(keyed.join(hot, "_k", "left_semi"), df.columns))


def _newest(keyed: DataFrame, columns: list[str]) -> DataFrame:
    key = F.struct(
        F.col("ingestion_timestamp").isNull().alias("k0"),
        (-F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ingestion_timestamp)")).alias("k1"),
        F.col("app_name").alias("k2"),
        F.col("rid").alias("k3"))
    payload = F.struct(*[F.col(c) for c in columns])
    return (keyed.groupBy("_h", "rating", "sentiment")
              .agg(F.min_by(payload, key).alias("_row"))
              .select("_row.*"))


def length_outlier_threshold(raw: DataFrame, q: float = REVIEWS.outlier_quantile,
                             exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """One-row P95 of ``review_length`` over the *raw* table (trap T6).

    Exact discrete percentile by default; its state is a value->count map,
    so memory is bounded by the number of distinct lengths, not rows.
    ``exact=False`` uses the mergeable approximate quantile sketch, like the
    original's approximate quantiles.
    """
    p = (F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY review_length)") if exact
         else F.percentile_approx("review_length", q, accuracy))
    return raw.agg(p.cast("long").alias("p95_length"))


def reviews_analyzed(raw: DataFrame, transformation_ts: dt.datetime | None = None) -> DataFrame:
    """The whole transform, B20-B33, as one plan.

    The P95 threshold is a one-row aggregate attached by a broadcast cross
    join (exactly one row, so the broadcast size is bounded).
    ``review_id`` is a SHA-256 of the dedup key, which is unique after B21;
    the clock column is only added when a time is passed.
    """
    threshold = length_outlier_threshold(raw)
    unused = ("review_length_category", "rating_category")  # not carried through the dedup's shuffle
    df = dedup_reviews(valid_reviews(raw).drop(*unused)).crossJoin(F.broadcast(threshold))
    calc_wc = word_count_space("review_text")
    r, s, n = F.col("rating"), F.col("sentiment"), F.col("review_length")
    out = df.select(
        F.sha2(F.concat_ws("|", "review_text", r.cast("string"), s), 256).alias("review_id"),
        "review_text", "sentiment", "rating", "app_name", "review_length",
        F.coalesce(calc_wc, F.col("review_word_count")).alias("word_count"),
        bins.length_category(n).alias("length_category"),
        bins.review_quality(n, "review_word_count").alias("review_quality"),
        bins.engagement_level(n).alias("engagement_level"),
        bins.rating_group(r).alias("rating_group"),
        bins.sentiment_score(s).alias("sentiment_score"),
        "sentiment_binary",
        bins.alignment(s, r).alias("sentiment_rating_alignment"),
        s.isin("Positive", "Negative").alias("include_in_ttest"),
        F.coalesce(n > F.col("p95_length"), F.lit(False)).alias("is_length_outlier"),
        "ingestion_timestamp", "data_source",
        F.when(s == "Positive", r).alias("positive_rating"),
        F.when(s == "Negative", r).alias("negative_rating"),
        F.when(s == "Neutral", r).alias("neutral_rating"),
    )
    if transformation_ts is not None:
        out = out.withColumn("transformation_timestamp", ntz_lit(transformation_ts))
    return out


def ttest_data(analyzed: DataFrame, aligned_only: bool = True) -> DataFrame:
    """Positive/Negative rows (aligned only, as in the original, trap T7)."""
    cond = F.col("include_in_ttest")
    if aligned_only:
        cond = cond & (F.col("sentiment_rating_alignment") == "Aligned")
    return analyzed.where(cond).select("sentiment", "rating", "review_length", "word_count",
                                       "sentiment_score", "length_category")


def length_rating_correlation(analyzed: DataFrame) -> DataFrame:
    """Non-outliers with the cross-tab length bin and 3-way rating category."""
    return analyzed.where(~F.col("is_length_outlier")).select(
        "review_length", "rating", "sentiment", "word_count", "length_category",
        bins.length_bin("review_length").alias("length_bin"),
        bins.rating_category_3("rating").alias("rating_category"))


def misaligned_example(c_rating: Column, c_text: Column) -> Column:
    return F.concat(F.lit("Rating: "), c_rating.cast("string"), F.lit(" | "),
                    F.substring(c_text, 1, 50), F.lit("..."))
