"""Moments of the analysis table, kept once at a fine grain and rolled up by the reports.

The grain is (day, sentiment, length category, review quality, rating): its
size is bounded by the days and the labels, not by the reviews.  Counts, sums
and sums of squares of whole numbers are exact, and all of it merges: a day's
rows are added to the table without reading the reviews of the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import rnd

GRAIN = ("analysis_date", "sentiment", "length_category", "review_quality", "rating")
_EXACT = "decimal(38,0)"
#: How each measure of a cell merges.
_MERGE = {"n": F.sum, "length_sum": F.sum, "length_squares": F.sum, "length_min": F.min, "length_max": F.max,
          "words_sum": F.sum, "words_squares": F.sum}
#: Groupings of the reports.
DIMENSIONS = {"all": (), "day": ("analysis_date",), "sentiment": ("sentiment",), "length_category": ("length_category",),
              "review_quality": ("review_quality",), "rating": ("rating",),
              "review_quality x rating": ("review_quality", "rating")}


def review_moments(analyzed: DataFrame) -> DataFrame:
    """One row a cell of ``GRAIN``: n, and sum, squares, minimum and maximum of length, sum and squares of words."""
    length, words = F.col("review_length").cast("long"), F.col("word_count").cast("long")
    exact = lambda x: F.sum(x.cast("decimal(19,0)")).cast(_EXACT)
    return analyzed.groupBy(F.to_date("ingestion_timestamp").alias("analysis_date"), *GRAIN[1:]).agg(
        F.count(F.lit(1)).alias("n"), exact(length).alias("length_sum"), exact(length * length).alias("length_squares"),
        F.min(length).alias("length_min"), F.max(length).alias("length_max"),
        exact(words).alias("words_sum"), exact(words * words).alias("words_squares"))


def rolled_up(moments: DataFrame, *keys: str) -> DataFrame:
    """The cells merged to ``keys``, with the weighted sums of the rating."""
    rating = F.col("rating")
    return moments.groupBy(*keys).agg(
        *[(how(m).cast(_EXACT) if m.endswith(("sum", "squares")) else how(m)).alias(m) for m, how in _MERGE.items()],
        F.sum(F.when(rating.isNotNull(), F.col("n"))).alias("rated"), F.sum(rating * F.col("n")).alias("rating_sum"),
        F.sum(rating * rating * F.col("n")).alias("rating_squares"))


def added(moments: DataFrame, more: DataFrame) -> DataFrame:
    """Two tables of moments as one."""
    return rolled_up(moments.unionByName(more), *GRAIN).select(*moments.columns)


def _std(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from exact whole sums."""
    wide = n.cast("decimal(19,0)")
    spread = (wide * squares).cast(_EXACT) - (total * total).cast(_EXACT)
    return F.sqrt(spread.cast("double") / F.nullif(n.cast("double") * (n - 1), F.lit(0.0)))


def _report(moments: DataFrame, dimension: str, z: float) -> DataFrame:
    keys = DIMENSIONS[dimension]
    n, m = F.col("n"), F.col("rated")
    mean = F.col("rating_sum") / m
    std = F.sqrt(F.greatest(F.lit(0.0), F.col("rating_squares") - F.col("rating_sum") * mean) / F.nullif(m - 1, F.lit(0)))
    value = F.concat_ws(" | ", *[F.col(k).cast("decimal(3,1)" if k == "rating" else "string").cast("string") for k in keys])
    return rolled_up(moments, *keys).select(
        F.lit(dimension).alias("dimension"), value.alias("value"), n.alias("count"),
        rnd(mean, 6).alias("avg_rating"), rnd(std, 6).alias("std_rating"), rnd(std / F.sqrt(m), 8).alias("standard_error"),
        rnd(mean - z * std / F.sqrt(m), 6).alias("ci_low"), rnd(mean + z * std / F.sqrt(m), 6).alias("ci_high"),
        rnd(F.col("length_sum").cast("double") / n, 6).alias("avg_length"),
        rnd(_std(n, F.col("length_sum"), F.col("length_squares")), 6).alias("std_length"),
        F.col("length_min").alias("min_length"), F.col("length_max").alias("max_length"),
        rnd(F.col("words_sum").cast("double") / n, 6).alias("avg_words"),
        rnd(_std(n, F.col("words_sum"), F.col("words_squares")), 6).alias("std_words"))


def moment_reports(moments: DataFrame, z: float = 1.96) -> DataFrame:
    """Every grouping of ``DIMENSIONS`` from the moments alone: share, mean, deviation, interval, extremes."""
    parts = [_report(moments, d, z) for d in DIMENSIONS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    total = moments.agg(F.sum("n").alias("total"))  # one row
    return out.crossJoin(F.broadcast(total)).withColumn(
        "percentage", rnd(F.col("count") * 100.0 / F.col("total"), 2)).drop("total").where("count IS NOT NULL")
