"""Dashboard feeds (V1-V8): the tables behind each chart, not the drawing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bins
from ..functions.columns import count_if, pct, rnd


def kpi_cards(results: DataFrame, analyzed: DataFrame) -> DataFrame:
    """V1: total reviews, p-value, effect size and mean difference in one row.

    The mean difference is not stored in the results table; it is derived
    from the two stored means.
    """
    r = results.groupBy().pivot("metric_name", ["Positive Mean Rating", "Negative Mean Rating", "P-Value",
                                                "Effect Size (Cohens D)"]).agg(F.first("metric_value"))
    r = r.toDF("pos_mean", "neg_mean", "p_value", "cohens_d")
    n = analyzed.agg(F.count(F.lit(1)).alias("total_reviews"))
    diff = F.col("pos_mean") - F.col("neg_mean")
    return n.crossJoin(r).select(
        "total_reviews", "p_value",
        F.when(F.col("p_value") < 0.001, "p < 0.001").otherwise(F.format_number("p_value", 3)).alias("p_value_text"),
        bins.significance_label("p_value").alias("significance"),
        rnd("cohens_d", 3).alias("cohens_d"), bins.effect_label_dashboard("cohens_d").alias("effect_label"),
        rnd(diff, 2).alias("mean_difference"),
        F.concat(F.when(diff >= 0, "+").otherwise(""), F.format_number(diff, 2), F.lit(" stars"))
        .alias("mean_difference_text"))


def rating_by_sentiment(analyzed: DataFrame) -> DataFrame:
    """V2: average rating, count and standard error of the mean per sentiment."""
    return analyzed.groupBy("sentiment").agg(
        rnd(F.avg("rating"), 6).alias("avg_rating"), F.count(F.lit(1)).alias("count"),
        rnd(F.stddev_samp("rating") / F.sqrt(F.count(F.lit(1))), 8).alias("standard_error"))


def _unit_hash(key: str, seed: int):
    """First 32 bits of SHA-256(key|seed) as an integer in [0, 2^32)."""
    return F.conv(F.substring(F.sha2(F.concat(F.col(key), F.lit(f"|{seed}")), 256), 1, 8), 16, 10).cast("long")


def scatter_sample(analyzed: DataFrame, fraction: float = 0.1, seed: int = 42, key: str = "review_id") -> DataFrame:
    """10 % sample (the sample is the feature; it has no cap, see ``scatter_grid`` for all rows).

    A Bernoulli sample decided per row by a seeded hash of its id, so the
    same rows come back however the data is partitioned or retried.
    """
    h = _unit_hash(key, seed)
    return (analyzed.where(F.col("review_length").isNotNull())
                    .where(h < F.lit(int(fraction * 2 ** 32)))
                    .select("review_length", "rating", "sentiment"))


def scatter_grid(analyzed: DataFrame) -> DataFrame:
    """V3: all rows of the scatter plot, as counts per (length, rating, sentiment)."""
    return (analyzed.where(F.col("review_length").isNotNull())
                    .groupBy("review_length", "rating", "sentiment").agg(F.count(F.lit(1)).alias("reviews")))


def scatter_trend(corr: DataFrame) -> DataFrame:
    """V3: least-squares trend line and r of rating on length, over all rows."""
    return corr.agg(
        F.count(F.lit(1)).alias("n"),
        rnd(F.regr_slope("rating", "review_length"), 10).alias("slope"),
        rnd(F.regr_intercept("rating", "review_length"), 8).alias("intercept"),
        rnd(F.corr("review_length", "rating"), 8).alias("r"))


def box_plot(ttest: DataFrame, value: str = "rating", by: str = "sentiment", z: float = 1.96) -> DataFrame:
    """V4: quartiles, 1.5 IQR whiskers, outlier count, mean with interval.

    Everything follows from one count per (group, value): data rows are
    aggregated once and never joined.
    """
    f, v = F.col("f"), F.col(value)
    vc = ttest.groupBy(by, value).agg(F.count(F.lit(1)).alias("f"))
    g = vc.groupBy(by).agg(
        F.percentile(value, [0.25, 0.5, 0.75], F.when(v.isNotNull(), f).otherwise(0)).alias("q"),
        F.sum("f").alias("n"), F.sum(F.when(v.isNotNull(), f)).alias("m"), F.sum(v * f).alias("s"),
        F.collect_list(F.struct(v.alias("v"), f.alias("f"))).alias("values"))  # distinct values of one group
    g = g.where(F.col("m") > 0).select(
        by, "n", "m", "values", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"),
        (F.col("s") / F.col("m")).alias("mean"))
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    inside = lambda x: (x["v"] >= lo) & (x["v"] <= hi)
    zero = F.lit(0.0)
    squares = F.aggregate("values", zero, lambda a, x: a + F.coalesce((x["v"] - F.col("mean")) ** 2 * x["f"], zero))
    kept = F.transform(F.filter("values", inside), lambda x: x["v"])
    outside = F.aggregate("values", F.lit(0).cast("long"), lambda a, x: a + F.when(~inside(x), x["f"]).otherwise(0))
    sd = F.sqrt(squares / F.nullif(F.col("m") - 1, F.lit(0)))
    se = sd / F.sqrt("n")
    return g.select(by, "n", rnd("q1", 6).alias("q1"), rnd("median", 6).alias("median"), rnd("q3", 6).alias("q3"),
                    rnd(F.array_min(kept), 6).alias("lower_whisker"), rnd(F.array_max(kept), 6).alias("upper_whisker"),
                    outside.alias("outliers"), rnd("mean", 6).alias("mean"),
                    rnd(F.col("mean") - z * se, 6).alias("mean_ci_low"),
                    rnd(F.col("mean") + z * se, 6).alias("mean_ci_high"))


def quality_stack(analyzed: DataFrame) -> DataFrame:
    """V5: review quality x rating category, share within each quality level."""
    cat = F.when(F.col("rating") <= 2, "Low").when(F.col("rating") == 3, "Medium").otherwise("High")
    g = analyzed.groupBy("review_quality", cat.alias("rating_category")).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy("review_quality"))
    return g.withColumn("share_pct", rnd(pct("count", total), 4))


def mean_ci(analyzed: DataFrame, by: str = "sentiment", z: float = 1.96) -> DataFrame:
    """V6: mean rating with a normal 95 % interval per group (z = 1.96, our choice)."""
    g = analyzed.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.avg("rating").alias("m"),
                                 F.stddev_samp("rating").alias("sd"))
    se = F.col("sd") / F.sqrt("n")
    return g.select(by, "n", rnd("m", 6).alias("mean_rating"), rnd("sd", 6).alias("std_rating"),
                    rnd(se, 8).alias("standard_error"), rnd(F.col("m") - z * se, 6).alias("ci_low"),
                    rnd(F.col("m") + z * se, 6).alias("ci_high"))


def filter_reviews(analyzed: DataFrame, sentiments=None, rating_range=None, length_categories=None,
                   date_range=None) -> DataFrame:
    """V7: the dashboard's filter controls as one parameterized predicate."""
    cond = F.lit(True)
    if sentiments:
        cond = cond & F.col("sentiment").isin(*sentiments)
    if rating_range:
        cond = cond & F.col("rating").between(*rating_range)
    if length_categories:
        cond = cond & F.col("length_category").isin(*length_categories)
    if date_range:
        cond = cond & F.to_date("ingestion_timestamp").between(F.lit(date_range[0]), F.lit(date_range[1]))
    return analyzed.where(cond)


def drill_down(analyzed: DataFrame, key: str = "sentiment", n: int = 3) -> DataFrame:
    """V7: n sample reviews per group in a stable order (row_number <= n, limited before the shuffle)."""
    w = Window.partitionBy(key).orderBy("review_id")
    return (analyzed.select(key, "review_id", F.substring("review_text", 1, 100).alias("review_preview"), "rating")
                    .withColumn("sample_rank", F.row_number().over(w)).where(F.col("sample_rank") <= n))


def kpi_weekly(analyzed: DataFrame) -> DataFrame:
    """V8: weekly volume, mean length, % positive, % longer than 100 characters, sentiment volatility."""
    wk = F.to_date(F.date_trunc("week", F.col("ingestion_timestamp")))
    n = F.count(F.lit(1))
    return analyzed.groupBy(wk.alias("week_start")).agg(
        n.alias("review_volume"), rnd(F.avg("review_length"), 4).alias("avg_length"),
        rnd(pct(count_if(F.col("sentiment") == "Positive"), n), 4).alias("pct_positive"),
        rnd(pct(count_if(F.col("review_length") > 100), n), 4).alias("pct_long_reviews"),
        rnd(F.stddev_samp("sentiment_score"), 6).alias("sentiment_volatility"))


def capped_sample(df: DataFrame, by: str, cap: int = 5000, seed: int = 42, key: str = "review_id") -> DataFrame:
    """A sample of ``cap`` rows per group in a seeded pseudo-random order (the sample is the feature).

    The order is a SHA-256 of (key, seed), so the sample is reproducible.  The
    hash of each group's ``cap``-th row is found by two counting passes over
    16 bits of the hash each; rows below it are taken by a filter.  Only rows
    that share all 32 bits with it are ranked, one in four thousand million of
    a group, so no task ranks a group however large it is.
    """
    rows = df.withColumn("_k", F.sha2(F.concat(F.col(key), F.lit(f"|{seed}")), 256))
    rows = rows.withColumns({f"_d{i}": F.conv(F.substring("_k", 1 + 4 * i, 4), 16, 10).cast("int") for i in (0, 1)})
    group = F.col(by).alias("_by")
    high = _crossing(rows.groupBy(group, F.col("_d0").alias("_cell")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_need", F.lit(cap)))
    high = high.select("_by", F.col("_cell").alias("_c0"), F.col("_left").alias("_need"))
    inside = rows.join(high, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_d0") == F.col("_c0")))
    low = _crossing(inside.groupBy("_by", "_c0", F.col("_d1").alias("_cell"), "_need").agg(F.count(F.lit(1)).alias("_n")))
    cut = low.select("_by", "_c0", F.col("_cell").alias("_c1"), "_left")
    placed = rows.join(cut, F.col(by).eqNullSafe(F.col("_by")), "left")
    at = F.struct("_d0", "_d1")
    edge = F.struct(F.col("_c0").alias("_d0"), F.col("_c1").alias("_d1"))
    below = placed.where(F.col("_c0").isNull() | (at < edge))
    order = Window.partitionBy(by).orderBy("_k", key)
    on_edge = placed.where(at == edge).withColumn("_rn", F.row_number().over(order)) \
        .where((F.col("_rn") <= cap) & (F.col("_rn") <= F.col("_left")))
    return below.select(*df.columns).unionByName(on_edge.select(*df.columns))


def _crossing(counts: DataFrame) -> DataFrame:
    """Of every group the cell in which its ``_need``-th row lies, and how many of that cell's rows are needed (``_left``).

    Groups with fewer rows have none.  A group has at most 65,536 cells.
    """
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_by").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.withColumn("_before", before).where("_before < _need AND _need <= _before + _n") \
        .withColumn("_left", F.col("_need") - F.col("_before")).drop("_before", "_n", "_need")
