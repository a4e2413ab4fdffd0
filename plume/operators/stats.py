"""Hypothesis tests and correlations from distributed sufficient statistics.

S1-S13.  Each test is one aggregation (partial aggregates combine map-side)
to a one-row frame; statistics are column expressions on that row, and
p-values come from a vectorized helper applied to that single row.  No data
row reaches the driver and no global sort is needed (Spearman ranks are
computed over distinct values, not rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bins
from ..functions.columns import long_rows, prefix_before, rnd
from ..functions.stats_math import f_sf_col, t_greater_p_col, t_quantile_col, t_two_sided_p_col
from ..sources.store import shared


P_DIGITS = 8  # p-values are reported to 8 decimals


def _group_moments(df: DataFrame, value: str, group: str, a: str, b: str) -> DataFrame:
    """n, mean and sample variance of ``value`` for groups a and b, one row."""
    g, v = F.col(group), F.col(value).cast("double")

    def side(label: str, suffix: str) -> list[Column]:
        x = F.when(g == label, v)
        return [F.count(x).alias(f"n_{suffix}"), F.avg(x).alias(f"mean_{suffix}"),
                F.var_samp(x).alias(f"var_{suffix}")]
    return df.where(g.isin(a, b)).agg(*side(a, "a"), *side(b, "b"))


def t_test(df: DataFrame, value: str = "rating", group: str = "sentiment",
           a: str = "Positive", b: str = "Negative", with_p: bool = False) -> DataFrame:
    """Pooled two-sample t-test of a > b and Cohen's d.

    Output (one row): sizes, means, standard deviations, mean difference,
    t, degrees of freedom, Cohen's d with both effect labels, adequacy and
    power labels.  ``with_p`` adds the one-sided p-value, significance and
    the 95 % interval of the difference.
    """
    m = _group_moments(df, value, group, a, b)
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    dof = na + nb - 2.0
    pooled_var = ((na - 1.0) * F.col("var_a") + (nb - 1.0) * F.col("var_b")) / F.nullif(dof, F.lit(0.0))
    sp = F.sqrt(pooled_var)
    se = sp * F.sqrt(1.0 / F.nullif(na, F.lit(0.0)) + 1.0 / F.nullif(nb, F.lit(0.0)))
    diff = F.col("mean_a") - F.col("mean_b")
    t = diff / F.nullif(se, F.lit(0.0))
    d = diff / F.nullif(sp, F.lit(0.0))
    out = m.select(
        F.col("n_a").alias("n_positive"), F.col("n_b").alias("n_negative"),
        rnd("mean_a", 6).alias("mean_positive"), rnd("mean_b", 6).alias("mean_negative"),
        rnd(F.sqrt("var_a"), 6).alias("std_positive"), rnd(F.sqrt("var_b"), 6).alias("std_negative"),
        rnd(diff, 6).alias("mean_difference"), rnd(t, 6).alias("t_statistic"),
        dof.alias("degrees_of_freedom"), rnd(d, 6).alias("cohens_d"),
        rnd(se, 8).alias("standard_error"),
        bins.effect_label(d).alias("effect_size"),
        bins.effect_label_dashboard(d).alias("effect_size_dashboard"),
        ((F.col("n_a") < 30) | (F.col("n_b") < 30)).alias("small_sample_warning"),
        bins.power_label(F.least("n_a", "n_b")).alias("statistical_power"))
    if with_p:
        tcrit = t_quantile_col(0.975, F.col("degrees_of_freedom"))
        out = (out.withColumn("p_value", rnd(t_greater_p_col("t_statistic", "degrees_of_freedom"), P_DIGITS))
                  .withColumn("_tcrit", tcrit)
                  .withColumn("ci_low", rnd(F.col("mean_difference") - F.col("_tcrit") * F.col("standard_error"), 6))
                  .withColumn("ci_high", rnd(F.col("mean_difference") + F.col("_tcrit") * F.col("standard_error"), 6))
                  .withColumn("significance", bins.significance_label("p_value"))
                  .drop("_tcrit"))
    return out


def pearson(df: DataFrame, x: str, y: str, with_p: bool = False) -> DataFrame:
    """Pearson r, n, its t statistic and strength label (one row)."""
    m = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("r"))
    return _corr_row(m, with_p)


def _corr_row(m: DataFrame, with_p: bool) -> DataFrame:
    n, r = F.col("n").cast("double"), F.col("r")
    t = r * F.sqrt((n - 2.0) / F.nullif(1.0 - r * r, F.lit(0.0)))
    out = m.select("n", rnd(r, 8).alias("r"), rnd(t, 6).alias("t_statistic"),
                   (n - 2.0).alias("degrees_of_freedom"), bins.strength_label(r).alias("strength"))
    if with_p:
        out = out.withColumn("p_value", rnd(t_two_sided_p_col("t_statistic", "degrees_of_freedom"), P_DIGITS)) \
                 .withColumn("significance", bins.significance_label("p_value"))
    return out


def average_ranks(df: DataFrame, value: str, weight: str = "cnt") -> DataFrame:
    """Average (mid) rank of each distinct value of ``value``.

    ``df`` holds distinct (value, weight) counts.  The rows below each value
    come from a distributed prefix sum over the distinct values (range
    partitioned), so no task holds all values.
    """
    c = df.groupBy(value).agg(F.sum(weight).alias("_c"))
    c = prefix_before(c, [value], "_c", out="_below")
    return c.select(value, (F.col("_below") + (F.col("_c") + 1) / 2.0).alias(f"_rank_{value}"))


def spearman(df: DataFrame, x: str, y: str, with_p: bool = False) -> DataFrame:
    """Spearman rho with average ranks for ties, from value counts.

    1. count rows per distinct (x, y) pair (partial aggregation);
    2. average rank of each distinct x and y value;
    3. weighted Pearson of the ranks, centred on the known rank mean (n+1)/2
       for numerical stability.
    """
    pairs = shared(df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
                     .groupBy(x, y).agg(F.count(F.lit(1)).alias("cnt")))  # small; read by 4 branches
    rx, ry = average_ranks(pairs, x), average_ranks(pairs, y)
    total = pairs.agg(F.sum("cnt").alias("_n"))
    j = pairs.join(rx, x).join(ry, y).crossJoin(F.broadcast(total))
    mean_rank = (F.col("_n") + 1) / 2.0
    j = j.select("cnt", "_n", (F.col(f"_rank_{x}") - mean_rank).alias("_dx"),
                 (F.col(f"_rank_{y}") - mean_rank).alias("_dy"))
    c = F.col("cnt")
    m = j.agg(F.max("_n").alias("n"),
              (F.sum(c * F.col("_dx") * F.col("_dy"))
               / F.nullif(F.sqrt(F.sum(c * F.col("_dx") * F.col("_dx")) * F.sum(c * F.col("_dy") * F.col("_dy"))),
                          F.lit(0.0)))
              .alias("r"))  # all values tied: undefined, NULL like corr()
    return _corr_row(m, with_p)


def anova(df: DataFrame, value: str = "rating", group: str = "sentiment", with_p: bool = False) -> DataFrame:
    """One-way ANOVA over any number of groups (one row).

    Per-group n, mean and variance come from one grouped aggregate; the sums
    of squares are combined from those few rows.
    """
    g = df.where(F.col(value).isNotNull()).groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(value).cast("double")).alias("m"),
        F.coalesce(F.var_samp(F.col(value).cast("double")), F.lit(0.0)).alias("v"))
    tot = g.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n_total"),
                (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("gm"))
    j = g.crossJoin(F.broadcast(tot))
    s = j.groupBy("k", "n_total").agg(
        F.sum(F.col("n") * (F.col("m") - F.col("gm")) ** 2).alias("ssb"),
        F.sum((F.col("n") - 1) * F.col("v")).alias("ssw"))
    d1, d2 = (F.col("k") - 1).cast("double"), (F.col("n_total") - F.col("k")).cast("double")
    f = (F.col("ssb") / F.nullif(d1, F.lit(0.0))) / F.nullif(F.col("ssw") / F.nullif(d2, F.lit(0.0)), F.lit(0.0))
    out = s.select(F.col("k").alias("groups"), F.col("n_total").alias("n"), rnd("ssb", 6).alias("ss_between"),
                   rnd("ssw", 6).alias("ss_within"), d1.alias("df_between"), d2.alias("df_within"),
                   rnd(f, 6).alias("f_statistic"))
    if with_p:
        out = out.withColumn("p_value", rnd(f_sf_col("f_statistic", "df_between", "df_within"), P_DIGITS))
    return out


def normality(df: DataFrame, value: str = "rating", group: str = "sentiment") -> DataFrame:
    """S9 (re-aimed): Jarque-Bera on all rows of each group.

    The original ran Shapiro-Wilk on at most 5,000 sampled rows on one
    machine; JB uses skewness and excess kurtosis, which aggregate in one
    pass, and its chi-square(2) tail is exactly exp(-JB/2).
    """
    v = F.col(value).cast("double")
    g = df.where(v.isNotNull()).groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.skewness(v).alias("s"), F.kurtosis(v).alias("k"))
    jb = F.col("n") / 6.0 * (F.col("s") ** 2 + F.col("k") ** 2 / 4.0)
    return g.select(group, "n", rnd("s", 6).alias("skewness"), rnd("k", 6).alias("excess_kurtosis"),
                    rnd(jb, 4).alias("jarque_bera"), rnd(F.exp(-jb / 2.0), 8).alias("p_value"),
                    F.coalesce(F.exp(-jb / 2.0) < 0.05, F.lit(False)).alias("non_normal"))


def statistical_results(ttest: DataFrame, corr: DataFrame) -> DataFrame:
    """The six published results in long format (no clock column)."""
    t = t_test(ttest, with_p=True).select(
        "n_positive", "n_negative", "mean_positive", "mean_negative", "p_value", "cohens_d")
    p = pearson(corr, "review_length", "rating", with_p=True).select(
        F.col("r").alias("pearson_r"), F.col("p_value").alias("pearson_p"))
    j = t.crossJoin(p)
    names = ("analysis_type", "metric_name", "metric_value", "description")
    ht, ca = F.lit("Hypothesis Test"), F.lit("Correlation Analysis")
    return j.select(long_rows(
        names,
        (ht, F.lit("Positive Mean Rating"), F.col("mean_positive"),
         F.concat(F.lit("Average rating for positive sentiment reviews (n="), F.col("n_positive").cast("string"), F.lit(")"))),
        (ht, F.lit("Negative Mean Rating"), F.col("mean_negative"),
         F.concat(F.lit("Average rating for negative sentiment reviews (n="), F.col("n_negative").cast("string"), F.lit(")"))),
        (ht, F.lit("P-Value"), F.col("p_value"),
         F.lit("Statistical significance of difference between positive and negative ratings")),
        (ht, F.lit("Effect Size (Cohens D)"), F.col("cohens_d"),
         F.lit("Magnitude of difference between positive and negative ratings")),
        (ca, F.lit("Length-Rating Correlation"), F.col("pearson_r"),
         F.lit("Pearson correlation between review length and rating")),
        (ca, F.lit("Correlation P-Value"), F.col("pearson_p"),
         F.lit("Statistical significance of length-rating correlation"))))


def recommendations(ttest: DataFrame, corr: DataFrame) -> DataFrame:
    """Findings -> recommendation labels on the one-row statistics."""
    t = t_test(ttest, with_p=True)
    p = pearson(corr, "review_length", "rating", with_p=True).select(
        F.col("r").alias("pearson_r"), F.col("p_value").alias("pearson_p"))
    j = t.crossJoin(p)
    sig = F.col("p_value") < 0.05
    length_matters = (F.abs("pearson_r") > 0.1) & (F.col("pearson_p") < 0.05)
    # fixed values: the recommendation texts
    return j.select(
        F.when(sig, "Encourage satisfied users to leave detailed reviews")
         .otherwise("Focus on other factors affecting ratings").alias("sentiment_recommendation"),
        F.when(sig, F.col("mean_difference")).alias("expected_rating_impact"),
        F.when(length_matters, F.when(F.col("pearson_r") > 0, "longer").otherwise("shorter"))
         .alias("length_direction"),
        F.when(length_matters, "Optimize review length prompts")
         .otherwise("Focus on review quality over length").alias("length_recommendation"),
        F.when((F.col("n_positive") >= 30) & (F.col("n_negative") >= 30), "Adequate sample sizes")
         .otherwise("Small sample sizes").alias("confidence"),
        "statistical_power")
