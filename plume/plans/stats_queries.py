"""Statistics queries (S1-S13) over the review views."""

from __future__ import annotations


from ..operators import stats, transform
from . import reviews


def _ttest(spark, d):
    return transform.ttest_data(reviews.analyzed(spark, d))


def _ttest_unaligned(spark, d):
    return transform.ttest_data(reviews.analyzed(spark, d), aligned_only=False)


QUERIES = {
    "t_test": lambda s, d: stats.t_test(_ttest(s, d)),
    "t_test_unaligned": lambda s, d: stats.t_test(_ttest_unaligned(s, d)),
    "pearson": lambda s, d: stats.pearson(reviews.correlation(s, d), "review_length", "rating"),
    "word_count_pearson": lambda s, d: stats.pearson(reviews.correlation(s, d), "word_count", "rating"),
    "spearman": lambda s, d: stats.spearman(reviews.correlation(s, d), "review_length", "rating"),
    "anova": lambda s, d: stats.anova(_ttest(s, d)),
    "anova_all_sentiments": lambda s, d: stats.anova(reviews.analyzed(s, d)),
    "normality": lambda s, d: stats.normality(_ttest(s, d)),
    # p-values: the oracle evaluates the incomplete beta as a recursive query;
    # independent values (closed forms, normal limits) are unit tests.
    "t_test_inference": lambda s, d: stats.t_test(_ttest(s, d), with_p=True),
    "pearson_inference": lambda s, d: stats.pearson(reviews.correlation(s, d), "review_length", "rating", with_p=True),
    "spearman_inference": lambda s, d: stats.spearman(reviews.correlation(s, d), "review_length", "rating", with_p=True),
    "word_count_pearson_inference": lambda s, d: stats.pearson(reviews.correlation(s, d), "word_count", "rating", with_p=True),
    "anova_inference": lambda s, d: stats.anova(_ttest(s, d), with_p=True),
    "statistical_results": lambda s, d: stats.statistical_results(_ttest(s, d), reviews.correlation(s, d)),
    "recommendations": lambda s, d: stats.recommendations(_ttest(s, d), reviews.correlation(s, d)),
}
