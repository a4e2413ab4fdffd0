"""DuckDB oracle SQL for the statistics queries.

p-values use the incomplete beta of ``oracle_betainc`` (a recursive CTE),
evaluated on the same rounded statistics as the Spark side.
"""

from __future__ import annotations

from .oracle_betainc import betainc_ctes, t_quantile_ctes
from .oracle_reviews import ANALYZED_SQL, _with, rnd


def _effect(d: str) -> str:
    return (f"CASE WHEN {d} IS NULL THEN NULL WHEN abs({d}) < 0.2 THEN 'negligible' WHEN abs({d}) < 0.5 THEN 'small' "
            f"WHEN abs({d}) < 0.8 THEN 'medium' ELSE 'large' END")


def _effect_dash(d: str) -> str:
    return (f"CASE WHEN {d} IS NULL THEN NULL WHEN abs({d}) > 0.5 THEN 'Large effect' "
            f"WHEN abs({d}) > 0.2 THEN 'Medium effect' ELSE 'Small effect' END")


def _t_test(source: str) -> str:
    return _with(_t_test_body(source))


def _t_test_body(source: str) -> str:
    sp = "sqrt(((n_a - 1) * var_a + (n_b - 1) * var_b) / NULLIF(n_a + n_b - 2.0, 0))"
    se = f"({sp} * sqrt(1.0 / n_a + 1.0 / n_b))"
    d = f"((mean_a - mean_b) / NULLIF({sp}, 0))"
    return (f"""
SELECT n_a AS n_positive, n_b AS n_negative, {rnd('mean_a', 6)} AS mean_positive, {rnd('mean_b', 6)} AS mean_negative,
  {rnd('sqrt(var_a)', 6)} AS std_positive, {rnd('sqrt(var_b)', 6)} AS std_negative,
  {rnd('mean_a - mean_b', 6)} AS mean_difference,
  {rnd(f'(mean_a - mean_b) / NULLIF({se}, 0)', 6)} AS t_statistic,
  CAST(n_a + n_b - 2 AS DOUBLE) AS degrees_of_freedom, {rnd(d, 6)} AS cohens_d,
  {rnd(se, 8)} AS standard_error, {_effect(d)} AS effect_size, {_effect_dash(d)} AS effect_size_dashboard,
  (n_a < 30 OR n_b < 30) AS small_sample_warning,
  CASE WHEN least(n_a, n_b) > 100 THEN 'High' ELSE 'Moderate' END AS statistical_power
FROM (SELECT count(CASE WHEN sentiment = 'Positive' THEN rating END) AS n_a,
        avg(CASE WHEN sentiment = 'Positive' THEN rating END) AS mean_a,
        var_samp(CASE WHEN sentiment = 'Positive' THEN rating END) AS var_a,
        count(CASE WHEN sentiment = 'Negative' THEN rating END) AS n_b,
        avg(CASE WHEN sentiment = 'Negative' THEN rating END) AS mean_b,
        var_samp(CASE WHEN sentiment = 'Negative' THEN rating END) AS var_b
      FROM {source} WHERE sentiment IN ('Positive', 'Negative'))""")


def _strength(r: str) -> str:
    return (f"CASE WHEN {r} IS NULL THEN NULL WHEN abs({r}) < 0.1 THEN 'negligible' WHEN abs({r}) < 0.3 THEN 'weak' "
            f"WHEN abs({r}) < 0.5 THEN 'moderate' WHEN abs({r}) < 0.7 THEN 'strong' ELSE 'very strong' END")


def _corr_select(inner: str) -> str:
    return _with(_corr_body(inner))


def _corr_body(inner: str) -> str:
    t = "r * sqrt((n - 2.0) / NULLIF(1.0 - r * r, 0))"
    return (f"""
SELECT n, {rnd('r', 8)} AS r, {rnd(t, 6)} AS t_statistic, CAST(n - 2 AS DOUBLE) AS degrees_of_freedom,
  {_strength('r')} AS strength
FROM ({inner})""")


def _pearson_inner(x: str, y: str) -> str:
    return (f"SELECT count(*) AS n, corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)) AS r "
            f"FROM length_rating_correlation WHERE {x} IS NOT NULL AND {y} IS NOT NULL")


def _pearson(x: str, y: str) -> str:
    return _corr_select(_pearson_inner(x, y))


def _spearman_inner(x: str, y: str) -> str:
    return f"""
SELECT count(*) AS n, corr(rx, ry) AS r FROM (
  SELECT rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2.0 AS rx,
         rank() OVER (ORDER BY {y}) + (count(*) OVER (PARTITION BY {y}) - 1) / 2.0 AS ry
  FROM length_rating_correlation WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"""


def _spearman(x: str, y: str) -> str:
    return _corr_select(_spearman_inner(x, y))


def _anova(source: str) -> str:
    return _with(_anova_body(source))


def _anova_body(source: str) -> str:
    return (f"""
SELECT k AS groups, n_total AS n, {rnd('ssb', 6)} AS ss_between, {rnd('ssw', 6)} AS ss_within,
  CAST(k - 1 AS DOUBLE) AS df_between, CAST(n_total - k AS DOUBLE) AS df_within,
  {rnd('(ssb / NULLIF(k - 1.0, 0)) / NULLIF(ssw / NULLIF(n_total - k + 0.0, 0), 0)', 6)} AS f_statistic
FROM (SELECT k, n_total, sum(n * (m - gm) * (m - gm)) AS ssb, sum((n - 1) * v) AS ssw
      FROM (SELECT g.*, t.* FROM
              (SELECT sentiment, count(*) AS n, avg(CAST(rating AS DOUBLE)) AS m,
                      coalesce(var_samp(CAST(rating AS DOUBLE)), 0.0) AS v
               FROM {source} WHERE rating IS NOT NULL GROUP BY sentiment) g
            CROSS JOIN (SELECT count(*) AS k, CAST(sum(n) AS BIGINT) AS n_total, sum(n * m) / sum(n) AS gm FROM
              (SELECT count(*) AS n, avg(CAST(rating AS DOUBLE)) AS m FROM {source}
               WHERE rating IS NOT NULL GROUP BY sentiment)) t)
      GROUP BY k, n_total)""")


_JB = "(n / 6.0 * (s * s + k * k / 4.0))"

SQL = {
    "t_test": _t_test("ttest_data"),
    "t_test_unaligned": _t_test("(SELECT * FROM reviews_analyzed WHERE include_in_ttest)"),
    "pearson": _pearson("review_length", "rating"),
    "word_count_pearson": _pearson("word_count", "rating"),
    "spearman": _spearman("review_length", "rating"),
    "anova": _anova("ttest_data"),
    "anova_all_sentiments": _anova("reviews_analyzed"),
    "normality": _with(f"""
SELECT sentiment, n, {rnd('s', 6)} AS skewness, {rnd('k', 6)} AS excess_kurtosis, {rnd(_JB, 4)} AS jarque_bera,
  {rnd(f'exp(-{_JB} / 2.0)', 8)} AS p_value, coalesce(exp(-{_JB} / 2.0) < 0.05, false) AS non_normal
FROM (SELECT sentiment, n, avg(power(x - mu, 3)) / NULLIF(power(avg(power(x - mu, 2)), 1.5), 0) AS s,
             avg(power(x - mu, 4)) / NULLIF(power(avg(power(x - mu, 2)), 2), 0) - 3 AS k
      FROM (SELECT sentiment, CAST(rating AS DOUBLE) AS x, avg(rating) OVER (PARTITION BY sentiment) AS mu,
                   count(*) OVER (PARTITION BY sentiment) AS n
            FROM ttest_data WHERE rating IS NOT NULL)
      GROUP BY sentiment, n)"""),
}


# ---- p-values -----------------------------------------------------------------

def _rec(ctes: str, body: str) -> str:
    return f"WITH RECURSIVE {ANALYZED_SQL.strip()},{ctes}\n{body}"


def _sig(p: str) -> str:
    return f"CASE WHEN {p} < 0.05 THEN 'Significant' ELSE 'Not Significant' END"


_TT = f"tt AS ({_t_test_body('ttest_data')})"
_PC = f"pc AS ({_corr_body(_pearson_inner('review_length', 'rating'))})"
# tails: 1 = t-test (one-sided greater), 2 = Pearson (two-sided)
_PV = """
pv_src AS (
  SELECT 1 AS id, degrees_of_freedom / 2.0 AS a, 0.5 AS b,
         degrees_of_freedom / (degrees_of_freedom + t_statistic * t_statistic) AS x FROM tt
  UNION ALL
  SELECT 2, degrees_of_freedom / 2.0, 0.5,
         degrees_of_freedom / (degrees_of_freedom + t_statistic * t_statistic) FROM pc
),""" + betainc_ctes("pv_src", "pv") + f""",
p AS (
  SELECT {rnd("(SELECT CASE WHEN tt.t_statistic > 0 THEN ix / 2.0 ELSE 1.0 - ix / 2.0 END FROM pv, tt WHERE pv.id = 1)", 8)} AS t_p,
         {rnd("(SELECT ix FROM pv WHERE id = 2)", 8)} AS r_p
)"""

SQL["pearson_inference"] = _rec(",".join([_PC, _TT, _PV]), f"""
SELECT pc.*, p.r_p AS p_value, {_sig('p.r_p')} AS significance FROM pc CROSS JOIN p""")



def _corr_inference(inner: str) -> str:
    """A correlation row with its two-sided p-value and label."""
    return _rec(f"cr AS ({_corr_body(inner)})," + """
cr_src AS (SELECT 1 AS id, degrees_of_freedom / 2.0 AS a, 0.5 AS b,
                  degrees_of_freedom / (degrees_of_freedom + t_statistic * t_statistic) AS x FROM cr),"""
                + betainc_ctes("cr_src", "cv") + f""",
cp AS (SELECT {rnd('(SELECT ix FROM cv WHERE id = 1)', 8)} AS p)""",
                f"SELECT cr.*, cp.p AS p_value, {_sig('cp.p')} AS significance FROM cr CROSS JOIN cp")


SQL["word_count_pearson_inference"] = _corr_inference(_pearson_inner("word_count", "rating"))
SQL["spearman_inference"] = _corr_inference(_spearman_inner("review_length", "rating"))

SQL["anova_inference"] = _rec(f"""
an AS ({_anova_body('ttest_data')}),
av_src AS (SELECT 1 AS id, df_within / 2.0 AS a, df_between / 2.0 AS b,
                  df_within / (df_within + df_between * f_statistic) AS x FROM an),""" + betainc_ctes("av_src", "av"),
    f"""
SELECT an.*, {rnd('av.ix', 8)} AS p_value FROM an LEFT JOIN av ON av.id = 1""")

_RESULTS = f"""
SELECT 'Hypothesis Test' AS analysis_type, 'Positive Mean Rating' AS metric_name, mean_positive AS metric_value,
  'Average rating for positive sentiment reviews (n=' || CAST(n_positive AS VARCHAR) || ')' AS description FROM tt
UNION ALL SELECT 'Hypothesis Test', 'Negative Mean Rating', mean_negative,
  'Average rating for negative sentiment reviews (n=' || CAST(n_negative AS VARCHAR) || ')' FROM tt
UNION ALL SELECT 'Hypothesis Test', 'P-Value', t_p,
  'Statistical significance of difference between positive and negative ratings' FROM p
UNION ALL SELECT 'Hypothesis Test', 'Effect Size (Cohens D)', cohens_d,
  'Magnitude of difference between positive and negative ratings' FROM tt
UNION ALL SELECT 'Correlation Analysis', 'Length-Rating Correlation', r,
  'Pearson correlation between review length and rating' FROM pc
UNION ALL SELECT 'Correlation Analysis', 'Correlation P-Value', r_p,
  'Statistical significance of length-rating correlation' FROM p"""

SQL["statistical_results"] = _rec(",".join([_TT, _PC, _PV]), _RESULTS)

SQL["recommendations"] = _rec(",".join([_TT, _PC, _PV]), """
SELECT CASE WHEN t_p < 0.05 THEN 'Encourage satisfied users to leave detailed reviews'
            ELSE 'Focus on other factors affecting ratings' END AS sentiment_recommendation,
  CASE WHEN t_p < 0.05 THEN mean_difference END AS expected_rating_impact,
  CASE WHEN abs(r) > 0.1 AND r_p < 0.05 THEN CASE WHEN r > 0 THEN 'longer' ELSE 'shorter' END END
    AS length_direction,
  CASE WHEN abs(r) > 0.1 AND r_p < 0.05 THEN 'Optimize review length prompts'
       ELSE 'Focus on review quality over length' END AS length_recommendation,
  CASE WHEN n_positive >= 30 AND n_negative >= 30 THEN 'Adequate sample sizes' ELSE 'Small sample sizes' END
    AS confidence,
  statistical_power
FROM tt CROSS JOIN pc CROSS JOIN p""")


def _dash(d: str) -> str:
    return (f"CASE WHEN {d} IS NULL THEN NULL WHEN abs({d}) > 0.5 THEN 'Large effect' "
            f"WHEN abs({d}) > 0.2 THEN 'Medium effect' ELSE 'Small effect' END")


SQL["kpi_cards"] = _rec(",".join([_TT, _PC, _PV]) + f""",
res AS ({_RESULTS}),
cards AS (
  SELECT max(CASE WHEN metric_name = 'Positive Mean Rating' THEN metric_value END) AS pos_mean,
         max(CASE WHEN metric_name = 'Negative Mean Rating' THEN metric_value END) AS neg_mean,
         max(CASE WHEN metric_name = 'P-Value' THEN metric_value END) AS p_value,
         max(CASE WHEN metric_name = 'Effect Size (Cohens D)' THEN metric_value END) AS cohens_d
  FROM res
)""", f"""
SELECT (SELECT count(*) FROM reviews_analyzed) AS total_reviews, p_value,
  CASE WHEN p_value < 0.001 THEN 'p < 0.001' ELSE printf('%.3f', p_value) END AS p_value_text,
  {_sig('p_value')} AS significance, {rnd('cohens_d', 3)} AS cohens_d, {_dash('cohens_d')} AS effect_label,
  {rnd('pos_mean - neg_mean', 2)} AS mean_difference,
  CASE WHEN pos_mean - neg_mean >= 0 THEN '+' ELSE '' END || printf('%.2f', pos_mean - neg_mean) || ' stars'
    AS mean_difference_text
FROM cards""")

SQL["t_test_inference"] = _rec(",".join([_TT, _PC, _PV]) + """,
tq_src AS (SELECT 1 AS id, degrees_of_freedom AS df FROM tt),""" + t_quantile_ctes("tq_src", "tq"), f"""
SELECT tt.*, p.t_p AS p_value,
  {rnd('tt.mean_difference - tq.t * tt.standard_error', 6)} AS ci_low,
  {rnd('tt.mean_difference + tq.t * tt.standard_error', 6)} AS ci_high,
  {_sig('p.t_p')} AS significance
FROM tt CROSS JOIN p LEFT JOIN tq ON tq.id = 1""")
