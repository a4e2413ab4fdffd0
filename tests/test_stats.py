"""Statistics against closed forms and brute force (SURVEY section 5 (c))."""

import math
import random

import pandas as pd
import pytest

from plume.functions import stats_math as M
from plume.operators import stats


def _df(spark, rows):
    return spark.createDataFrame(rows, "sentiment string, rating double, review_length long")


def test_tails_against_known_values():
    assert abs(M.t_two_sided_p(2.0, 10) - 0.0733880347707) < 1e-9
    assert abs(M.f_sf(4.0, 2, 20) - 0.0345716130336) < 1e-9
    assert abs(M.t_quantile(0.975, 10) - 2.2281388519862) < 1e-7
    assert abs(M.t_greater_p(-1.0, 5) - (1 - M.t_two_sided_p(1.0, 5) / 2)) < 1e-12
    assert abs(M.betainc(2.0, 3.0, 0.4) - 0.5248) < 1e-12   # closed form 6x^2-8x^3+3x^4


def test_t_test_matches_pooled_formula_and_anova(spark):
    random.seed(1)
    pos = [random.choice([4.0, 4.5, 5.0]) for _ in range(60)]
    neg = [random.choice([1.0, 1.5, 2.0, 3.0]) for _ in range(45)]
    df = _df(spark, [("Positive", x, 10) for x in pos] + [("Negative", x, 10) for x in neg])
    r = stats.t_test(df, with_p=True).first()
    n1, n2 = len(pos), len(neg)
    m1, m2 = sum(pos) / n1, sum(neg) / n2
    v1 = sum((x - m1) ** 2 for x in pos) / (n1 - 1)
    v2 = sum((x - m2) ** 2 for x in neg) / (n2 - 1)
    sp = math.sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2))
    t = (m1 - m2) / (sp * math.sqrt(1 / n1 + 1 / n2))
    assert abs(r.t_statistic - t) < 1e-5 and abs(r.cohens_d - (m1 - m2) / sp) < 1e-5
    assert r.degrees_of_freedom == n1 + n2 - 2 and r.p_value < 1e-10 and r.significance == "Significant"
    assert r.ci_low < r.mean_difference < r.ci_high
    f = stats.anova(df, with_p=True).first()
    assert abs(f.f_statistic - t * t) < 1e-3 * t * t          # two groups: F = t^2
    assert abs(f.p_value - M.t_two_sided_p(t, n1 + n2 - 2)) < 1e-9


def test_pearson_of_a_line_is_one(spark):
    df = _df(spark, [("Positive", 2.0 * i + 1, i) for i in range(20)])
    r = stats.pearson(df, "review_length", "rating").first()
    assert r.r == 1.0 and r.strength == "very strong"


@pytest.mark.parametrize("seed", [3, 7])
def test_spearman_with_ties_equals_pandas(spark, seed):
    random.seed(seed)
    rows = [("Positive", float(random.choice([1, 2, 3, 4, 5])), random.choice(range(30))) for _ in range(300)]
    df = _df(spark, rows)
    got = stats.spearman(df, "review_length", "rating").first().r
    pdf = pd.DataFrame(rows, columns=["s", "rating", "len"])
    want = pdf["len"].rank().corr(pdf["rating"].rank())
    assert abs(got - want) < 1e-8


def test_normality_jarque_bera(spark):
    rows = [("Positive", float(x), 1) for x in [1, 2, 2, 3, 3, 3, 4, 4, 5, 9]]
    r = stats.normality(_df(spark, rows)).first()
    xs = [x[1] for x in rows]
    n = len(xs)
    m = sum(xs) / n
    m2 = sum((x - m) ** 2 for x in xs) / n
    s = sum((x - m) ** 3 for x in xs) / n / m2 ** 1.5
    k = sum((x - m) ** 4 for x in xs) / n / m2 ** 2 - 3
    jb = n / 6 * (s * s + k * k / 4)
    assert abs(r.jarque_bera - jb) < 1e-3 and abs(r.p_value - math.exp(-jb / 2)) < 1e-7


def test_zero_variance_and_single_row_groups(spark):
    df = _df(spark, [("Positive", 5.0, 1), ("Positive", 5.0, 1), ("Negative", 1.0, 1)])
    r = stats.t_test(df).first()
    assert r.n_negative == 1 and r.std_negative is None and r.t_statistic is None


def test_statistical_results_long_format(spark):
    rows = ([("Positive", 4.0 + (i % 3) / 2, i) for i in range(40)]
            + [("Negative", 1.0 + (i % 3) / 2, 100 - i) for i in range(40)])
    df = _df(spark, rows)
    res = stats.statistical_results(df, df).collect()
    assert [r.metric_name for r in res] == ["Positive Mean Rating", "Negative Mean Rating", "P-Value",
                                            "Effect Size (Cohens D)", "Length-Rating Correlation",
                                            "Correlation P-Value"]


def test_distributed_prefix_sum_matches_brute_force(spark):
    from plume.functions.columns import prefix_before
    random.seed(11)
    vals = random.sample(range(100000), 2000)
    rows = [(v, random.randint(1, 9)) for v in vals]
    df = spark.createDataFrame(rows, "v long, w long")
    got = {r.v: r.b for r in prefix_before(df, ["v"], "w", out="b", partitions=13).collect()}
    acc, want = 0, {}
    for v, w in sorted(rows):
        want[v] = acc
        acc += w
    assert got == want


@pytest.mark.parametrize("aqe", ["true", "false"])
@pytest.mark.parametrize("rows", [200_000, 3_000_000])
def test_distributed_ranks_keep_every_row(spark, rows, aqe):
    from pyspark.sql import functions as F
    from plume.functions.columns import row_number_distributed
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        wide = spark.range(rows).select("id", (F.xxhash64("id") % 5000).alias("score"), F.lit("x" * 20).alias("a"),
                                        F.col("id").cast("string").alias("b"))
        ranked = row_number_distributed(wide, [F.col("score").desc_nulls_first(), F.col("id")], "r", "id", ["score"])
        got = ranked.agg(F.count("*").alias("n"), F.count_distinct("r").alias("ranks"), F.min("r").alias("low"),
                         F.max("r").alias("high"), F.count_distinct("id").alias("ids")).first()
        assert tuple(got) == (rows, rows, 1, rows, rows)
        # the order itself: scores fall as ranks rise
        top = ranked.groupBy("score").agg(F.min("r").alias("lo"), F.max("r").alias("hi"), F.count("*").alias("n"))
        assert top.where("hi - lo + 1 <> n").count() == 0
        best = ranked.where("r = 1").first()
        assert best.score == wide.agg(F.max("score")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_spearman_of_many_distinct_values(spark):
    from pyspark.sql import functions as F
    df = spark.range(300_000).select(F.col("id").alias("x"), (F.col("id") * 2 + 1).alias("y"), (-F.col("id")).alias("z"))
    up, down = stats.spearman(df, "x", "y").first(), stats.spearman(df, "x", "z").first()
    assert (up.n, up.r, down.n, down.r) == (300_000, 1.0, 300_000, -1.0)


def test_percent_rank_shares_ties(spark):
    from plume.functions.columns import percent_rank_distributed
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0), (4, None), (5, 9.0), (6, None)], "id int, v double")
    got = {r.id: r.p for r in percent_rank_distributed(df, "v", "p").collect()}
    assert got == {3: 0.0, 1: 0.2, 2: 0.2, 5: 0.6, 4: 0.8, 6: 0.8}


def test_tails_reach_the_normal_limit():
    for df in (1e9, 1e10, 1e11, 1e12, 1e13):
        for t in (0.3, 1.96, 3.5):
            limit = math.erfc(t / math.sqrt(2))
            assert abs(M.t_two_sided_p(t, df) - limit) < 2e-9 * (1e9 / df) + 1e-12
    assert abs(M.f_sf(3.0, 2, 1e12) - math.exp(-3.0)) < 1e-10
    assert abs(M.t_quantile(0.975, 1e12) - 1.959963984540054) < 1e-9
    # closed forms: one and two degrees of freedom
    assert abs(M.t_two_sided_p(0.5, 1) - (1 - 2 * math.atan(0.5) / math.pi)) < 1e-14
    assert abs(M.t_two_sided_p(1.5, 2) - (1 - 1.5 / math.sqrt(1.5 ** 2 + 2))) < 1e-14


def test_what_does_not_converge_is_nan(monkeypatch):
    monkeypatch.setattr(M, "_MOST_TERMS", 2)
    assert math.isnan(M.t_two_sided_p(1.96, 50.0)) and math.isnan(M.betainc(300.0, 400.0, 0.43))


def test_sql_incomplete_beta_matches_python():
    import duckdb
    from plume.plans.oracle_betainc import betainc_ctes
    cases = [(5.0, 0.5, 0.3), (2.0, 3.0, 0.4), (2000.0, 0.5, 0.999), (10.0, 0.5, 0.01), (1.0, 1.0, 0.5),
             (0.5, 2500.0, 1e-4), (3.0, 4.0, 0.0), (3.0, 4.0, 1.0)]
    vals = ", ".join(f"({i}, {a!r}, {b!r}, {x!r})" for i, (a, b, x) in enumerate(cases))
    sql = ("WITH RECURSIVE src(id, a, b, x) AS (VALUES " + vals + ")," + betainc_ctes("src", "bi")
           + " SELECT id, ix FROM bi ORDER BY id")
    for (i, ix), (a, b, x) in zip(duckdb.sql(sql).fetchall(), cases):
        want = M.betainc(a, b, x)
        assert abs(ix - want) <= 1e-10 * max(abs(want), 1e-300), (a, b, x, ix, want)


def test_sql_t_quantile_matches_python():
    import duckdb
    from plume.plans.oracle_betainc import t_quantile_ctes
    dfs = [1.0, 3.0, 10.0, 250.0, 4000.0]
    vals = ", ".join(f"({i}, {d!r})" for i, d in enumerate(dfs))
    sql = ("WITH RECURSIVE src(id, df) AS (VALUES " + vals + ")," + t_quantile_ctes("src", "tq")
           + " SELECT id, t FROM tq ORDER BY id")
    for (i, t), d in zip(duckdb.sql(sql).fetchall(), dfs):
        assert abs(t - M.t_quantile(0.975, d)) < 1e-9
