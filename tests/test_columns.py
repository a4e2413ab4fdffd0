"""Bin edges, NA spellings, whitespace, word counts and rounding (traps T1-T4, T17, T20)."""

from pyspark.sql import functions as F

from plume.functions import bins
from plume.functions.columns import NA_STRINGS, null_if_na, rnd, strip_ws, word_count_space, word_count_ws


def _one(spark, col, values, schema="v double"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col).collect()]


def test_review_length_category_edges(spark):
    got = _one(spark, bins.review_length_category("v"), [0, 1, 50, 51, 150, 151, 500, 501], "v long")
    assert got == [None, "Short", "Short", "Medium", "Medium", "Long", "Long", "Very Long"]


def test_rating_category_edges(spark):
    got = _one(spark, bins.rating_category("v"), [0.0, 0.99, 1.0, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0, 5.01])
    assert got == [None, "Poor", "Poor", "Poor", "Fair", "Fair", "Good", "Good", "Excellent", None]


def test_length_category_five_buckets(spark):
    got = _one(spark, bins.length_category("v"), [25, 26, 75, 76, 200, 201, 500, 501], "v long")
    assert got == ["Very Short", "Short", "Short", "Medium", "Medium", "Long", "Long", "Very Long"]


def test_rating_group_fractional_is_null_but_crosstab_is_high(spark):
    # trap T2: 2.5 and 3.5 have no rating_group, but the cross-tab puts them in High
    assert _one(spark, bins.rating_group("v"), [2.0, 2.5, 3.0, 3.5, 4.0]) == \
        ["Low (1-2)", None, "Medium (3)", None, "High (4-5)"]
    assert _one(spark, bins.rating_category_3("v"), [2.0, 2.5, 3.0, 3.5]) == \
        ["Low (1-2)", "High (4-5)", "Medium (3)", "High (4-5)"]


def test_length_bin_edges(spark):
    got = _one(spark, bins.length_bin("v"), [50, 51, 100, 101, 200, 201, 400, 401], "v long")
    assert got == ["0-50", "51-100", "51-100", "101-200", "101-200", "201-400", "201-400", "400+"]


def test_alignment_and_quality(spark):
    df = spark.createDataFrame([("Positive", 4.0), ("Positive", 3.5), ("Negative", 2.0), ("Neutral", 3.0),
                                ("Neutral", 2.5)], "s string, r double")
    assert [r[0] for r in df.select(bins.alignment("s", "r")).collect()] == \
        ["Aligned", "Misaligned", "Aligned", "Aligned", "Misaligned"]
    q = spark.createDataFrame([(50, 10), (49, 10), (20, 5), (20, 4)], "n long, w long")
    assert [r[0] for r in q.select(bins.review_quality("n", "w")).collect()] == \
        ["Detailed", "Moderate", "Moderate", "Brief"]


def test_na_spellings_become_null(spark):
    vals = list(NA_STRINGS) + ["abc", " nan"]
    got = _one(spark, null_if_na("v"), vals, "v string")
    assert got[:len(NA_STRINGS)] == [None] * len(NA_STRINGS)
    assert got[-2:] == ["abc", " nan"]


def test_strip_keeps_inner_whitespace_and_removes_tabs(spark):
    got = _one(spark, strip_ws("v"), [" a b ", "\tpositive\t", "x\n", "   "], "v string")
    assert got == ["a b", "positive", "x", ""]


def test_two_word_counts(spark):
    # trap T1: whitespace runs vs single spaces; T17: the single-space count is never 0
    vals = ["a  b", " a b ", "", "   ", "one"]
    assert _one(spark, word_count_ws("v"), vals, "v string") == [2, 2, 0, 0, 1]
    assert _one(spark, word_count_space("v"), vals, "v string") == [3, 4, 1, 4, 1]


def test_round_half_up_through_decimal(spark):
    # trap T20: 1.005 rounds up, as in both engines via decimal
    assert _one(spark, rnd("v", 2), [1.005, 2.675, -1.005]) == [1.01, 2.68, -1.01]


def test_engagement_score_bounds(spark):
    df = spark.createDataFrame([(0.0, 100.0, 0.0, 0.0, 0), (100.0, 0.0, 100.0, 10.0, 1000),
                                (None, None, None, None, None)],
                               "d double, b double, c double, v double, u long")
    got = [r[0] for r in df.select(bins.engagement_score("d", "b", "c", "v", "u")).collect()]
    assert got[0] == 5.0 and got[1] == 100.0 and got[2] == 5.0


def test_roas_tier_edges(spark):
    from plume.params import DEFAULT
    got = _one(spark, bins.roas_tier("v", DEFAULT), [0.99, 1.0, 2.0, 4.0, None])
    assert got == ["Poor", "Break-even", "Good", "Excellent", "Poor"]


def test_whitespace_matches_python_str_semantics(spark):
    vals = [" a b　", " a b ", "\t\x1c x \x85", "plain", "", "​ zero-width is not space", "a\xa0\xa0b"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [(r[0], r[1]) for r in df.select(strip_ws("v"), word_count_ws("v")).collect()]
    assert got == [(v.strip(), len(v.split())) for v in vals]


def test_round_keeps_values_beyond_decimal_range(spark):
    assert _one(spark, rnd("v", 2), [1e30, -2.5e28, 1.005]) == [1e30, -2.5e28, 1.01]
