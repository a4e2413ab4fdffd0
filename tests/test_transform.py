"""Analysis table B20-B36: validity, dedup order, outliers, ids (traps T5-T7)."""

import datetime as dt

from pyspark.sql import functions as F

from plume.operators import analysis as A
from plume.operators import transform

SCHEMA = ("rid long, review_text string, sentiment string, rating double, app_name string, review_length long, "
          "review_word_count long, review_length_category string, rating_category string, "
          "sentiment_binary double, ingestion_timestamp timestamp_ntz, data_source string")


def _row(rid, text, s, r, app, day):
    return (rid, text, s, r, app, len(text), len(text.split()), None, None, None,
            dt.datetime(2024, 1, day), "src")


def test_dedup_newest_then_app_then_rid(spark):
    rows = [_row(1, "same text", "Positive", 5.0, "b", 1), _row(2, "same text", "Positive", 5.0, "a", 3),
            _row(3, "same text", "Positive", 5.0, "c", 3), _row(4, "same text", "Positive", 4.0, "z", 1),
            _row(5, "other text", "Negative", 1.0, None, 2), _row(6, "other text", "Negative", 1.0, "a", 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.review_text, r.rating): r.rid for r in transform.dedup_reviews(df).collect()}
    assert got == {("same text", 5.0): 2, ("same text", 4.0): 4, ("other text", 1.0): 5}


def test_dedup_is_idempotent(spark):
    rows = [_row(i, f"t{i % 3}", "Positive", 5.0, "a", 1 + i % 4) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    once = transform.dedup_reviews(df)
    twice = transform.dedup_reviews(once)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_dedup_of_hot_texts_keeps_the_same_rows(spark):
    rows = [_row(i, ("hot", "warm text", None)[min(i % 7, 2)] if i % 7 < 3 else f"t{i % 11}", ("Positive", "Negative")[i % 2], 1.0 + i % 5,
                 (None, "a", "b")[i % 3], 1 + i % 4) if i % 7 != 2 else (i, None, "Positive", 2.0, "a", None, None, None, None, None, None, "src")
            for i in range(400)]
    df = spark.createDataFrame(rows + rows[:50], SCHEMA)
    want = {}
    for r in df.collect():
        key = (r.review_text, r.rating, r.sentiment)
        ts = r.ingestion_timestamp
        rank = (ts is None, -(ts.day if ts else 0), r.app_name is not None, r.app_name or "", r.rid)
        want[key] = min(want.get(key, (rank, r)), (rank, r), key=lambda x: x[0])
    for hot_rows in (0, 40, 100_000):  # every text, some, none
        got = transform.dedup_reviews(df, hot_rows).collect()
        assert len(got) == len(want) and set(got) == {r for _, r in want.values()}


def test_dedup_sorts_no_text_before_the_shuffle(spark):
    df = spark.createDataFrame([_row(1, "same text", "Positive", 5.0, "b", 1)], SCHEMA)
    lines = transform.dedup_reviews(df)._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, x in enumerate(lines) if "REPARTITION_BY_COL" in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    below = []
    for x in lines[at + 1:]:
        if depth(x) <= depth(lines[at]):
            break
        below.append(x)
    assert below and not any("Sort" in x for x in below) and not any("Exchange hashpartitioning" in x and "_h" in x for x in lines[:at])


def test_valid_filter_uses_trimmed_length(spark):
    rows = [_row(1, "   ", "Positive", 4.0, "a", 1), _row(2, " ab ", "Positive", 4.0, "a", 1),
            _row(3, " abc ", "Positive", 4.0, "a", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [r.rid for r in transform.valid_reviews(df).collect()] == [3]


def test_analyzed_columns_and_outlier_threshold(spark):
    rows = [_row(i, "x" * (3 + i), "Positive" if i % 2 else "Negative", 4.0 if i % 2 else 2.0, "a", 1)
            for i in range(40)]
    raw = spark.createDataFrame(rows, SCHEMA)
    out = transform.reviews_analyzed(raw)
    p95 = transform.length_outlier_threshold(raw).first().p95_length
    assert p95 == 40  # lengths 3..42: the 38th of 40 values
    assert out.where("is_length_outlier").count() == 2
    assert out.select("review_id").distinct().count() == 40
    r = out.where("review_length = 3").first()
    assert (r.sentiment_rating_alignment, r.include_in_ttest, r.rating_group, r.negative_rating,
            r.positive_rating, r.word_count) == ("Aligned", True, "Low (1-2)", 2.0, None, 1)


def test_ttest_view_keeps_only_aligned(spark):
    rows = [_row(1, "aaa", "Positive", 3.0, "a", 1), _row(2, "bbb", "Positive", 5.0, "a", 1),
            _row(3, "ccc", "Neutral", 3.0, "a", 1)]
    out = transform.ttest_data(transform.reviews_analyzed(spark.createDataFrame(rows, SCHEMA)))
    assert [(r.sentiment, r.rating) for r in out.collect()] == [("Positive", 5.0)]


def test_percentages_sum_to_100(spark):
    rows = [_row(i, f"text {i}", ["Positive", "Negative", "Neutral"][i % 3], float(1 + i % 5), "a", 1)
            for i in range(37)]
    a = transform.reviews_analyzed(spark.createDataFrame(rows, SCHEMA))
    total = A.distribution(a, "sentiment").agg(F.sum("percentage")).first()[0]
    assert abs(total - 100.0) < 0.02


def test_alignment_examples_limits_to_three_in_id_order(spark):
    rows = [_row(i, f"misaligned review {i}", "Positive", 2.0, "a", 1) for i in range(10)]
    a = transform.reviews_analyzed(spark.createDataFrame(rows, SCHEMA))
    r = A.alignment_examples(a).where("sentiment_rating_alignment = 'Misaligned'").first()
    assert r["count"] == 10 and r.misaligned_examples.count(" || ") == 2
    assert r.misaligned_examples.startswith("Rating: 2.0 | misaligned review")


def test_approximate_threshold_is_close(spark):
    rows = [_row(i, "x" * (3 + i), "Positive", 4.0, "a", 1) for i in range(200)]
    raw = spark.createDataFrame(rows, SCHEMA)
    exact = transform.length_outlier_threshold(raw).first().p95_length
    approx = transform.length_outlier_threshold(raw, exact=False).first().p95_length
    assert abs(exact - approx) <= 2
