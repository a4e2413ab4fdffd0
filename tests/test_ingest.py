"""Ingestion B1-B14 on hand-made rows (FIXTURES.md section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plume.operators import ingest
from plume.params import DEFAULT

ROWS = [
    # text, sentiment, rating, app
    (None, "Positive", "4", "a"),
    ("", "Positive", "4", "a"),
    ("ab", "Positive", "4", "a"),
    ("   ", "Positive", "4", "a"),          # untrimmed length 3: kept by ingestion
    ("abc", " POSITIVE", "0", "a"),          # rating out of range
    ("abc", "positive\t", "0.99", "a"),
    ("good app", " POSITIVE", "1", "a"),
    ("nan", "Positive", "4", "a"),           # NA spelling -> NULL text
    ("N/A", "Positive", "4", "a"),
    ("fine", "Mixed", "3", "a"),             # invalid sentiment
    ("fine", None, "3", "a"),
    ("ok ok", "neutral", "2.5", "a"),
    ("ok ok", "negative", " 4 ", "a"),
    ("bad", "Negative", "x", "a"),           # junk rating
    ("bad", "Negative", None, "a"),
    ("great", "Positive", "5", "a"),
    ("great", "Positive", "5.01", "a"),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(ROWS, "Translated_Review string, Sentiment string, Rating string, App string")


def test_ingest_filters_and_normalizes(spark, raw):
    out = ingest.ingest_reviews(raw, ingestion_ts=dt.datetime(2024, 1, 1))
    rows = {(r.review_text, r.sentiment, r.rating) for r in out.collect()}
    assert rows == {("   ", "Positive", 4.0), ("good app", "Positive", 1.0), ("ok ok", "Neutral", 2.5),
                    ("ok ok", "Negative", 4.0), ("great", "Positive", 5.0)}
    r = out.where("review_text = 'ok ok' AND sentiment = 'Neutral'").first()
    assert (r.review_length, r.review_word_count, r.review_length_category, r.rating_category,
            r.sentiment_binary, r.data_source) == (5, 2, "Short", "Fair", 0.5, DEFAULT.data_source)
    assert out.where("review_text = '   '").first().review_word_count == 0


def test_cleaning_audit_is_one_cumulative_aggregation(spark, raw):
    a = ingest.cleaning_audit(raw).first().asDict()
    assert a == {"rows_after_input": 17, "rows_after_text_present": 13, "rows_after_min_length": 12,
                 "rows_after_valid_rating": 7, "rows_after_valid_sentiment": 5}


def test_standardize_coalesces_spellings_in_order(spark):
    df = spark.createDataFrame([("r1", None, "Positive", "5"), (None, "t2", "Positive", "5")],
                               "Translated_Review string, Review string, Sentiment string, Star string")
    out = ingest.standardize_columns(df)
    assert sorted(out.columns) == ["rating", "review_text", "sentiment"]
    assert [r.review_text for r in out.collect()] == ["r1", "t2"]


def test_missing_required_column_raises(spark):
    df = spark.createDataFrame([("x", "Positive")], "Review string, Sentiment string")
    with pytest.raises(ValueError):
        ingest.ingest_reviews(df)
