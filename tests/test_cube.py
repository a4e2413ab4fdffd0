"""Moments of the reviews: they merge, serve the plain reports, and no review is read for a report."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from plume.operators import analysis, cube, feeds


@pytest.fixture(scope="module")
def reviews(spark):
    rng = random.Random(31)
    rows = [(dt.datetime(2024, 1, rng.randint(1, 4)), rng.choice(["Positive", "Neutral", "Negative"]), rng.choice(["Short", "Long"]),
             rng.choice(["High Quality", "Low Quality"]), rng.choice([None, 1.0, 2.5, 3.0, 5.0]), rng.randint(1, 10**9), rng.randint(1, 90))
            for _ in range(500)] + [(dt.datetime(2024, 1, 9), "Neutral", "Short", None, 4.0, 7, 1)]
    return spark.createDataFrame(rows, "ingestion_timestamp timestamp_ntz, sentiment string, length_category string, "
                                       "review_quality string, rating double, review_length long, word_count long").cache()


def _rows(df):
    return sorted(map(str, (r.asDict() for r in df.collect())))


def test_days_are_added(reviews):
    first, rest = reviews.where("day(ingestion_timestamp) < 3"), reviews.where("day(ingestion_timestamp) >= 3")
    again = reviews.limit(0)
    parts = cube.added(cube.added(cube.review_moments(first), cube.review_moments(rest)), cube.review_moments(again))
    assert _rows(parts) == _rows(cube.review_moments(reviews))
    late = cube.added(cube.review_moments(reviews), cube.review_moments(first))
    assert _rows(late) == _rows(cube.review_moments(reviews.unionByName(first)))


@pytest.mark.parametrize("key", ["sentiment", "length_category"])
def test_reports_equal_the_plain_ones(reviews, key):
    got = {r["value"]: r for r in cube.moment_reports(cube.review_moments(reviews)).where(F.col("dimension") == key).collect()}
    plain = analysis.stats_by(reviews, key).collect()
    assert len(got) == len(plain)
    for r in plain:
        g = got[r[key]]
        assert (g["count"], g.percentage) == (r["count"], r.percentage)
        for a, b in ((g.avg_rating, r.avg_rating), (g.std_rating, r.stddev_rating), (g.avg_length, r.avg_length)):
            assert a == pytest.approx(b, abs=2e-6)


def test_interval_and_extremes(reviews):
    report = cube.moment_reports(cube.review_moments(reviews))
    want = {r.sentiment: r for r in feeds.mean_ci(reviews.where("rating IS NOT NULL")).collect()}
    for r in report.where("dimension = 'sentiment'").collect():
        assert r.ci_low == pytest.approx(want[r["value"]].ci_low, abs=2e-6) and r.ci_high == pytest.approx(want[r["value"]].ci_high, abs=2e-6)
    whole = report.where("dimension = 'all'").first()
    plain = reviews.agg(F.min("review_length"), F.max("review_length"), F.stddev_samp("review_length")).first()
    assert (whole.min_length, whole.max_length) == (plain[0], plain[1]) and whole.std_length == pytest.approx(plain[2], rel=1e-9)
    one = report.where("dimension = 'day' AND value = '2024-01-09'").first()
    assert one["count"] == 1 and one.std_rating is None and one.std_length is None and one.avg_rating == 4.0


def test_empty(reviews):
    nothing = cube.review_moments(reviews.limit(0))
    assert nothing.collect() == [] and cube.moment_reports(nothing).collect() == []


def test_reports_read_the_written_moments(spark):
    from conftest import SF_SMALL
    from plume.plans import reviews as plans

    plan = plans.QUERIES["moment_reports"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "review_text" not in plan
