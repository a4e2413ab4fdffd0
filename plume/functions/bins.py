"""Bins, tiers and labels as CASE expressions.

The cut points and label strings are fixed values that must equal the
original project's; each function notes which interval side is closed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col



def _null_str() -> Column:
    return F.lit(None).cast("string")


# ---- review ingestion (right-closed intervals, like pandas.cut) ------------

def review_length_category(length) -> Column:
    """(0,50] Short, (50,150] Medium, (150,500] Long, (500,inf) Very Long."""
    c = col(length)
    return (F.when((c > 0) & (c <= 50), "Short").when((c > 50) & (c <= 150), "Medium")
            .when((c > 150) & (c <= 500), "Long").when(c > 500, "Very Long").otherwise(_null_str()))


def rating_category(rating) -> Column:
    """(0,2] Poor, (2,3] Fair, (3,4] Good, (4,5] Excellent."""
    c = col(rating)
    return (F.when((c > 0) & (c <= 2), "Poor").when((c > 2) & (c <= 3), "Fair")
            .when((c > 3) & (c <= 4), "Good").when((c > 4) & (c <= 5), "Excellent").otherwise(_null_str()))


def sentiment_binary(sentiment) -> Column:
    c = col(sentiment)
    return (F.when(c == "Positive", 1.0).when(c == "Negative", 0.0)
            .when(c == "Neutral", 0.5).otherwise(F.lit(None).cast("double")))


# ---- analysis table --------------------------------------------------------

def sentiment_score(sentiment) -> Column:
    c = col(sentiment)
    return (F.when(c == "Positive", 1.0).when(c == "Neutral", 0.5)
            .when(c == "Negative", 0.0).otherwise(F.lit(None).cast("double")))


def length_category(length) -> Column:
    """Five buckets at 25 / 75 / 200 / 500 (upper edges inclusive)."""
    c = col(length)
    return (F.when(c <= 25, "Very Short").when(c <= 75, "Short").when(c <= 200, "Medium")
            .when(c <= 500, "Long").otherwise("Very Long"))


def rating_group(rating) -> Column:
    """Low (1-2) / Medium (3) / High (4-5); 2<r<3 and 3<r<4 stay NULL."""
    c = col(rating)
    return (F.when(c <= 2, "Low (1-2)").when(c == 3, "Medium (3)")
            .when(c >= 4, "High (4-5)").otherwise(_null_str()))


def rating_category_3(rating) -> Column:
    """Cross-tab rating category: everything above 3 (and 2<r<3) falls to High."""
    c = col(rating)
    return F.when(c <= 2, "Low (1-2)").when(c == 3, "Medium (3)").otherwise("High (4-5)")


def alignment(sentiment, rating) -> Column:
    s, r = col(sentiment), col(rating)
    aligned = (((s == "Positive") & (r >= 4)) | ((s == "Negative") & (r <= 2))
               | ((s == "Neutral") & (r == 3)))
    return F.when(aligned, "Aligned").otherwise("Misaligned")


def review_quality(length, words) -> Column:
    """Detailed / Moderate / Brief from length and whitespace word count."""
    n, w = col(length), col(words)
    return (F.when((n >= 50) & (w >= 10), "Detailed")
            .when((n >= 20) & (w >= 5), "Moderate").otherwise("Brief"))


def engagement_level(length) -> Column:
    c = col(length)
    return (F.when(c > 100, "High Engagement").when(c > 50, "Medium Engagement")
            .otherwise("Low Engagement"))


def length_bin(length) -> Column:
    """Cross-tab bins 0-50 / 51-100 / 101-200 / 201-400 / 400+."""
    c = col(length)
    return (F.when(c <= 50, "0-50").when(c <= 100, "51-100").when(c <= 200, "101-200")
            .when(c <= 400, "201-400").otherwise("400+"))


LENGTH_BIN_ORDER = ("0-50", "51-100", "101-200", "201-400", "400+")
QUALITY_ORDER = ("Detailed", "Moderate", "Brief")


def order_rank(c, values) -> Column:
    """Position of ``c`` in ``values`` (1-based), NULL when absent (sort by CASE)."""
    expr = None
    for i, v in enumerate(values, start=1):
        expr = (F.when(col(c) == v, i) if expr is None else expr.when(col(c) == v, i))
    return expr


def adequacy_label(n) -> Column:
    c = col(n)
    return (F.when(c >= 30, "Adequate for t-test").when(c >= 15, "Small sample - use caution")
            .otherwise("Insufficient sample size"))


# ---- statistics labels -----------------------------------------------------

def effect_label(d) -> Column:
    """Cohen's d label used by the statistics script (.2 / .5 / .8)."""
    a = F.abs(col(d))
    return (F.when(a.isNull(), _null_str()).when(a < 0.2, "negligible").when(a < 0.5, "small")
            .when(a < 0.8, "medium").otherwise("large"))


def effect_label_dashboard(d) -> Column:
    """Dashboard colouring of |d|: > .5 large, > .2 medium, else small."""
    a = F.abs(col(d))
    return (F.when(a.isNull(), _null_str()).when(a > 0.5, "Large effect")
            .when(a > 0.2, "Medium effect").otherwise("Small effect"))


def strength_label(r) -> Column:
    a = F.abs(col(r))
    return (F.when(a.isNull(), _null_str()).when(a < 0.1, "negligible").when(a < 0.3, "weak")
            .when(a < 0.5, "moderate").when(a < 0.7, "strong").otherwise("very strong"))


def power_label(n_min) -> Column:
    return F.when(col(n_min) > 100, "High").otherwise("Moderate")


def significance_label(p, alpha: float = 0.05) -> Column:
    return F.when(col(p) < alpha, "Significant").otherwise("Not Significant")


# ---- warehouse -------------------------------------------------------------

def roas_tier(roas, params) -> Column:
    r = col(roas)
    return (F.when(r >= params.excellent_roas_threshold, "Excellent")
            .when(r >= params.good_roas_threshold, "Good")
            .when(r >= params.breakeven_roas_threshold, "Break-even").otherwise("Poor"))


def engagement_quality(duration, bounce, conversion) -> Column:
    d, b, c = col(duration), col(bounce), col(conversion)
    return (F.when((d >= 10) & (b <= 30) & (c >= 5), "High")
            .when((d >= 5) & (b <= 50) & (c >= 2), "Medium")
            .when((d >= 2) & (b <= 70), "Low").otherwise("Very Low"))


def _part(cond, value) -> Column:
    return F.when(cond, value).otherwise(F.lit(0.0))


def engagement_score(duration, bounce, conversion, views_per_session, users) -> Column:
    """Five capped parts (20 + 30 + 25 + 15 + 20), total capped at 100."""
    d, b, c, v, u = map(col, (duration, bounce, conversion, views_per_session, users))
    users_part = (F.when(u > 100, 20.0).when(u > 50, 15.0).when(u > 10, 10.0).otherwise(5.0))
    total = (_part(d > 0, F.least(d * 2.0, F.lit(20.0)))
             + _part(b < 100, (F.lit(100.0) - b) * 0.3)
             + _part(c > 0, F.least(c * 5.0, F.lit(25.0)))
             + _part(v > 1, F.least((v - 1.0) * 5.0, F.lit(15.0)))
             + users_part)
    return F.least(F.lit(100.0), total)


def business_score(revenue, roas, eng_score, delivery) -> Column:
    """Four capped parts (30 + 25 + 25 + 20), total capped at 100."""
    r, ro, e, dl = map(col, (revenue, roas, eng_score, delivery))
    total = (_part(r > 0, F.least(r / 1000.0, F.lit(30.0)))
             + _part(ro > 0, F.least(ro * 5.0, F.lit(25.0)))
             + _part(e > 0, e * 0.25)
             + _part(dl > 0, dl * 0.2))
    return F.least(F.lit(100.0), total)


def campaign_health(roas, efficiency, params) -> Column:
    r, e = col(roas), col(efficiency)
    return (F.when((r >= params.excellent_roas_threshold) & (e >= 80), "Excellent")
            .when((r >= params.good_roas_threshold) & (e >= 60), "Good")
            .when((r >= params.breakeven_roas_threshold) & (e >= 40), "Average")
            .otherwise("Needs Improvement"))


def channel_importance(score) -> Column:
    s = col(score)
    return (F.when(s >= 20, "Primary").when(s >= 10, "Secondary").when(s >= 5, "Supporting")
            .otherwise("Minor"))


def user_value_tier(score, params) -> Column:
    s = col(score)
    return (F.when(s >= params.high_engagement_score, "High Value")
            .when(s >= params.medium_engagement_score, "Medium Value")
            .when(s >= 20, "Low Value").otherwise("At Risk"))


def user_persona(stage, score, params) -> Column:
    st, s = col(stage), col(score)
    return (F.when((st == "Active") & (s >= params.high_engagement_score), "Champion")
            .when((st == "Active") & (s >= params.medium_engagement_score), "Loyal")
            .when((st == "New") & (s >= params.medium_engagement_score), "Potential")
            .when(st == "At Risk", "At Risk").when(st == "Churned", "Lost").otherwise("Casual"))


def subscription_value(tier) -> Column:
    t = col(tier)
    return (F.when(t == "Premium", 100).when(t == "Pro", 50).when(t == "Free", 10)
            .otherwise(0)).cast("long")


def churn_risk(days) -> Column:
    d = col(days)
    return (F.when(d > 30, "High Risk").when(d > 14, "Medium Risk").when(d > 7, "Low Risk")
            .otherwise("Active"))


def adoption_level(features) -> Column:
    f = col(features)
    return (F.when(f >= 10, "Power User").when(f >= 5, "Regular User").when(f >= 2, "Light User")
            .otherwise("Minimal User"))


def percentile_band(score, p90, p75, p50) -> Column:
    s = col(score)
    return (F.when(s >= col(p90), "Top 10%").when(s >= col(p75), "Top 25%")
            .when(s >= col(p50), "Top 50%").otherwise("Bottom 50%"))


def customer_value_tier(total, params) -> Column:
    t = col(total)
    return (F.when(t >= params.high_value_customer_threshold, "High Value")
            .when(t >= params.medium_value_customer_threshold, "Medium Value")
            .when(t >= params.low_value_customer_threshold, "Low Value").otherwise("Minimal Value"))
