"""Review ingestion: standardize, clean, derive features.

One lazy plan from the raw file to the ``raw_reviews`` shape; nothing is
collected, the only job is whatever the caller finally writes or counts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bins
from ..functions.columns import count_if, ntz_lit, null_if_na, strip_ws, word_count_ws
from ..params import DEFAULT, REVIEWS

# ---- fixed values: accepted input spellings -> canonical name, in the order
# they are applied.
COLUMN_ALIASES = (
    ("Translated_Review", "review_text"),
    ("translated_review", "review_text"),
    ("Review", "review_text"),
    ("review", "review_text"),
    ("Sentiment", "sentiment"),
    ("sentiment", "sentiment"),
    ("Rating", "rating"),
    ("rating", "rating"),
    ("Star", "rating"),
    ("star", "rating"),
    ("App", "app_name"),
    ("app", "app_name"),
    ("App_Name", "app_name"),
)
REQUIRED_COLUMNS = ("review_text", "sentiment", "rating")
TEXT_COLUMNS = ("review_text", "sentiment", "rating", "app_name")


def standardize_columns(df: DataFrame) -> DataFrame:
    """B1: rename accepted spellings; several spellings of one name coalesce in order."""
    sources: dict[str, list[str]] = {}
    for old, new in COLUMN_ALIASES:
        if old in df.columns and old not in sources.get(new, []):
            sources.setdefault(new, []).append(old)
    consumed = {c for cols in sources.values() for c in cols}
    out = [F.col(f"`{c}`") for c in df.columns if c not in consumed and c not in sources]
    for new, olds in sources.items():
        expr = F.col(f"`{olds[0]}`") if len(olds) == 1 else F.coalesce(*[F.col(f"`{o}`") for o in olds])
        out.append(expr.alias(new))
    return df.select(*out)


def require_columns(df: DataFrame, cols=REQUIRED_COLUMNS) -> DataFrame:
    """B2: raise if a required column is missing (schema check, no job)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Dataset must contain columns: {list(cols)}; missing {missing}")
    return df


def null_na_strings(df: DataFrame, cols=TEXT_COLUMNS) -> DataFrame:
    """The CSV reader's NA spellings become NULL on the text columns (trap T4)."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: null_if_na(F.col(c).cast("string")) for c in present})


def _stage_predicates(min_len: int = REVIEWS.min_text_length) -> list[tuple[str, Column]]:
    """Cumulative cleaning predicates, one per stage."""
    text_ok = F.col("review_text").isNotNull()
    long_ok = F.length("review_text") >= min_len
    rating = F.col("rating").try_cast("double")
    rating_ok = rating.isNotNull() & rating.between(1, 5)
    sentiment_ok = normalized_sentiment("sentiment").isin(*REVIEWS.valid_sentiments)
    return [("input", F.lit(True)), ("text_present", text_ok), ("min_length", long_ok),
            ("valid_rating", rating_ok), ("valid_sentiment", sentiment_ok)]


def normalized_sentiment(c) -> Column:
    """Strip whitespace and title-case."""
    return F.initcap(strip_ws(c))


def clean_reviews(df: DataFrame, min_len: int = REVIEWS.min_text_length) -> DataFrame:
    """Drop missing/short text, coerce rating to 1..5, keep 3 sentiments."""
    preds = _stage_predicates(min_len)
    cond = preds[1][1]
    for _, p in preds[2:]:
        cond = cond & p
    return (df.where(cond)
              .withColumns({"rating": F.col("rating").try_cast("double"),
                            "sentiment": normalized_sentiment("sentiment")}))


def add_features(df: DataFrame) -> DataFrame:
    """B8-B12 in one projection."""
    length = F.length("review_text").cast("long")
    return df.withColumns({
        "review_length": length,
        "review_word_count": word_count_ws("review_text"),
        "review_length_category": bins.review_length_category(length),
        "rating_category": bins.rating_category("rating"),
        "sentiment_binary": bins.sentiment_binary("sentiment"),
    })


def add_metadata(df: DataFrame, ingestion_ts: dt.datetime | None = None,
                 source_tag: str = DEFAULT.data_source) -> DataFrame:
    """Ingestion time is an argument (kept when the input already has one)."""
    cols = {"data_source": F.lit(source_tag)}
    if ingestion_ts is not None or "ingestion_timestamp" not in df.columns:
        ts = ingestion_ts or dt.datetime(2024, 1, 1)
        cols["ingestion_timestamp"] = ntz_lit(ts)
    return df.withColumns(cols)


RAW_REVIEW_COLUMNS = ("rid", "review_text", "sentiment", "rating", "app_name", "review_length",
                      "review_word_count", "review_length_category", "rating_category",
                      "sentiment_binary", "ingestion_timestamp", "data_source")


def ingest_reviews(raw: DataFrame, ingestion_ts: dt.datetime | None = None,
                   source_tag: str = DEFAULT.data_source) -> DataFrame:
    """Raw review file -> ``raw_reviews`` shape (B1-B13), one lazy plan."""
    df = require_columns(standardize_columns(raw))
    if "app_name" not in df.columns:
        df = df.withColumn("app_name", F.lit(None).cast("string"))
    df = add_metadata(add_features(clean_reviews(null_na_strings(df))), ingestion_ts, source_tag)
    if "rid" not in df.columns:
        df = df.withColumn("rid", F.lit(None).cast("long"))
    return df.select(*RAW_REVIEW_COLUMNS)


def cleaning_audit(raw: DataFrame, min_len: int = REVIEWS.min_text_length) -> DataFrame:
    """Rows remaining after each cleaning stage, in one aggregation.

    The original logs one count per stage; here all stage counts come out of
    a single pass with cumulative predicates.
    """
    df = null_na_strings(require_columns(standardize_columns(raw)))
    preds = _stage_predicates(min_len)
    aggs, cond = [], None
    for name, p in preds:
        cond = p if cond is None else cond & p
        aggs.append(count_if(cond).alias(f"rows_after_{name}"))
    return df.agg(*aggs)
