"""Stages of the corpus pipeline: each applies one operator's decisions to all documents it is given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language, packing, quality_rules, secrets, simhash
from .common import unused
from .queries import BYTE_VOCABULARY

#: A prediction with a score below this counts as no known language (see ``language``).
LEAST_SCORE = 0.5


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.kept_documents(docs)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; a missing lang becomes the predicted one.

    Where no document has a lang there is nothing to judge by: all are passed on.
    """
    model = language.learn(docs, F.lit(True))
    if not model.languages:
        return docs
    pred, score = unused("lang_pred", docs.columns), unused("score", docs.columns)
    found = language.identify(docs, model, tuple(docs.columns), pred, score)
    known = found.where((F.col(pred) != "und") & (F.col(score) >= LEAST_SCORE))
    return known.withColumn("lang", F.coalesce("lang", pred)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates."""
    return simhash.one_of_each(docs, shingle=3, max_distance=3)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts and n_chars counted anew."""
    return secrets.redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of the documents that are left (see ``packing.packed``)."""
    return packing.packed(docs, BYTE_VOCABULARY, capacity=1024, end_id=2)
