"""The corpus pipeline: five operators in a row, each on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the shared folder and hands it to the next stage.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plume.llm.common import documents, written
from plume.llm.stages import (drop_near_duplicates, identify_language, pack_sequences, redact_secrets,
                              reject_low_quality)

STAGES = [
    ("quality_rules", reject_low_quality),
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: No statement: covariance iterations, context trees, Golay keys and tokenizers are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
