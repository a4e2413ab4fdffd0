"""Registered queries: each operator with its contract's parameters over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (bpe_codec, fingerprints, language, licenses, merkle, minhash, packing, periodic_runs, pii, quality_rules,
               secrets, simhash, token_counts)
from .common import documents

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(documents(spark, sf_dir))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(documents(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_held_out(documents(spark, sf_dir))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=3, max_distance=3)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), WORD_VOCABULARY, limit=2048)


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.codec(documents(spark, sf_dir), WORD_VOCABULARY)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(documents(spark, sf_dir)).drop("d2")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), BYTE_VOCABULARY, capacity=1024, end_id=2)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(documents(spark, sf_dir)).drop("spans")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(documents(spark, sf_dir))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(documents(spark, sf_dir), edit=periodic_runs.looped)


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), shingle=2, least_percent=80)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(merkle.document_leaves(documents(spark, sf_dir)))


QUERIES = {f.__name__: f for f in (
    op1_document_fingerprints, op2_pii, op3_language_id, op4_simhash_near_dedup, op5_token_counts, op6_bpe_codec,
    op7_quality_rules, op8_best_fit_packing, op9_license_scan, op10_secret_scan,
    op11_periodic_runs, op12_minhash_near_dedup, op13_merkle_manifest)}
ORACLE_SQL: dict[str, str] = {}
