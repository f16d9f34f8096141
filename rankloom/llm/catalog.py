"""The driver's queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import bpe, conversations, exact_dedup, licenses, line_dedup, merkle, minhash, packing, quality, resampling, secrets, simhash, url_filter
from .common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(table(spark, sf_dir, "documents"))


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_fingerprints(table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(table(spark, sf_dir, "conversations"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.minhash_dedup(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_secret_scan, op2_exact_dedup, op3_line_dedup, op4_url_filter, op5_license_scan, op6_best_fit_packing, op7_quality_classifier, op8_simhash_near_dedup,
              op9_document_fingerprints, op10_byte_bpe, op11_conversation_repair, op12_importance_resampling, op13_minhash_near_dedup)
} | {"pipeline": corpus_pipeline.run}

# Where SQL can express the result; the others are tested against brute force.
SQL: dict[str, str] = {
    "op1_secret_scan": secrets.SQL,
    "op2_exact_dedup": exact_dedup.SQL,
    "op4_url_filter": url_filter.SQL,
    "op9_document_fingerprints": merkle.SQL,
    "op12_importance_resampling": resampling.SQL,
    "op13_minhash_near_dedup": minhash.SQL,
}
