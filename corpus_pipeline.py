"""Corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``.  All but the last return the columns of ``documents``:

1. quality: documents that the weak-label classifier rejects go;
2. exact: of texts equal but for the case of A-Z, the one with the largest doc_id stays;
3. near: of a group linked by SimHash, the document with the smallest doc_id stays;
4. secrets: every secret found is replaced by a mark in its text, and n_chars follows;
5. packing: what is left becomes pieces in token sequences.

Null and repeated ids, null, empty and very long texts, repeated rows, empty tables and further columns of any name are
treated as the operators' docstrings say; no stage judges rows by id, and all but the last hand all columns through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm import exact_dedup, packing, quality, secrets, simhash
from rankloom.session import delete_path, ensure_checkpoint_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("quality", quality_stage), ("exact", exact_stage), ("near", near_stage), ("secrets", secrets_stage), ("packing", packing_stage)]

# The classifier is trained and the tokenizer has no SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between two stages is a Parquet table in the shared folder, deleted once the
    next one is written.  The last of them stays: the result is read from what the packing stage made of it."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
            if before:
                delete_path(spark, f"{folder}/{before}")
            before = name
    return docs
