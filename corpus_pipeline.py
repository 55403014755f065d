"""The corpus pipeline: documents without toxic ones and near copies, secrets hidden, mixed and packed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from kinmatch.llm import mixing, packing, secrets, simhash, toxicity
from kinmatch.llm.store import shared_dir, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't find toxic, as they are."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id."""
    return simhash.keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and n_chars counted anew."""
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a repeated document is a repeated row."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document in a training sequence."""
    return packing.pack_documents(docs, forget=True)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("secret_scan", secrets_stage),
    ("mix_sources", mixing_stage),
    ("best_fit_packing", packing_stage),
]
#: SQL can't express the learnt, hashed and packed stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage written as Parquet and read back as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    path = f"{shared_dir(spark)}/kinmatch-pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
    return docs
