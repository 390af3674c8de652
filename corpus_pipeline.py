"""A training-corpus pipeline over ``documents``: five stages, each one operator."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import decontaminate, near_dup, packing, quality, secret_scan
from recordloom.llm.scratch import remove, shared_dir, tracked


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from ``labels``."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays."""
    return near_dup.dedup(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret span of the texts is replaced by a mark, n_chars follows; no document goes."""
    length = F.coalesce(F.length("text").cast("long"), F.col("n_chars"))
    return secret_scan.redact(docs).withColumn("n_chars", length).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of at most 4096 tokens."""
    return packing.query(docs)


STAGES = [
    ("quality_classifier", quality_filter),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("secret_scans", secrets_removed),
    ("packing", packed),
]

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again. What a stage has written on its way,
    and the result before it, go once its own result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    before = None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        with tracked() as made:
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        remove(spark, *made)
        if before:
            remove(spark, before)
        before = path
    return docs
