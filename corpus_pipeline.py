"""A corpus in five stages: each reads what the one before has kept, written as Parquet."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from deliverylens.llm import bpe, decontaminate, quality, secrets, simhash
from deliverylens.llm.storage import drop_folders, folders_made, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.keep_one_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; no document goes."""
    return secrets.redact(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as token counts and digests of ids and decoded text."""
    return bpe.digest_encoded(bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality", quality_stage),
    ("simhash", dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("bpe", bpe_stage),
]

# a fitted classifier, hashes of the words and byte pairs are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder. What a stage has written is deleted once
    the next one is, but for the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mark = folders_made()
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        drop_folders(spark, mark, keep=1)
    return docs
