"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from deliverylens.llm import (
    alignment,
    bpe,
    decontaminate,
    hnsw,
    licenses,
    merkle,
    pages,
    quality,
    rules,
    secrets,
    simhash,
    tokenstore,
    toolcalls,
)
from deliverylens.llm.oracles import ORACLES

END_ID = 2  # Fixed value: the id that ends a document in token files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = tokenstore.round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), END_ID
    )
    return tokenstore.token_digest(tokens)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(secrets.scan_secrets(table(spark, sf_dir, "documents")))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_pages(table(spark, sf_dir, "pages"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digest_encoded(bpe.encode_documents(table(spark, sf_dir, "documents"), path))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toolcalls.chat_rows(table(spark, sf_dir, "conversations"))


def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.audit_manifest(docs, merkle.without_breaks(docs))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokens(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(table(spark, sf_dir, "documents"), rules.trusted_ids(table(spark, sf_dir, "labels")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_files": op1_token_files,
        "op2_secret_scan": op2_secret_scan,
        "op3_decontamination": op3_decontamination,
        "op4_license_scan": op4_license_scan,
        "op5_main_text": op5_main_text,
        "op6_bpe": op6_bpe,
        "op7_simhash": op7_simhash,
        "op8_tool_calls": op8_tool_calls,
        "op9_near_vectors": op9_near_vectors,
        "op10_quality": op10_quality,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_token_alignment": op12_token_alignment,
        "op13_quality_rules": op13_quality_rules,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return ORACLES
