"""The registered queries of this package and their SQL."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipwise.llm import (byte_bpe, decontaminate, fingerprints, hard_negatives, jaccard_join, language_id, license_scan, line_dedup,
                          quality, secret_scan, spelling, token_counts, toxicity)
from shipwise.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = language_id.crc_part("doc_id", 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held))
    return toxicity.score(docs, model).select(
        F.col("id").alias("doc_id"), F.coalesce(language_id.crc_part("id", 5) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "votes")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, language_id.crc_part("doc_id", 4) != 2)
    return language_id.predict(docs, model).select(
        F.col("id").alias("doc_id"), F.coalesce(language_id.crc_part("id", 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred", "score", "rejected")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest_columns(found)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = byte_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN)
    return out.withColumnRenamed("id", "doc_id")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a cache of its own for each run, so that the query's work does not depend on earlier runs
    cache = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token_counts/{uuid.uuid4().hex}"
    out = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), cache)
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edits(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))
    return found.documents().withColumnRenamed("id", "doc_id")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = language_id.crc_part("doc_id", 5) == 0
    model = quality.fit(docs, quality.grades(table(spark, sf_dir, "labels").where(~held)))
    return quality.score(docs, model).select(
        F.col("id").alias("doc_id"), F.coalesce(language_id.crc_part("id", 5) == 0, F.lit(False)).alias("held_out"),
        "expected_grade", "tail_probability", (F.col("tail_probability") >= 0.5).alias("selected"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest_columns(secret_scan.scan(table(spark, sf_dir, "documents")))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spelling.variants(table(spark, sf_dir, "documents"), damage=97)
    return out.select("word", "form", "root", "n", "n_near", "form_n")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform("embedding", hard_negatives.quantised(256)).alias("embedding"))
    index = hard_negatives.build(rows)
    return hard_negatives.mine(index, rows.where(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("id")))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = line_dedup.file_batches(spark, f"{sf_dir}/documents.parquet", 8)
    out = line_dedup.dedup(table(spark, sf_dir, "documents"), batches)
    return out.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def queries():
    return {f.__name__: f for f in (op1_toxicity, op2_language_id, op3_decontamination, op4_byte_bpe, op5_token_counts,
                                    op6_license_scan, op7_fingerprints, op8_ngram_jaccard, op9_quality, op10_secret_scan,
                                    op11_spelling_variants, op12_hard_negatives, op13_line_dedup)}


def oracle_sql() -> dict[str, str]:
    return {"op3_decontamination": decontaminate.SQL, "op12_hard_negatives": hard_negatives.SQL, "op13_line_dedup": line_dedup.SQL}
