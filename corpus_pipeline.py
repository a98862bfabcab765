"""Corpus pipeline: language, near duplicates, benchmark passages, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's rows as Parquet into the shared folder and reads them back, so a
stage works on all that its predecessor kept and a lost executor costs only
the running stage's tasks.  All stages but the last return the columns of
``documents``.

* language: documents that language ID rejects go (null texts, texts without
  a letter, texts unlike any learned language).
* near duplicates: of each group linked by 5-word shingles at a Jaccard
  similarity of 0.75 or more, the document of least id stays; where one id
  carries several texts, one of each group; of its repeated rows, one; rows of
  null id stay, as they have no place in a group.
* decontamination: documents that hold a benchmark window go.
* secrets: found spans are replaced by ``[secret]``; n_chars follows.
* tokens: ids of each text, with digests of ids and decoded bytes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipwise.llm import byte_bpe, decontaminate, jaccard_join, language_id, secret_scan
from shipwise.llm.tables import KEPT, bounded, land, unkept


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that language ID does not reject; an empty table stays empty."""
    model = language_id.fit(docs, F.lit(True))
    found = language_id.predict(docs, model, keep=tuple(docs.columns))
    return unkept(found.where("not rejected"), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of least id; rows of null id all stay. Columns of any
    name are carried."""
    found = land(jaccard_join.jaccard_components(docs).documents(classes=True))
    stays = F.col("id") == F.col("component_id")
    ids = land(found.where("id is not null").groupBy(F.col("id").alias("doc_id"))
               .agg(F.max(stays).alias("stays"), F.count("*").alias("n_rows")).where("not stays or n_rows > 1"))
    rest = docs.join(bounded(ids.where("not stays").select("doc_id")), "doc_id", "left_anti").select(*docs.columns)
    repeated = land(ids.where("stays").select("doc_id"))
    if repeated.isEmpty():
        return rest
    # of ids with several rows, one text of each group whose least id it is
    repeated = bounded(repeated)
    kept = found.where(stays).select(F.col("id").alias(KEPT + "doc_id"), F.col("key").alias("class_"), F.col("root").alias("root_")).distinct()
    several = rest.join(repeated, "doc_id", "left_semi").select(*[F.col(c).alias(KEPT + c) for c in docs.columns])
    once = (jaccard_join.with_class(several, KEPT + "text").join(kept, [KEPT + "doc_id", "class_"])
            .dropDuplicates([KEPT + "doc_id", "root_"]))
    return rest.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(unkept(once, docs))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark window; null and empty texts have none."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.scan_documents(docs, items, keep=tuple(docs.columns))
    return unkept(found.where("n_hit = 0"), docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, found spans replaced; rows without a span keep text and n_chars (which need not be there)."""
    found = secret_scan.scan(docs, keep=tuple(docs.columns))
    clean = secret_scan.redacted(found)
    changed = F.size("found") > 0
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    clean = clean.withColumns({KEPT + c: F.when(changed, new[c]).otherwise(F.col(KEPT + c)) for c in new if c in docs.columns})
    return unkept(clean, docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, tokens and digests of every row; a null text counts as empty. The executors still hold what
    earlier stages took, so the tables of known pieces are a third of what encoding alone would have, and the
    batches of text a quarter."""
    out = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids=True,
                          remember=byte_bpe.REMEMBER // 3, batch_bytes=byte_bpe.BATCH_BYTES // 4)
    return out.withColumnRenamed("id", "doc_id")


STAGES = [("language_id", language_stage), ("ngram_jaccard_join", near_duplicate_stage),
          ("benchmark_decontamination", decontamination_stage), ("secret_scan", secret_stage),
          ("byte_bpe", token_stage)]

#: SQL cannot express the trained language stage; tests/llm compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir))
    return docs
