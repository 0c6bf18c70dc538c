"""From raw documents to token ids: quality, repeated lines, near copies, benchmark passages, encoding.

Each stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor kept and returns the columns of ``documents``, but
the last, which returns the token ids. ``run`` writes each stage's result to the shared folder and reads it back, so a lost
executor costs one stage's tasks at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from longspan.llm import bpe, decontaminate, lineruns, nearprints, quality
from longspan.llm.queries import TOKENIZER
from longspan.session import remove, scratch_path, temporary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the label model keeps."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that an earlier document has; those left without a word are gone."""
    return lineruns.remove_repeats(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, linked at a similarity of five-word shingles of about 0.8 or more."""
    return nearprints.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left."""
    encoded = bpe.encode(docs.select("doc_id", "text"), public_tokenizers.path(TOKENIZER))
    return encoded.select("doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"), "token_ids")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash_near_dedup", near_dedup),
          ("benchmark_decontamination", decontamination), ("bpe_encoding", encoding)]
#: Stages that fit a model or hash with algorithms of their own are beyond SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with temporary(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
