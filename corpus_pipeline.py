"""Corpus pipeline: quality classifier, line dedup, SimHash near-dedup, benchmark decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``. All but the last keep the columns of ``documents``; the last returns token counts and digests per row.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tracelake.llm import byte_bpe, decontaminate, line_dedup, quality_crf, simhash_dedup
from tracelake.llm.common import stored

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose lines the random field labels bad (score under 0.3); labels fit the model only."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = quality_crf.held_out()
    model = quality_crf.train(docs.where(~fold), labels.where(~fold))
    return quality_crf.keep_good(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines whose key occurs in ten documents or more; every document stays, maybe with an empty text."""
    return line_dedup.drop_lines(docs, line_dedup.keep_bitmaps(docs, min_docs=10, min_chars=1))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints that differ in two bits or fewer stays: that of the smallest id."""
    return simhash_dedup.representatives(docs, simhash_dedup.near_dedup(docs))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of a benchmark item (similarity 0.8 or more)."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode what is left: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return byte_bpe.token_digests(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_dup_stage),
    ("decontaminate", benchmark_stage),
    ("tokens", token_stage),
]

#: SQL has no conditional random field, no XXH64 of that seed and no byte-pair merges: tests/llm checks by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
