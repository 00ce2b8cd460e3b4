"""From raw documents to packed token ids: quality rules, near-duplicate removal, decontamination, mixing, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gaugelake.llm import decontaminate, mixing, parity, quality, wavelet
from gaugelake.llm.shared import Scratch, importable

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their language's perplexity band."""
    return quality.keep_good(docs)


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with a Jaccard similarity of 0.8 or more on five-word shingles."""
    return parity.keep_one(docs, words=5, percent=80)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that aligns with a test item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their source ask for."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in wavelet files: place, number and checksum of each document's ids, as read back."""
    return wavelet.pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality rules", good),
    ("near duplicates", single),
    ("decontamination", unleaked),
    ("mixing", mixed),
    ("tokens", packed),
]

#: SQL can express neither the language model nor the alignment; tests hold the operators to brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents of a folder; each stage's rows are written to the shared folder."""
    scratch = Scratch(importable(spark), "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
