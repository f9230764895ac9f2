"""The corpus pipeline: quality, boilerplate lines, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as Parquet and
read again as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vacancia.llm import common, line_dedup, ngram_join, packing, quality


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = quality.train(docs, common.table(spark, sf_dir, "labels"))
    return quality.keep_good(quality.score(docs, model))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the boilerplate lines of their source."""
    return line_dedup.dedup_lines(docs, host="source", length="n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones."""
    return ngram_join.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of the documents' token pieces in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, size=2048)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("ngram_jaccard_join", near_duplicates),
    ("best_fit_packing", best_fit_packing),
]

#: SQL expresses neither the fitted model nor the tokenizer; tests hold the similarity
#: and packing operators against brute force, quality against held-out labels, and the chain against its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is stored before the next stage reads it."""
    docs = common.table(spark, sf_dir, "documents")
    folder = common.new_folder(spark, "pipeline")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return docs
