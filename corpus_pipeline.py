"""The corpus pipeline: quality rules, quality classifier, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs; all but the last return the columns of documents. Every stage reads and writes whole texts, so it first has
Spark buffer few of them in each task (`small_buffers`).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import classifier, ngram_join, packing, quality_rules, substrings
from tickloom.llm.spark_io import small_buffers, stored, table

#: No stage but the first is a single relational expression (a fitted model, connected components, greedy packing).
ORACLE_SQL = None


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what a quality rule rejects."""
    small_buffers(spark)
    return quality_rules.filter_quality(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the classifier scores under one half; it is fitted on labelled rows of the whole table, without the held-out fold."""
    small_buffers(spark)
    labels = table(spark, sf_dir, "labels").where(classifier.fold(F.col("doc_id")) != 1)
    return classifier.keep_good(docs, classifier.fit(table(spark, sf_dir, "documents"), labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the least id, of each group of near duplicates."""
    small_buffers(spark)
    return ngram_join.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out of every text what a 200-byte string covers that also starts elsewhere."""
    small_buffers(spark)
    return substrings.keep_unrepeated(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into bins of 2048 token ids: one row for each piece, with its bin."""
    small_buffers(spark)
    return packing.best_fit(docs, vocabulary=public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", rules), ("quality_classifier", quality), ("ngram_jaccard", near_duplicates), ("suffix_array_dedup", repeated_passages), ("best_fit_packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
