"""The corpus queries `opN_<name>`: each applies its operator to its whole table and derives the agreed columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import classifier, license_scan, token_files
from .bpe import encode_decode
from .media import media_report
from .ngram_join import link_components
from .oracles import oracle_sql  # noqa: F401
from .packing import best_fit
from .quality_rules import quality_report
from .spark_io import table
from .substrings import remove_repeats


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(table(spark, sf_dir, "documents"))


def op2_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = token_files.write_token_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_files.read_token_shards(shards)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens (end id included) of every document, counted in flat streams. Which stream a document is in and where
    depends on how the input is split, so these columns stay out."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    blocks, listed = token_files.write_flat(table(spark, sf_dir, "documents"), path, end_id=50256)
    return token_files.count_tokens(blocks, 50256, token_files.id_bytes(path)).join(listed, ["stream", "ordinal"]).select("doc_id", "n_tokens")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fits on the rows of labels whose fold is not 1 and scores every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = classifier.fit(docs, labels.where(classifier.fold(F.col("doc_id")) != 1))
    return classifier.score(docs, model).select("doc_id", (classifier.fold(F.col("doc_id")) == 1).alias("held_out"), "score", "predicted")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of 2048 ids; `item` only tells equal rows apart and depends on how the input is split, so it stays out."""
    return best_fit(table(spark, sf_dir, "documents"), vocabulary=public_tokenizers.path("byte_bpe_50k.json")).drop("item")


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_report(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep=False)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}

