"""From raw documents to packed sequences: the stages, and their run over ``documents``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselens.llm import classifier, exactdedup, packing, quality, simhash
from caselens.llm.common import landed, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Documents less likely good than this go; below the classifier's own threshold, to keep clean ones.
LEAST_QUALITY = 0.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or have little but lines common in their host, go."""
    return quality.kept_rows(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels among ``docs``, scores low go."""
    return classifier.kept_rows(docs, table(spark, sf_dir, "labels"), LEAST_QUALITY)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest doc_id stays."""
    return exactdedup.kept_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts whose fingerprints links of three bits connect the smallest doc_id stays."""
    return simhash.kept_rows(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` for each piece."""
    pieces = packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.packed(
        pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("best_fit_packing", best_fit_packing),
]

# Classifier, fingerprints and tokens can't be said in SQL; tests hold the run against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
