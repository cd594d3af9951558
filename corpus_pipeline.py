"""The corpus pipeline: five stages over ``documents``, each written and read again.

Stages take null, empty and repeated rows, null ids, empty tables and further
columns, whatever their names; what becomes of them is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from concordat.llm import decontaminate, near_texts, pieces, quality, substrings
from concordat.llm.registry import PIECE_MODEL, table, vocabulary_path
from concordat.storage import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject; null and empty texts are judged like one without any difference."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group; texts without words all stay, repeated rows are copies."""
    return near_texts.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier document has; no row goes, rows with null ids stay whole."""
    return substrings.remove(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document that is left; null and empty texts have none."""
    return pieces.encode(docs, vocabulary_path(PIECE_MODEL)).select("doc_id", "n_tokens", "ids_crc32", "round_trip", "ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES):
            docs = materialize(docs, f"stage-{i}-{name.replace(' ', '-')}")
    return docs
