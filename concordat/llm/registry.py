"""Queries of the language-model operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.llm import decontaminate, near_texts, near_vectors, pieces, quality, substrings, token_index, token_scan, url_filter, warc
from concordat.llm.encode import vocabulary_path
from concordat.llm.oracles import ORACLE_SQL as ORACLE_SQL

BYTE_BPE = "byte_bpe_50k.json"
END_OF_TEXT = 50256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, counted between separators of flat token files."""
    return token_scan.token_counts(table(spark, sf_dir, "documents"), vocabulary_path(BYTE_BPE), END_OF_TEXT).select("doc_id", "n_tokens")


def op9_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum, read back from wavelet matrix files."""
    manifest = token_index.write_index(table(spark, sf_dir, "documents"), vocabulary_path(BYTE_BPE), end_id=2)
    return token_index.read_index(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calibrated quality score of every document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to WARC archives and read back."""
    paths = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, paths).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every vector."""
    return near_vectors.link(table(spark, sf_dir, "embeddings"))


def op4_near_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, links, component and verdict of every document."""
    return near_texts.link(table(spark, sf_dir, "documents")).drop("row", "worded")


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document, and what is left without repeated windows."""
    return substrings.digest(table(spark, sf_dir, "documents"))


PIECE_MODEL = "piece_bpe_32k.model"


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding of every document, checked by decoding it again."""
    return pieces.encode(table(spark, sf_dir, "documents"), vocabulary_path(PIECE_MODEL)).drop("ids")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, verbatim or with other slot values."""
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on the URL of every page; a page's label is that of the document whose number its path names."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    number = F.regexp_extract("url", r"/(\d+)", 1)
    named = pages.where("url is not null").select("url", F.when(number != "", number).cast("long").alias("doc_id"))
    labelled = named.join(labels.select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")), "doc_id").select("url", "bad")
    return url_filter.judge(pages, labelled)


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_decontaminate": op2_decontaminate,
    "op8_pieces": op8_pieces,
    "op7_substrings": op7_substrings,
    "op4_near_texts": op4_near_texts,
    "op10_near_vectors": op10_near_vectors,
    "op5_quality": op5_quality,
    "op6_warc": op6_warc,
    "op3_token_counts": op3_token_counts,
    "op9_token_index": op9_token_index,
}
