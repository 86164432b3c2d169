"""A corpus pipeline of five operators, each stage written out before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm import line_dedup, ngram_join, outliers, packing, pii
from vecloom.llm.common import table
from vecloom.llm.queries import tokenizer_path
from vecloom.sources.staging import stage

# Distances, prefix trees, boosted trees and packing have no form in SQL.
ORACLE_SQL = None

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def _with_size(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return outliers.quality_filter(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of repeated windows."""
    return _with_size(line_dedup.dedup_lines(docs).drop("n_lines", "n_removed"))


def ngram_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return ngram_join.one_of_each(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return _with_size(pii.redact_texts(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids (little-endian), sequence_id, offset."""
    pieces = packing.token_pieces(docs, tokenizer_path("word_bpe_49k.json"))
    return packing.pack_pieces(pieces)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_lines),
    ("ngram_duplicates", ngram_duplicates),
    ("personal_data", hide_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
