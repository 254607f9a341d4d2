"""Cleans, mixes and encodes the documents in five stages.

Each stage takes what the one before kept, written as Parquet and read again. All but the last
return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from noticelake.llm import bpe, linededup, mixing, quality, simhash
from noticelake.llm.common import table
from noticelake.session import scratch_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of ``sf_dir``."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has go, and documents that lose all words."""
    return linededup.without_shared_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: shingles of four words, four bits."""
    return simhash.keep_one(docs, shingle_words=4, max_bits=4)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of small sources again, until the weights are met."""
    return mixing.mixed_rows(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether decoding them gives the text back."""
    return bpe.round_trips(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("line_dedup", shared_lines),
    ("simhash_near_dedup", near_duplicates),
    ("source_mixing", mixture),
    ("bpe_encoding", token_ids),
]

# A trained classifier and fingerprints have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
