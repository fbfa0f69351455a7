"""A training-data pipeline of five stages over ``documents``.

Each stage takes what the one before it kept, as a table on disk, and returns a table. All
but the last return the columns of ``documents``; other columns are left out. Null and empty
texts fail the quality rules; a stage on its own treats them as its operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import bpe, line_dedup, mixing, quality, queries, simhash
from textloom.session import stash


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go."""
    return quality.keep_good(docs.select(*COLUMNS))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier one go, and documents that lose every line."""
    return line_dedup.without_repeated_lines(docs.select(*COLUMNS))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group whose fingerprints of 3-word shingles are linked at 2 bits or fewer the
    document with the smallest id stays. Texts without words have one fingerprint, so one of
    them stays."""
    return simhash.without_near_duplicates(docs.select(*COLUMNS), **queries.NEAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; documents whose words are taken twice come twice."""
    return mixing.mixed_documents(
        docs.select(*COLUMNS), queries.TOTAL_SHARE, queries.MOST_TIMES, queries.MIX_SEED
    )


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and what they decode to."""
    coded = bpe.round_trip(docs.select(*COLUMNS), queries.VOCABULARY)
    return coded.select(
        "doc_id", "source", "lang",
        F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("dedup_lines", dedup_lines),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", mix_sources),
    ("encode_texts", encode_texts),
]

#: SQL cannot make the fingerprints and the tokenizer's results.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
