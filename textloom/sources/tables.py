"""Parquet table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.session import bytes_of, is_folder


#: Tables up to this many bytes a slot may be shared out.
SPREAD_BYTES = 32 << 20


def spread_to(df: DataFrame) -> int | None:
    """The tasks to share out a small scan of fewer files than the cluster has slots to.

    One small file is one task. None for a table of more bytes, however few its files are:
    Spark splits them, and they are never shuffled.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    # Only the number of files crosses to Python, not their names.
    files = len(df._jdf.inputFiles())
    small = bytes_of(df) <= slots * SPREAD_BYTES
    return slots if files < slots and small else None


def spread(df: DataFrame) -> DataFrame:
    """``df``, shared out if it is a small scan of few files."""
    slots = spread_to(df)
    return df.repartition(slots) if slots else df


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_source(spark: SparkSession, folder: str, name: str) -> tuple[str, str]:
    """The folder a stream of a table lists, and the pattern of its files there. A table is
    one file or a folder of files; the pattern is held against file names only."""
    path = f"{folder}/{name}.parquet"
    return (path, "*") if is_folder(spark, path) else (folder, f"{name}.parquet")


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Page scan: ``page_id, url, html``."""
    return spread(read_table(spark, folder, "pages").select("page_id", "url", "html"))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Document scan: ``doc_id, content``."""
    documents = read_table(spark, folder, "documents")
    return spread(documents.selectExpr("doc_id", "text AS content"))
