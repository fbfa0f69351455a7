"""Token counts as rollups that deltas maintain.

Every batch of changes becomes signed entries per document and tokenizer version: an
insert adds its count, a delete takes back what the document had, a revision does both.
Entries of a batch and their sums by source, language and version are written to folders
named by the batch, so a batch written twice replaces itself and a committed one is
skipped. Totals are sums over the small rollup folders; texts are counted once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.bpe_ranks import PATTERN, read_ranks
from textloom.session import path_exists, stash

ENTRIES = "doc_id long, source string, lang string, version string, docs long, tokens long"
ROLLUP = "source string, lang string, version string, docs long, tokens long"


def word_counter() -> Callable[[list[str]], list[int]]:
    """Words cut at ASCII white space."""
    return lambda texts: [len(t.encode().split()) for t in texts]


def rank_counter(path: str) -> Callable[[list[str]], list[int]]:
    """Tokens of a byte-level BPE given as a rank file; special tokens count as text."""
    coder = tiktoken.Encoding(
        "ranks", pat_str=PATTERN, mergeable_ranks=read_ranks(path), special_tokens={}
    )
    return lambda texts: [len(coder.encode_ordinary(t)) for t in texts]


def count_tokens(docs: DataFrame, versions: dict[str, Callable]) -> DataFrame:
    """A row for each row of ``docs`` and version, with ``tokens``. ``versions`` maps a
    name to a function that makes a counter in the task. A null text has no tokens."""
    names = list(versions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = {n: versions[n]() for n in names}
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            others = [batch.column(c) for c in ("doc_id", "source", "lang")]
            for name, counter in counters.items():
                yield pa.RecordBatch.from_arrays(
                    [*others, pa.array([name] * len(texts)), pa.array(counter(texts), pa.int64())],
                    names=["doc_id", "source", "lang", "version", "tokens"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), "source", "lang", "text")
    return rows.mapInArrow(
        run, "doc_id long, source string, lang string, version string, tokens long"
    )


class TokenRollup:
    """Totals under ``root``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str, versions: dict[str, Callable]) -> None:
        self.spark, self.root, self.versions = spark, root.rstrip("/"), versions

    def _folder(self, kind: str, batch: str) -> str:
        return f"{self.root}/{kind}/batch={batch}"

    def committed(self, batch: str) -> bool:
        return path_exists(self.spark, f"{self._folder('rollup', batch)}/_SUCCESS")

    def _read(self, kind: str, schema: str) -> DataFrame:
        """Rows with the ``batch`` they belong to."""
        folder, schema = f"{self.root}/{kind}", f"{schema}, batch string"
        if not path_exists(self.spark, folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(folder)

    def state(self) -> DataFrame:
        """What the documents count now: a row for each document, group and version."""
        keys = ["doc_id", "source", "lang", "version"]
        # The rollup is written last: entries of a batch without one are of a broken run.
        done = self._read("rollup", ROLLUP).select("batch").distinct()
        entries = self._read("entries", ENTRIES).join(done, "batch", "left_semi")
        summed = entries.groupBy(*keys).agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")
        )
        return summed.where("docs <> 0 OR tokens <> 0")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Applies ``op, doc_id, source, lang, text`` once; false if ``batch`` was applied.

        ``insert`` adds a row's counts under its source and language, ``delete`` takes
        back all that its ``doc_id`` counts, ``revise`` does both. Repeated inserts count
        each; repeated deletes of a document count once; a delete of an unknown document
        or an empty batch changes nothing. A null ``doc_id`` can be deleted like any other.
        """
        if self.committed(batch):
            return False
        added = count_tokens(changes.where("op IN ('insert', 'revise')"), self.versions)
        plus = added.select(
            "doc_id", "source", "lang", "version", F.lit(1).cast("long").alias("docs"), "tokens"
        )
        gone = changes.where("op IN ('delete', 'revise')").select(
            F.struct(F.col("doc_id").cast("long").alias("doc_id")).alias("gone")
        ).distinct()
        before = self.state()
        minus = before.join(gone, F.struct("doc_id") == F.col("gone"), "left_semi").select(
            "doc_id", "source", "lang", "version", -F.col("docs"), -F.col("tokens")
        ).toDF("doc_id", "source", "lang", "version", "docs", "tokens")
        # Through a copy, since Spark does not overwrite a folder it reads.
        entries = stash(plus.unionByName(minus), "rollup-entries")
        entries.write.mode("overwrite").parquet(self._folder("entries", batch))
        sums = entries.groupBy("source", "lang", "version").agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")
        )
        sums.write.mode("overwrite").parquet(self._folder("rollup", batch))
        return True

    def totals(self) -> DataFrame:
        """``source, lang, version, n_docs, n_tokens``; groups that are empty now are left out."""
        return (
            self._read("rollup", ROLLUP).groupBy("source", "lang", "version")
            .agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
            .where("n_docs <> 0 OR n_tokens <> 0")
        )


def cleaning_batches(docs: DataFrame) -> list[tuple[str, DataFrame]]:
    """Three batches from one corpus: all documents are inserted, later exact copies are
    deleted, and texts that repeat a line are revised to hold it once."""
    columns = ["op", "doc_id", "source", "lang", "text"]
    load = docs.withColumn("op", F.lit("insert")).select(*columns)
    by_text = docs.select("doc_id", F.sha2(F.encode("text", "UTF-8"), 256).alias("h"))
    first = by_text.groupBy("h").agg(F.min("doc_id").alias("first"))
    copies = by_text.join(first, "h").where("doc_id > first").select(
        F.lit("delete").alias("op"), "doc_id", *[F.lit(None).cast("string").alias(c) for c in columns[2:]]
    )
    lines = F.split("text", "\n")
    once = F.array_distinct(lines)
    leads = first.select(F.col("first").alias("doc_id"))
    revised = (
        docs.where(F.size(lines) > F.size(once)).join(leads, "doc_id", "left_semi")
        .withColumns({"text": F.array_join(once, "\n"), "op": F.lit("revise")}).select(*columns)
    )
    return [("load", load), ("copies", copies), ("lines", revised)]
