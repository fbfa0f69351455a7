"""The search index as five tables under one folder.

``docs`` holds the stored fields, ``postings`` the terms, ``terms`` their document
frequencies, ``blocks`` what a common term is worth at best in each block of documents,
``stats`` one row per field, and one of the layout. All but docs and stats lie in term-hash
folders and are range-sorted by term and document inside them: a search reads the folders
of its terms only, and a very common term is spread over several files.

Documents are numbered in the order they are stored in; 2^bits neighbours are a block, and
postings carry the number, so that a scan for some blocks skips the rest of a term.

A refresh writes a version of its own and then a pointer to it. Readers open the version
the newest whole pointer names, so a refresh that is lost on the way changes nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import postings as P
from textloom.operators.search import saturation
from textloom.schemas import BLOCK, FIELD_STATS, POSTING, TERM, index_schema
from textloom.session import bytes_of, path_exists, paths_matching, remove_path, small_or_shuffled, stash
from textloom.sources.jsonl import scan_documents

#: Term folders of a small index. A larger one gets one for so many bytes of analysed text.
TERM_BUCKETS = 16
BUCKET_BYTES = 8 << 30
#: Bytes of analysed text on disk that one writing task takes. Its postings are some ten
#: times that in memory, and are sorted there.
TASK_BYTES = 32 << 20
#: Documents of a block, as a power of two.
BLOCK_BITS = 12
#: Common terms that may be broadcast while blocks are written.
BROADCAST_TERMS = 500_000
#: Versions a refresh leaves: the new one and that before, which may be open still.
KEPT_VERSIONS = 2
#: The row of ``stats`` that is there in an empty index too.
_LAYOUT = "*"


@dataclass(frozen=True)
class Refresh:
    deleted: int
    indexed: int


@dataclass(frozen=True)
class Index:
    docs: DataFrame
    postings: DataFrame
    terms: DataFrame
    blocks: DataFrame
    stats: DataFrame
    buckets: int
    block_bits: int


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _pointers(spark: SparkSession, root: str) -> list[str]:
    """Folders of the whole pointers, oldest first."""
    found = paths_matching(spark, f"{root}/current/*/_SUCCESS")
    return sorted((path.rpartition("/")[0] for path in found), key=_number)


def _number(pointer: str) -> int:
    return int(pointer.rpartition("/")[2].partition("-")[0])


def _version_of(pointer: str) -> str:
    """A pointer's name is its number and the version it names."""
    return pointer.rpartition("/")[2].partition("-")[2]


def _point_to(spark: SparkSession, root: str, version: str) -> None:
    """Make a version the current one. The mark that ends the write is one small file, so
    the pointer is there as a whole or not at all."""
    pointers = _pointers(spark, root)
    number = _number(pointers[-1]) + 1 if pointers else 0
    name = spark.createDataFrame([(version,)], "version string")
    name.coalesce(1).write.parquet(f"{root}/current/{number}-{version}")


def current_version(spark: SparkSession, root: str) -> str | None:
    """Folder of the tables to read; None where there is no index."""
    pointers = _pointers(spark, root)
    return f"{root}/versions/{_version_of(pointers[-1])}" if pointers else None


def index_exists(spark: SparkSession, root: str) -> bool:
    return bool(_pointers(spark, root))


def create_index(spark: SparkSession, root: str) -> bool:
    """Create an empty index with the field mapping; False if there is one already."""
    if index_exists(spark, root):
        return False
    version = uuid.uuid4().hex
    folder = f"{root}/versions/{version}"
    for name, schema in (
        ("postings", POSTING), ("terms", TERM), ("blocks", BLOCK), ("docs", index_schema())
    ):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}")
    _write_stats(spark.createDataFrame([], FIELD_STATS), TERM_BUCKETS, BLOCK_BITS, folder)
    _point_to(spark, root, version)
    return True


def _write_stats(stats: DataFrame, buckets: int, block_bits: int, folder: str) -> None:
    layout = stats.sparkSession.createDataFrame(
        [(_LAYOUT, 0, None, buckets, block_bits)], FIELD_STATS
    )
    rows = stats.select(
        "field", "n_docs", "avgdl", F.lit(buckets).alias("buckets"), F.lit(block_bits).alias("block_bits")
    )
    rows.union(layout).coalesce(1).write.parquet(f"{folder}/stats")


def refresh_index(
    enriched: DataFrame, root: str, buckets: int | None = None, block_bits: int = BLOCK_BITS
) -> Refresh | None:
    """Replace all documents of an index and its postings, all or nothing; None without an
    index.

    ``enriched`` has the stored fields and may bring a ``doc_id``; rows without
    one are numbered, so equal rows stay separate documents. The number of term folders
    and of writing tasks follows from the bytes of analysed text. Of older versions the
    last stays, for searches that have it open. Refreshes of one index run one at a time.
    """
    spark = enriched.sparkSession
    if not index_exists(spark, root):
        print(f"No index at '{root}': create it first.")
        return None
    deleted = count_documents(spark, root)
    version = uuid.uuid4().hex
    folder = f"{root}/versions/{version}"
    if "doc_id" not in enriched.columns:
        enriched = enriched.withColumn("doc_id", F.monotonically_increasing_id())
    fields = [F.col(field.name).cast(field.dataType) for field in index_schema().fields]
    # Written first: sorting by range would compute the rows twice, to sample and to sort.
    stored = stash(enriched.select(*fields), "documents-to-index")
    # Sorted by id, so that fetching a page of results skips all other row groups.
    ordered = stored.repartitionByRange(_tasks(stored), "doc_id").sortWithinPartitions("doc_id")
    ordered = ordered.withColumn("pos", F.monotonically_increasing_id())
    ordered.write.option("parquet.bloom.filter.enabled#url", "true").parquet(f"{folder}/docs")
    written = spark.read.schema(ordered.schema).parquet(f"{folder}/docs")
    keys = ("doc_id", "pos")
    analyzed = stash(P.analyze_documents(written, keys=keys), "analyzed")
    buckets = buckets or max(TERM_BUCKETS, -(-bytes_of(analyzed) // BUCKET_BYTES))
    stats = P.field_stats(analyzed).collect()
    postings = P.build_postings(analyzed, keys).withColumn("bucket", _bucket(F.col("term"), buckets))
    (
        postings.repartitionByRange(_tasks(analyzed), "bucket", "term", "doc_id")
        .sortWithinPartitions("bucket", "term", "doc_id")
        .write.partitionBy("bucket")
        .parquet(f"{folder}/postings")
    )
    _write_terms(spark, {row["field"]: row["avgdl"] for row in stats}, block_bits, folder)
    stats = spark.createDataFrame(stats, "field string, n_docs long, avgdl double")
    _write_stats(stats, buckets, block_bits, folder)
    indexed = stored.count()
    _point_to(spark, root, version)
    remove_old_versions(spark, root)
    return Refresh(deleted=deleted, indexed=indexed)


def _write_terms(spark: SparkSession, lengths: dict[str, float], block_bits: int, folder: str) -> None:
    """Document frequencies, and blocks of the common terms: those in at least a block's
    number of documents. The others would have about as many rows as postings.

    Both are counted from the written postings: a file of these has its terms side by side,
    so tasks hand on about a row a term, and blocks are made of common terms only.
    """
    postings = spark.read.schema(POSTING).parquet(f"{folder}/postings")
    counts = postings.groupBy("bucket", "field", "term").agg(F.count(F.lit(1)).alias("df")).select(*TERM.names)
    counts.repartition("bucket").sortWithinPartitions("term").write.partitionBy("bucket").parquet(f"{folder}/terms")
    known = spark.read.schema(TERM).parquet(f"{folder}/terms")
    common = known.where(F.col("df") >= (1 << block_bits)).select("bucket", "field", "term")
    common = small_or_shuffled(common, "common-terms", BROADCAST_TERMS)
    mean = F.coalesce(*[F.when(F.col("field") == f, F.lit(n)) for f, n in lengths.items()], F.lit(1.0))
    share = saturation(F.col("tf"), F.col("dl"), mean)
    found = postings.join(common, ["bucket", "field", "term"], "left_semi")
    blocks = found.groupBy("bucket", "field", "term", F.shiftright("pos", block_bits).alias("block")).agg(
        F.count(F.lit(1)).alias("n"), F.max(share).alias("best")
    )
    blocks = blocks.select(*BLOCK.names).repartition("bucket").sortWithinPartitions("term", "block")
    blocks.write.partitionBy("bucket").parquet(f"{folder}/blocks")


def remove_old_versions(spark: SparkSession, root: str, keep: int = KEPT_VERSIONS) -> None:
    """Remove all versions that were current before the last ``keep``."""
    for pointer in _pointers(spark, root)[: -max(1, keep)]:
        # The tables first: a pointer without them is never the newest.
        remove_path(spark, f"{root}/versions/{_version_of(pointer)}")
        remove_path(spark, pointer)


def _tasks(table: DataFrame) -> int:
    slots = table.sparkSession.sparkContext.defaultParallelism
    return max(slots, -(-bytes_of(table) // TASK_BYTES))


def index_file(spark: SparkSession, path: str, root: str) -> Refresh | None:
    """Refresh an index from a JSON-lines file of enriched documents; None, with a
    message, where there is no index or no such file."""
    if not path_exists(spark, path):
        print(f"No file at '{path}': the index stays as it is.")
        return None
    numbered = scan_documents(spark, path).withColumn("doc_id", F.monotonically_increasing_id())
    return refresh_index(stash(numbered, "numbered-documents"), root)


def open_index(spark: SparkSession, root: str) -> Index:
    """The current version. It stays readable until two refreshes later."""
    folder = current_version(spark, root)
    if folder is None:
        raise FileNotFoundError(f"No index at '{root}': create it first.")
    stats = spark.read.schema(FIELD_STATS).parquet(f"{folder}/stats")
    layout = stats.where(F.col("field") == _LAYOUT).first()
    return Index(
        docs=spark.read.schema(index_schema()).parquet(f"{folder}/docs"),
        postings=spark.read.schema(POSTING).parquet(f"{folder}/postings"),
        terms=spark.read.schema(TERM).parquet(f"{folder}/terms"),
        blocks=spark.read.schema(BLOCK).parquet(f"{folder}/blocks"),
        stats=stats.where(F.col("field") != _LAYOUT).drop("buckets", "block_bits"),
        buckets=layout["buckets"],
        block_bits=layout["block_bits"],
    )


def count_documents(spark: SparkSession, root: str) -> int:
    return open_index(spark, root).docs.count()


def _folders(index: Index, terms: list[str]) -> list[int]:
    names = index.docs.sparkSession.createDataFrame([(term,) for term in terms], "term string")
    rows = names.select(_bucket(F.col("term"), index.buckets).alias("bucket")).collect()
    return sorted({row["bucket"] for row in rows})


def postings_of(index: Index, terms: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Postings, document frequencies and blocks, limited to the folders that can hold
    ``terms``."""
    inside = F.col("bucket").isin(*_folders(index, terms))
    return index.postings.where(inside), index.terms.where(inside), index.blocks.where(inside)
