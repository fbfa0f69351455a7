"""Crawl depth of every URL reachable from the start URLs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.session import bytes_of, stash, work_path


#: Bytes of edges in a bucket.
BUCKET_BYTES = 128 << 20


def _bucketed(edges: DataFrame) -> tuple[DataFrame, str, int]:
    """Edges as a table bucketed by source, in the work folder; its name and buckets."""
    spark = edges.sparkSession
    name = f"textloom_edges_{uuid.uuid4().hex}"
    slots = spark.sparkContext.defaultParallelism
    written = stash(edges, "edges")
    buckets = min(100_000, max(slots, -(-bytes_of(written) // BUCKET_BYTES)))
    rows = written.repartition(buckets, "src").write.bucketBy(buckets, "src").sortBy("src")
    rows.option("path", work_path(spark, "bucketed-edges")).saveAsTable(name)
    return spark.table(name), name, buckets


def _add_level(urls: DataFrame, depth: int, table: str, folder: str, buckets: int) -> None:
    """Append a level to the reached URLs: a folder a depth, a sorted file a bucket."""
    rows = urls.select("url", F.lit(depth).alias("depth")).write.mode("append")
    rows = rows.partitionBy("depth").bucketBy(buckets, "url").sortBy("url")
    rows.option("path", folder).saveAsTable(table)


def _next_level(level: DataFrame, edges: DataFrame, reached: DataFrame, buckets: int) -> DataFrame:
    """Targets of a level that were not reached yet. Level, edges and reached URLs lie in
    the same buckets and stay where they are: only targets move, once each a task, to the
    bucket they belong to."""
    met = level.join(edges, level["url"] == edges["src"])
    targets = met.select(F.col("dst").alias("url")).where("url IS NOT NULL").distinct()
    return targets.repartition(buckets, "url").join(reached.select("url"), "url", "left_anti")


def crawl_frontier(
    starts: DataFrame, edges: DataFrame, max_depth: int | None = None
) -> DataFrame:
    """``url, depth``: fewest links from a start. ``edges`` is ``src, dst``; nulls are no
    URLs.

    Edges are written once, bucketed by source, and so are the URLs each level adds,
    bucketed alike. No level shuffles edges or what was reached before.

    One join per level. Each level is a written table, so lineage stays short and
    a lost executor costs a task, not the walk. Only the newest level is joined to
    the edges, and duplicates are dropped per task before the shuffle.
    """
    spark = starts.sparkSession
    root = work_path(spark, "frontier")
    table = f"textloom_reached_{uuid.uuid4().hex}"
    edges, edge_table, buckets = _bucketed(edges.select("src", "dst").dropna())
    first = starts.select("url").dropna().distinct().repartition(buckets, "url")
    url_type = first.schema["url"].dataType
    depth = 0
    try:
        _add_level(first, depth, table, root, buckets)
        level = spark.table(table).where(F.col("depth") == depth)
        while (max_depth is None or depth < max_depth) and not level.isEmpty():
            fresh = _next_level(level, edges, spark.table(table), buckets)
            depth += 1
            _add_level(fresh, depth, table, root, buckets)
            level = spark.table(table).where(F.col("depth") == depth)
    finally:
        for name in (table, edge_table):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    schema = T.StructType([T.StructField("url", url_type), T.StructField("depth", T.IntegerType())])
    return spark.read.schema(schema).parquet(root)
