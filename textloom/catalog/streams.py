"""Streaming twins. Each stream is run over the whole table and gives what its
batch twin gives, so it is checked with the same SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.catalog import fixtures, items, sql
from textloom.catalog.items import repeated_pages
from textloom.schemas import FAILURE, ITEM
from textloom.session import path_exists, work_path
from textloom.sinks.jsonl import FAILURES_FILE, sink_path
from textloom.sources.jsonl import scan_failed_urls
from textloom.sources.tables import read_table, spread_to, stream_source
from textloom.streaming import failures as S
from textloom.streaming import pages as P


def _run(spark, rows, label, columns):
    path = work_path(spark, label)
    query = P.write_stream(rows, path, work_path(spark, f"{label}-ckpt"), columns, "parquet")
    query.awaitTermination()
    return P.read_back(spark, path, rows.select(*columns).schema)


def _pages(spark, folder):
    """The table is a file or a folder of files; a small one of few files is shared out."""
    slots = spread_to(read_table(spark, folder, "pages"))
    return P.stream_pages(spark, *stream_source(spark, folder, "pages"), spread_to=slots)


def stream_items(spark, folder):
    columns = ["page_id", "title", "url", "content"]
    return _run(spark, P.items_stream(_pages(spark, folder)), "stream-items", columns)


def stream_dedup_urls(spark, folder):
    """URLs of all fetch attempts, each once."""
    urls = fixtures.fetch_log_stream(spark, folder).select("url")
    return _run(spark, P.dedup_stream(urls), "stream-dedup", ["url"])


def stream_dedup_bounded(spark, folder):
    """The same with a key kept for ten years: none is forgotten, no row is too late."""
    urls = fixtures.fetch_log_stream(spark, folder).select("url")
    once = P.dedup_stream(urls, keep_for="3650 days")
    return _run(spark, once, "stream-dedup-bounded", ["url"])


def stream_new_urls(spark, folder):
    processed = fixtures.processed_pages(spark, folder)
    new = P.new_urls_stream(_pages(spark, folder).select("url"), processed)
    return _run(spark, new, "stream-new", ["url"])


def stream_retry_budget(spark, folder):
    failed = S.retry_budget_stream(fixtures.fetch_log_stream(spark, folder))
    return _run(spark, failed, "stream-budget", ["failed_url", "error_code"])


def stream_failed(spark, folder):
    failed = S.failed_stream(fixtures.fetch_log_stream(spark, folder))
    return _run(spark, failed, "stream-failed", ["failed_url", "error_code"])


def stream_failed_all(spark, folder):
    """All failures of the log, appended to the failure sink and scanned back."""
    path = sink_path({"type": "local", "directory_path": work_path(spark, "failures")}, FAILURES_FILE)
    failed = S.all_failures_stream(fixtures.fetch_log_stream(spark, folder))
    ckpt = work_path(spark, "failures-ckpt")
    P.write_stream(failed, path, ckpt, FAILURE.names).awaitTermination()
    return scan_failed_urls(spark, path)


def stream_items_once(spark, folder):
    """Every page twice, the second time under another id: one item each."""
    pages = _pages(spark, folder)
    twice = pages.withColumn("page_id", F.explode(F.array("page_id", F.col("page_id") + 1_000_000)))
    return _run(spark, P.items_stream(twice), "stream-once", ["title", "url", "content"])


def stream_items_first_of_url(spark, folder):
    """A URL's first row decides, as in the batch job."""
    rows = repeated_pages(_pages(spark, folder))
    columns = ["page_id", "title", "url", "content"]
    return _run(spark, P.items_stream(rows), "stream-first", columns)


def stream_items_sink(spark, folder):
    """Items appended as JSON lines, read back from the sink."""
    path = work_path(spark, "sink")
    items = P.items_stream(_pages(spark, folder))
    P.write_stream(items, path, work_path(spark, "sink-ckpt")).awaitTermination()
    if not path_exists(spark, path):  # Nothing has arrived.
        return spark.createDataFrame([], ITEM)
    return spark.read.schema("title string, url string, content string").json(path).select(
        F.col("title"), F.col("url"), F.col("content")
    )


QUERIES = {
    "stream_items": stream_items,
    "stream_dedup_urls": stream_dedup_urls,
    "stream_dedup_bounded": stream_dedup_bounded,
    "stream_new_urls": stream_new_urls,
    "stream_retry_budget": stream_retry_budget,
    "stream_failed": stream_failed,
    "stream_failed_all": stream_failed_all,
    "stream_items_once": stream_items_once,
    "stream_items_first_of_url": stream_items_first_of_url,
    "stream_items_sink": stream_items_sink,
}


def oracles() -> dict[str, str]:
    log = f"WITH {sql.FETCH_LOG}"
    return {
        "stream_items": (
            f"WITH {sql.ITEMS} SELECT doc_id AS page_id, title, url, content FROM items"
        ),
        "stream_dedup_urls": f"{log} SELECT DISTINCT url FROM log",
        "stream_dedup_bounded": f"{log} SELECT DISTINCT url FROM log",
        "stream_new_urls": (
            f"WITH {sql.VISITED} SELECT DISTINCT url FROM pages "
            "WHERE url NOT IN (SELECT url FROM processed)"
        ),
        "stream_retry_budget": f"{log} SELECT failed_url, error_code FROM exhausted",
        "stream_failed": f"{log} SELECT failed_url, error_code FROM at_once",
        "stream_failed_all": f"{log} SELECT * FROM at_once UNION SELECT * FROM exhausted",
        "stream_items_once": f"WITH {sql.ITEMS} SELECT title, url, content FROM items",
        "stream_items_first_of_url": items.oracles()["items_first_of_url"],
        "stream_items_sink": f"WITH {sql.ITEMS} SELECT title, url, content FROM items",
    }
