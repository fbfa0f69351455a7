"""Stream queries over tables that are folders of files, and over empty ones."""

import datetime
import os

import pytest

from textloom.catalog import streams
from textloom.schemas import PAGE

EVENT = "event_id long, user_id long, event_type string, ts timestamp, value double, props string"


def page(n: int) -> tuple[int, str, str]:
    body = f"<html><head><title>Page {n}</title></head><body><p>text of {n}</p></body></html>"
    return n, f"https://example.com/{n}", body


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Four pages in three files, of which page 2 is processed; one failed fetch."""
    folder = str(tmp_path_factory.mktemp("folders"))
    pages = spark.createDataFrame([page(n) for n in range(4)], PAGE)
    pages.repartition(3, "page_id").write.parquet(f"{folder}/pages.parquet")
    at = datetime.datetime(2024, 1, 1)
    events = [(1, 2, "view", at, 50.0, '{"k": 1}'), (2, 7, "purchase", at, 5.0, '{"k": 2}')]
    spark.createDataFrame(events, EVENT).repartition(2).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize(
    "name", ["stream_items", "stream_items_once", "stream_items_sink", "stream_items_first_of_url"]
)
def test_items_of_a_folder_of_files(spark, folder, name):
    found = streams.QUERIES[name](spark, folder).collect()
    assert {r.content for r in found} >= {f"text of {n}" for n in range(4)}
    if name != "stream_items_first_of_url":
        assert len(found) == 4


def test_new_urls_and_fetches_of_folders(spark, folder):
    new = [r.url for r in streams.stream_new_urls(spark, folder).collect()]
    assert sorted(new) == [page(n)[1] for n in (0, 1, 3)]
    urls = ["https://u2.example.com/p1", "https://u7.example.com/p2"]
    for query in (streams.stream_dedup_urls, streams.stream_dedup_bounded):
        assert sorted(r.url for r in query(spark, folder).collect()) == urls
    failed = [tuple(r) for r in streams.stream_failed(spark, folder).collect()]
    assert failed == [(urls[1], "404")]


def test_empty_tables(spark, tmp_path):
    for name, schema in (("pages", PAGE), ("events", EVENT)):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name, query in streams.QUERIES.items():
        assert query(spark, str(tmp_path)).collect() == [], name


def open_stores(spark) -> int:
    """Files of state stores that the JVM holds open."""
    jvm = f"/proc/{spark.sparkContext._jvm.java.lang.ProcessHandle.current().pid()}/fd"
    links = []
    for name in os.listdir(jvm):
        try:
            links.append(os.readlink(f"{jvm}/{name}"))
        except FileNotFoundError:
            pass
    return sum("StateStoreId" in link for link in links)


@pytest.mark.skipif(not os.path.isdir("/proc/self/fd"), reason="no /proc")
def test_a_stream_that_has_ended_holds_no_state_store(spark, folder):
    before = open_stores(spark)
    for name in ("stream_items_once", "stream_items_sink"):
        assert streams.QUERIES[name](spark, folder).count() == 4
    assert open_stores(spark) <= before
