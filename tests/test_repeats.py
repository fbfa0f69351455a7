"""Repeated pages, in batch and as a stream; scans by pattern and list."""

import pytest

from textloom.operators import links as L
from textloom.plans.items import pages_to_items
from textloom.sources import jsonl as sources
from textloom.streaming import pages as P

PAGE = "page_id long, url string, html string"


def html(text):
    return f"<title>T</title><p>{text}</p>"


ROWS = [
    (1, "A", html("one")), (5, "A", html("five")), (5, "B", html("b")), (7, "C", "<p></p>"),
    (8, "C", html("late")), (9, "D", html("z")), (9, "D", html("a")), (9, "D", html("a")),
    (None, "E", html("null first")), (3, "E", html("three")), (4, None, html("no url")),
]
WANT = {("A", "one"), ("B", "b"), ("E", "null first")}


@pytest.mark.parametrize("broadcast", [True, False])
def test_first_row_of_a_url(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(L, "BROADCAST_URLS", 0)
    pages = spark.createDataFrame(ROWS, PAGE).repartition(3)
    items = sorted((r.url, r.content) for r in pages_to_items(pages).collect())
    assert items == sorted(WANT | {("D", "a")})
    kept = L.without_repeats(pages)
    assert kept.columns == pages.columns
    assert sorted((str(r.page_id), str(r.url)) for r in kept.collect()) == sorted(
        [("1", "A"), ("5", "B"), ("7", "C"), ("9", "D"), ("None", "E"), ("4", "None")]
    )
    assert L.without_repeats(pages.limit(0)).count() == 0


def test_stream_takes_the_first_row_too(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (ROWS, [(0, "A", html("later batch")), (2, "F", html("new")), (1, "C", html("still late"))]):
        spark.createDataFrame(part, PAGE).coalesce(1).write.mode("append").parquet(source)
        items = P.items_stream(P.stream_pages(spark, source))
        P.write_stream(items, out, str(tmp_path / "ckpt"), ["page_id", "url", "content"], "parquet").awaitTermination()
    got = {(r.url, r.content) for r in spark.read.parquet(out).collect()}
    assert got - {("D", "a"), ("D", "z")} == WANT | {("F", "new")}
    assert spark.read.parquet(out).count() == 5
    assert spark.read.parquet(out).where("url = 'E'").first().page_id is None


def test_scans_by_pattern_and_list(spark, tmp_path, capsys):
    for name in ("a", "b"):
        (tmp_path / f"{name}.jsonl").write_text(f'{{"title": "{name}", "url": "u{name}", "content": "c"}}\n')
    pattern = str(tmp_path / "*.jsonl")
    for scan in (sources.scan_items, sources.scan_documents, sources.scan_processed_urls):
        assert {r.url for r in scan(spark, pattern).collect()} == {"ua", "ub"}
    several = [str(tmp_path / "a.jsonl"), str(tmp_path / "gone.jsonl"), str(tmp_path / "b*")]
    assert sources.scan_items(spark, several).count() == 2
    assert "gone.jsonl" in capsys.readouterr().out
    assert sources.scan_items(spark, str(tmp_path / "*.json")).count() == 0
    with pytest.raises(FileNotFoundError):
        sources.scan_items(spark, str(tmp_path / "no" / "folder" / "x.jsonl"))
