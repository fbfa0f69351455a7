"""Domain lists of any length."""

import pytest
from pyspark.sql import functions as F

from textloom.functions.text import normalize_title
from textloom.functions.urls import in_domains
from textloom.operators import links as L

URLS = [
    "http://E.com/", "http://www.e.com:80/x", "http://u@e.com/", "http://notE.com/", "http://e.com.org/",
    "http://a.b.d77.net/", "http://d7.net/", "http://xd7.net/", "http://com/", "mailto:x", "", None, "http://e.com/",
]


@pytest.mark.parametrize("broadcast", [True, False])
def test_long_lists_say_what_short_ones_do(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(L, "BROADCAST_HOSTS", 0)
    rows = spark.createDataFrame([(n, u) for n, u in enumerate(URLS)], "id int, url string")
    short = ["e.com", "D77.net", "d7.net"]
    want = {r.id for r in rows.where(in_domains(F.col("url"), short)).collect()}
    table = spark.createDataFrame([(d,) for d in short], "domain string")
    many = spark.range(100_000).select(F.format_string("d%d.example.net", "id").alias("domain"))
    for domains in (table, table.unionByName(many).unionByName(table)):
        got = [r.id for r in L.within_domains(rows, domains).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert L.within_domains(rows, table.limit(0)).count() == len(URLS)
    assert L.within_domains(rows.limit(0), table).count() == 0


def test_titles_numbered_in_other_scripts(spark):
    rows = spark.createDataFrame([("A - Page ٣",), ("A - page 12",), ("A - Page x",)], "t string")
    assert [r.n for r in rows.select(normalize_title(F.col("t")).alias("n")).collect()] == ["A", "A", "A - Page x"]
