"""Batches that go to Python workers are bounded by bytes; the index is counted from its files."""

import pandas as pd
from pyspark.sql import functions as F

from textloom import session
from textloom.llm import bpe, queries
from textloom.operators.extract import decoded_pages
from textloom.plans.index import create_index, open_index, refresh_index
from textloom.schemas import PAGE


def test_batches_are_bounded_by_bytes(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    monkeypatch.setattr(session, "BATCH_BYTES", 1 << 16)
    spark.conf.unset(name)
    try:
        page = (1, "https://a/1", "<p>" + "text " * 200 + "</p>")
        pages = spark.createDataFrame([page] * 1000, PAGE).coalesce(1)
        found = decoded_pages(pages)

        @F.pandas_udf("long")
        def batch_size(html: pd.Series) -> pd.Series:
            return pd.Series([len(html)] * len(html))

        most = pages.select(batch_size("html").alias("n")).agg(F.max("n")).first()[0]
        assert most <= 100
        assert found.where("shown").count() == 1000
        spark.conf.set(name, "1048576")
        session.bound_batches(spark)
        assert spark.conf.get(name).startswith("1048576")
    finally:
        spark.conf.unset(name)


def test_round_trip_is_decoded_encoding(spark):
    texts = [None, "", "a  b", "<|endoftext|> x\n", "é 　c"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 2)], "doc_id long, text string")
    docs = docs.selectExpr("*", "'x' AS ids", "'y' AS decoded")
    once = bpe.round_trip(docs, queries.VOCABULARY)
    apart = bpe.decode_documents(bpe.encode_documents(docs, queries.VOCABULARY), queries.VOCABULARY)
    assert sorted(once.columns) == sorted(apart.columns)
    rows = lambda df: sorted(map(repr, df.select("doc_id", "text", "ids", "decoded").collect()))
    assert rows(once) == rows(apart)
    assert "MapInArrow" in (plan := once._jdf.queryExecution().toString())
    # One pass over the texts: the other is that of the word table, which is on disk by now.
    assert plan.split("== Physical Plan ==")[1].count("MapInArrow") == 1


def test_terms_and_blocks_of_an_index(spark, tmp_path):
    root = str(tmp_path / "index")
    create_index(spark, root)
    docs = [(i, "t", f"u{i}", ["k"] if i % 2 else [], "often " + f"w{i} " * (i % 3 + 1)) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, title string, url string, keywords array<string>, content string")
    refresh_index(frame, root, buckets=2, block_bits=3)
    index = open_index(spark, root)
    df = {(r.field, r.term): r.df for r in index.terms.collect()}
    assert df["content", "often"] == df["title", "t"] == 40
    assert df["keywords", "k"] == 20 and df["content", "w7"] == 1 and len(df) == 43
    blocks = {(r.field, r.term) for r in index.blocks.collect()}
    assert blocks == {("content", "often"), ("title", "t"), ("keywords", "k")}
    assert index.blocks.where("term = 'often'").agg({"n": "sum"}).first()[0] == 40
