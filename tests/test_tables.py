"""Scans, sinks, index life cycle, search requests."""

import json

import pytest
from pyspark.sql import functions as F

from textloom.functions import fixed
from textloom.operators import search as S
from textloom.operators.extract import split_kinds
from textloom.plans import index as I
from textloom.plans.keywords import enrich_documents, enrich_items
from textloom.plans.search import search
from textloom.sinks import jsonl as sinks
from textloom.sources import jsonl as sources

LINES = [
    '{"title": "T", "url": "http://a/1", "content": "c", "keywords": ["k"]}',
    "{bad",
    "[1]",
    "3",
    "null",
    '{"url": "http://a/2", "content": null}',
    '{"url": "http://a/3"}',
    '{"url": "http://a/4", "content": 7}',
    "",
    '{"title": "é", "url": "http://a/1", "content": ""}',
]


@pytest.fixture
def lines(tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    return str(path)


def test_scan_items(spark, lines):
    rows = [tuple(row) for row in sources.scan_items(spark, lines).collect()]
    blank = ("", "", "", [])
    assert sorted(rows) == sorted(
        [
            ("T", "http://a/1", "c", ["k"]),
            blank, blank, blank, blank, blank,
            ("", "http://a/3", "", []),
            ("é", "http://a/1", "", []),
        ]
    )
    bad = [row.value for row in sources.malformed_lines(spark, lines).collect()]
    assert sorted(bad) == ["", "{bad"]


def test_scan_urls(spark, lines, tmp_path):
    urls = [row.url for row in sources.scan_processed_urls(spark, lines).collect()]
    assert sorted(urls) == [f"http://a/{i}" for i in (1, 2, 3, 4)]
    failed = tmp_path / "failed.jsonl"
    failed.write_text(
        '{"failed_url": "u", "error_code": 404}\n{"failed_url": "u", "error_code": 404}\n'
        '{"failed_url": "v", "error_code": "TimeoutError"}\n{"failed_url": "w"}\n'
        '{"url": "x"}\n{oops\n'
    )
    rows = [tuple(row) for row in sources.scan_failed_urls(spark, str(failed)).collect()]
    assert sorted(rows) == [("u", "404"), ("v", "TimeoutError"), ("w", "")]


def test_sinks(spark, tmp_path):
    config = {"type": "local", "directory_path": str(tmp_path)}
    items = spark.createDataFrame(
        [("content é", "u", "title")], "content string, url string, title string"
    )
    path = sinks.write_items(items, config)
    assert path == f"{tmp_path}/final_data.jsonl"
    sinks.write_items(items, config)
    texts = [row.value for row in spark.read.text(path).collect()]
    assert texts == ['{"title":"title","url":"u","content":"content é"}'] * 2
    failures = spark.createDataFrame([("u", "404")], "failed_url string, error_code string")
    path = sinks.write_failures(failures, config)
    assert path == f"{tmp_path}/failed.jsonl"
    assert [tuple(r) for r in sources.scan_failed_urls(spark, path).collect()] == [("u", "404")]


def test_sink_path():
    s3 = {"type": "s3", "s3_bucket": "b"}
    assert sinks.sink_path(s3) == "s3a://b/final_data.jsonl"
    assert sinks.sink_path(s3, sinks.FAILURES_FILE) == "s3a://b/failed.jsonl"
    assert sinks.sink_path({"type": "local", "filename": "f"}) == "./f"
    with pytest.raises(ValueError, match="Non-supported type"):
        sinks.sink_path({"type": "ftp"})


def test_split_kinds(spark):
    rows = spark.createDataFrame(
        [("item", 1), ("other", 2), (None, 3)], "kind string, n int"
    )
    items, others = split_kinds(rows)
    assert [r.n for r in items.collect()] == [1]
    assert sorted(r.n for r in others.collect()) == [2, 3]


def corpus(spark, n=40):
    """Every document has 'common'; a word with its number modulo 4; its own word."""
    words = ["alpha", "beta", "gamma", "delta"]
    rows = [
        (i, f"Title {i % 3} - Page {i}", f"http://e/{i}", f"common {words[i % 4]} own{i} " * 2)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "doc_id long, title string, url string, content string")


def test_keywords_prune_rare_and_common_terms(spark):
    enriched = enrich_documents(corpus(spark)).orderBy("doc_id").collect()
    # 'own' with its digits deleted is in every document, like 'common'.
    words = ["alpha", "beta", "gamma", "delta"]
    assert [row.keywords for row in enriched] == [[words[i % 4]] for i in range(40)]


def test_too_small_a_corpus_has_no_keywords(spark):
    enriched = enrich_documents(corpus(spark, 4)).collect()
    assert [row.keywords for row in enriched] == [[]] * 4


def test_blank_lines_count_as_documents(spark, tmp_path):
    path = tmp_path / "items.jsonl"
    good = [json.dumps({"title": "t", "url": "u", "content": "word"})] * 9
    path.write_text("\n".join(good))
    items = sources.scan_items(spark, str(path))
    assert {tuple(r.keywords) for r in enrich_items(items).collect()} == {()}
    path.write_text("\n".join([*good, "[1]"]))
    items = sources.scan_items(spark, str(path))
    rows = enrich_items(items)
    assert rows.columns == ["title", "url", "keywords", "content"]
    assert sorted(tuple(r.keywords) for r in rows.collect()) == [()] + [("word",)] * 9
    out = sinks.write_enriched(rows, str(tmp_path / "out"))
    sinks.write_enriched(rows, out)
    assert sources.scan_documents(spark, out).count() == 10


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("index") / "i")
    enriched = enrich_documents(corpus(spark))
    assert I.refresh_index(enriched, root) is None
    assert I.create_index(spark, root) and not I.create_index(spark, root)
    assert I.count_documents(spark, root) == 0
    assert I.refresh_index(enriched, root) == I.Refresh(deleted=0, indexed=40)
    assert I.refresh_index(enriched, root, buckets=3) == I.Refresh(deleted=40, indexed=40)
    return I.open_index(spark, root)


def test_index_mapping():
    from textloom.schemas import index_schema

    kinds = {f.name: f.metadata.get("index") for f in index_schema().fields}
    assert kinds == {
        "doc_id": None, "title": "text", "url": "keyword", "keywords": "keyword",
        "content": "text",
    }


def test_rows_without_an_id_stay_separate(spark, tmp_path):
    root = str(tmp_path / "i")
    I.create_index(spark, root)
    rows = spark.createDataFrame(
        [("t", "u", ["k"], "c")] * 3,
        "title string, url string, keywords array<string>, content string",
    )
    assert I.refresh_index(rows, root).indexed == 3
    docs = I.open_index(spark, root).docs
    assert docs.select("doc_id").distinct().count() == 3


def test_search_pages_make_up_the_ranking(spark, index):
    seen = []
    for page in range(1, 5):
        results, totals = search(index, " alpha common ", page=page, size=10)
        rows = sorted(results.collect())
        seen += [row.rank for row in rows]
        titles = [row.title.split(" - ")[0] for row in rows]
        assert len(titles) == len(set(titles)) <= 3
        total = totals.first()
        assert (total.total, total.page, total.size, total.total_pages) == (40, page, 10, 4)
    assert len(seen) == len(set(seen))
    results, totals = search(index, "nothinglikethis")
    assert results.count() == 0 and totals.first().total == 0
    results, totals = search(index, "!!!")
    assert results.count() == 0 and totals.first().total_pages == 0


def test_search_matches_brute_force(spark, index):
    import math

    docs = {r.doc_id: r for r in index.docs.collect()}
    query = "common alpha alpha 7"
    scores = {}
    for field in ("title", "content"):
        texts = {
            i: (d[field].lower().replace(" - ", " ").split()) for i, d in docs.items()
        }
        avg = sum(map(len, texts.values())) / len(texts)
        for i, words in texts.items():
            total = 0.0
            for term in query.split():
                df = sum(term in w for w in texts.values())
                tf = words.count(term)
                if tf:
                    idf = math.log(1 + (len(texts) - df + 0.5) / (df + 0.5))
                    total += idf * 2.2 * tf / (tf + 1.2 * (0.25 + 0.75 * len(words) / avg))
            if total:
                scores[i] = max(scores.get(i, 0.0), round(total, 9))
    want = sorted(scores.items(), key=lambda kv: (-kv[1], kv[0]))
    results, _ = search(index, query, size=40)
    got = sorted((r.rank, r.doc_id, r.score) for r in results.collect())
    place = {doc: i + 1 for i, (doc, _) in enumerate(want)}
    assert got and all(rank == place[doc] for rank, doc, _ in got)
    assert all(abs(score - scores[doc]) < 1e-6 for _, doc, score in got)


def test_a_keyword_is_one_exact_term(spark, index):
    for query, hits in (("alpha", 10), ("Alpha", 0), ("alpha beta", 0)):
        terms = S.query_terms(spark, query)
        scores = S.field_scores(index.postings, index.stats, terms, query)
        assert scores.where(F.col("keywords").isNotNull()).count() == hits
    assert S.search_keywords(index.docs, "alpha").count() == 10


@pytest.mark.parametrize(
    "query, page, size", [("  ", 1, 10), ("a", 0, 10), ("a", 1, 0)]
)
def test_bad_requests(query, page, size):
    with pytest.raises(ValueError):
        S.check_request(query, page, size)


def test_request_is_trimmed():
    assert S.check_request("\u00a0a b\n", 1, 10) == "a b"


def test_totals_are_exact_and_pages_are_capped(spark):
    scored = spark.range(12_000).select(F.col("id").alias("doc_id"), F.lit(1.0).alias("score"))
    row = S.totals(scored, 1, 10).first()
    assert (row.total, row.total_pages) == (12_000, fixed.PAGE_CAP)
    assert S.totals(scored, 1, 1000).first()[::3] == (12_000, 12)


def test_deep_pages_can_be_read(spark):
    scored = spark.range(12_000).select(F.col("id").alias("doc_id"), F.lit(1.0).alias("score"))
    page = S.result_page(scored, 1101, 10).collect()
    assert [(r.rank, r.doc_id) for r in page] == [(11_001 + i, 11_000 + i) for i in range(10)]


def test_missing_files_are_empty(spark, tmp_path, capsys):
    gone = str(tmp_path / "gone.jsonl")
    assert sources.scan_items(spark, gone).count() == 0
    assert sources.scan_processed_urls(spark, gone).count() == 0
    assert sources.scan_failed_urls(spark, gone).count() == 0
    assert sources.scan_documents(spark, gone).count() == 0
    assert "gone.jsonl" in capsys.readouterr().out


def test_hard_lines_are_kept(spark, tmp_path):
    path = tmp_path / "hard.jsonl"
    content = "x" * 21_000_000
    path.write_text(
        '{"url": "u/long", "content": "' + content + '"}\n'
        '{"url": "u/1", "title": "old", "title": "new", "content": "c", "keywords": ["a", "b"]}\n'
        '{"url": "u/2", "keywords": "k", "content": "c"}\n{"url": "u/3", "keywords": 7}\n'
        '{"url": "u/4", "url": "u/5", "keywords": "[k"}\n{bad\n[1]\n'
    )
    items = {r.url: r for r in sources.scan_items(spark, str(path)).collect()}
    assert len(items["u/long"].content) == 21_000_000
    assert (items["u/1"].title, items["u/1"].keywords) == ("new", ["a", "b"])
    assert items["u/2"].keywords == ["k"] and items["u/3"].keywords == ["7"]
    assert items["u/5"].keywords == ["[k"] and "" in items and len(items) == 6
    assert [r.value for r in sources.malformed_lines(spark, str(path)).collect()] == ["{bad"]
    documents = {r.url: r for r in sources.scan_documents(spark, str(path)).collect()}
    assert documents["u/2"].keywords == ["k"] and len(documents["u/long"].content) == 21_000_000
    assert documents["u/1"].keywords == ["a", "b"]
    assert "u/long" in {r.url for r in sources.scan_processed_urls(spark, str(path)).collect()}


def test_empty_index_answers(spark, tmp_path):
    root = str(tmp_path / "index")
    I.create_index(spark, root)
    results, totals = search(I.open_index(spark, root), "word")
    assert results.count() == 0 and totals.first().total == 0
    none = spark.createDataFrame([], "title string, url string, keywords array<string>, content string")
    assert I.refresh_index(none, root) == I.Refresh(0, 0)
    results, totals = search(I.open_index(spark, root), "word")
    assert results.count() == 0 and totals.first().total == 0


def test_file_to_index(spark, tmp_path):
    root, path = str(tmp_path / "index"), tmp_path / "docs.jsonl"
    assert I.index_file(spark, str(path), root) is None
    path.write_text('{"title": "Alpha", "url": "u/1", "keywords": "k", "content": "alpha beta"}\n')
    I.create_index(spark, root)
    assert I.index_file(spark, str(path), root) == I.Refresh(0, 1)
    results, totals = search(I.open_index(spark, root), "beta")
    assert [r.url for r in results.collect()] == ["u/1"] and totals.first().total == 1


def test_pages_are_parsed_once(spark, tmp_path):
    from textloom.plans.items import pages_to_items

    rows = [(i, f"http://e/{i}", f"<title>T{i} words</title><p>some words here {i}") for i in range(40)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "p"))
    pages = spark.read.parquet(str(tmp_path / "p"))
    items = pages_to_items(pages).withColumnRenamed("page_id", "doc_id")
    plans = items._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython")
    enriched = enrich_documents(items)
    after = enriched._jdf.queryExecution().optimizedPlan().toString()
    # One pass for an item, and none is left once items are enriched but that which ranks.
    assert plans == 1 and after.count("ArrowEvalPython") == 1 and "best(" in after
    assert enriched.count() == 40


def zipf_corpus(spark):
    words = ["ab", "cd", "ef", "gh", "ij", "kl", "mn"]
    rows = [
        (i, " ".join(word * (i % 3 + 1) for k, word in enumerate(words, 1) if i % k == 0))
        for i in range(60)
    ]
    return spark.createDataFrame(rows, "doc_id long, content string")


def test_large_vocabularies_are_shuffled(spark, monkeypatch):
    from textloom.operators import keywords as K

    docs = zipf_corpus(spark)
    want = sorted(map(tuple, enrich_documents(docs).collect()))
    assert len({len(row[2]) for row in want}) > 2
    # Room for the most common terms only: they are broadcast, the others shuffled.
    for rows in (1, 5):
        monkeypatch.setattr(K, "BROADCAST_ROWS", rows)
        assert sorted(map(tuple, enrich_documents(docs).collect())) == want
    # Room for none.
    monkeypatch.setattr(K, "BROADCAST_ROWS", 0)
    monkeypatch.setattr("textloom.session.F.broadcast", lambda df: pytest.fail("broadcast"))
    assert sorted(map(tuple, enrich_documents(docs).collect())) == want


def test_no_text_is_shuffled_for_keywords(spark, monkeypatch):
    from textloom.operators import keywords as K

    docs = zipf_corpus(spark).withColumn("extra", F.lit("x"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    near = enrich_documents(docs)
    assert "Exchange" not in plan(near) and near.columns == [*docs.columns, "keywords"]
    want = sorted(map(tuple, near.collect()))
    monkeypatch.setattr(K, "BROADCAST_ROWS", 1)
    far = enrich_documents(docs)
    assert "Exchange" in plan(far) and far.columns == near.columns
    assert sorted(map(tuple, far.collect())) == want


def test_ranks_leave_their_rows_alone(spark, monkeypatch):
    from textloom.operators import keywords as K
    from textloom.plans.keywords import keyword_ranks
    from textloom.session import stash

    docs = zipf_corpus(spark).select("doc_id", "content")
    # Ids that repeat, with other texts, and null ids are ranked together.
    twice = docs.where("doc_id % 3 = 0")
    docs = docs.unionByName(twice.selectExpr("doc_id + 1 AS doc_id", "content"))
    docs = docs.unionByName(twice.selectExpr("CAST(null AS long) AS doc_id", "content"))
    docs = stash(docs.selectExpr("CAST(doc_id AS long) AS doc_id", "content"), "ranked-test")
    counted = stash(K.count_terms(K.preprocess(docs)), "counted-test")
    n, tf = counted.count(), K.term_freq(counted)
    vocabulary = stash(K.doc_freq(tf, n), "vocabulary-test")
    plain = K.top_keywords(tf.join(vocabulary, "term"), n)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r["rank"])
    want = sorted(plain.collect(), key=key)
    found = keyword_ranks(docs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "MapInArrow" in plan
    assert sorted(found.collect(), key=key) == want
    sizes = (vocabulary.count() // 2, 3, 0)
    for rows in sizes:
        monkeypatch.setattr(K, "BROADCAST_ROWS", rows)
        assert sorted(keyword_ranks(docs).collect(), key=key) == want


def test_ranks_in_place_by_plain_python():
    import numpy as np
    import pyarrow as pa

    from textloom.operators.keywords import best_terms

    rng = np.random.default_rng(3)
    terms = sorted(f"t{n}" for n in range(40))
    # Few different weights, so that ties are common.
    idf = {t: float(rng.integers(1, 4)) for t in terms}
    known = pa.table({"term": terms, "idf": [idf[t] for t in terms]})
    rows = [None, []] + [
        [{"term": f"t{n}", "tf": int(rng.integers(1, 4))} for n in rng.choice(60, size, replace=False)]
        for size in rng.integers(0, 50, 60)
    ]
    kind = pa.list_(pa.struct([("term", pa.string()), ("tf", pa.int64())]))
    for counts in (pa.array(rows, kind), pa.array([[], *rows], kind).slice(1), pa.array([], kind)):
        found = best_terms(counts, known, 10).to_pylist()
        for row, got in zip(counts.to_pylist(), found, strict=True):
            held = [(c["tf"] * idf[c["term"]], c["term"]) for c in row or [] if c["term"] in idf]
            assert got == [term for _, term in sorted(held, reverse=True)[:10]]


def test_common_terms_fit_the_limit(spark):
    from textloom.operators.keywords import _common_from

    sizes = [5, 6, 9, 17, 30, 31, 200]
    vocabulary = spark.createDataFrame([(str(n), n) for n in sizes], "term string, df long")
    for limit in range(8):
        cutoff = _common_from(vocabulary, limit)
        broadcast = [] if cutoff is None else [n for n in sizes if n >= cutoff]
        assert len(broadcast) <= limit
    assert _common_from(vocabulary, 4) == 16 and _common_from(vocabulary, 0) is None


def test_shuffles_begin_with_partitions_for_the_input(spark):
    from textloom.session import MOST_PARTITIONS, size_shuffles

    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert size_shuffles(own, 0) == 200
    assert size_shuffles(own, 100 << 40) == MOST_PARTITIONS
    assert size_shuffles(own, (128 << 20) * 300 + 1) == 301
    plan = own.range(100).groupBy(F.col("id") % 7).count()._jdf.queryExecution().executedPlan()
    assert ", 301)" in plan.toString()
