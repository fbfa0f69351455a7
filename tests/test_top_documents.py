"""The best documents by blocks, and refreshes that are all or nothing."""

import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import search as S
from textloom.plans import index as I
from textloom.plans import search as Q
from textloom.session import path_exists, paths_matching

COLUMNS = "doc_id long, title string, url string, keywords array<string>, content string"


def corpus(n=600):
    """``common`` is in every document, and often in the first forty; ``rare`` in few."""
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "filler", "stuff"]
    rows = []
    for i in range(n):
        said = rng.choices(words, k=rng.randrange(30, 60)) + ["common"] * (rng.randrange(12, 25) if i < 40 else 1)
        if i % 97 == 5:
            said.append("rare")
        rows.append((i * 10, f"{rng.choice(words)} title", f"u{i}", ["common"] if i % 50 == 7 else [], " ".join(said)))
    return rows


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("top") / "i")
    I.create_index(spark, root)
    I.refresh_index(spark.createDataFrame(corpus(), COLUMNS), root, block_bits=3)
    return I.open_index(spark, root)


def ranking(index, query):
    return [tuple(r) for r in S.rank_all(Q.scored_documents(index, query)).collect()]


@pytest.mark.parametrize(
    "query, count", [("common", 1), ("common rare alpha alpha", 10), ("rare title", 1_000), ("nothing", 10)]
)
def test_blocks_give_the_ranking(index, monkeypatch, query, count):
    monkeypatch.setattr(Q, "ROUNDS", (2, 8))
    best = Q.best_documents(index, query, count)
    want = ranking(index, query)
    assert [tuple(r) for r in S.rank_all(best.hits).collect()] == want[:count]
    assert Q.count_hits(index, query) == len(want)
    if count == 1_000:
        assert best.scored == best.bounds.count()


def test_hopeless_blocks_are_skipped(index, monkeypatch):
    monkeypatch.setattr(Q, "ROUNDS", (2, 8))
    best = Q.best_documents(index, "common", 10)
    # All documents have the word; the best are in the first five blocks or so.
    assert best.bounds.count() >= 600 // 8 and best.scored <= 20
    monkeypatch.setattr(Q, "PUSHED_RANGES", 0)
    again = Q.best_documents(index, "common", 10)
    assert sorted(map(tuple, again.hits.collect())) == sorted(map(tuple, best.hits.collect()))


def test_skipped_postings_are_not_read(spark, index):
    """The places of a round are a filter of the scan, by which row groups are skipped."""
    found = S.matching_postings(index.postings, {"common": 1}, "common")
    some = found.where(Q._places([0, 1, 5], index.block_bits))
    assert 0 < some.count() < found.count() / 5
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = some.where("doc_id >= 0")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :].partition("ReadSchema")[0]
    assert "LessThanOrEqual(pos,15)" in pushed and "GreaterThanOrEqual(pos,40)" in pushed


def test_bounds_hold(index):
    terms = {"common": 1, "rare": 2}
    postings, known, blocks = I.postings_of(index, ["common", "rare", "common rare rare"])
    found = S.matching_postings(postings, terms, "common rare rare")
    known = known.where(F.col("term").isin(*terms)).select("field", "term", "df")
    bounds = S.block_bounds(found, S.matching_postings(blocks, terms, "common rare rare"), index.stats, terms, known, index.block_bits)
    bound = {r.block: r.bound for r in bounds.collect()}
    place = {r.doc_id: r.pos >> index.block_bits for r in found.select("doc_id", "pos").distinct().collect()}
    scores = S.best_field(S.field_scores(found, index.stats, terms, "common rare rare")).collect()
    assert scores and all(r.score <= bound[place[r.doc_id]] + 1e-9 for r in scores)
    assert set(bound) == set(place.values())


def rows(spark, n, word):
    return spark.createDataFrame([(i, "t", f"u{i}", ["k"], f"{word} x") for i in range(n)], COLUMNS)


def totals(spark, root, word):
    return Q.search(I.open_index(spark, root), word).totals.first()["total"]


STEPS = ["_bucket", "_write_terms", "_point_to"]


@pytest.mark.parametrize("step", STEPS)
def test_a_lost_refresh_changes_nothing(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "i")
    I.create_index(spark, root)
    I.refresh_index(rows(spark, 5, "old"), root)
    with monkeypatch.context() as patched:
        patched.setattr(I, step, lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            I.refresh_index(rows(spark, 7, "new"), root)
    assert totals(spark, root, "old") == 5 and totals(spark, root, "new") == 0
    assert I.refresh_index(rows(spark, 7, "new"), root) == I.Refresh(5, 7)
    assert totals(spark, root, "old") == 0 and totals(spark, root, "new") == 7


def test_half_a_pointer_is_none(spark, tmp_path):
    root = str(tmp_path / "i")
    I.create_index(spark, root)
    I.refresh_index(rows(spark, 5, "old"), root)
    (tmp_path / "i" / "current" / "9-lost").mkdir()
    (tmp_path / "i" / "current" / "9-lost" / "part-0.parquet").write_text("")
    assert totals(spark, root, "old") == 5


def test_an_open_index_outlives_a_refresh(spark, tmp_path):
    root = str(tmp_path / "i")
    I.create_index(spark, root)
    I.refresh_index(rows(spark, 5, "old"), root)
    held, folder = I.open_index(spark, root), I.current_version(spark, root)
    I.refresh_index(rows(spark, 7, "new"), root)
    assert Q.search(held, "old").totals.first()["total"] == 5
    I.refresh_index(rows(spark, 9, "newer"), root)
    assert not path_exists(spark, folder)
    assert len(paths_matching(spark, f"{root}/versions/*")) == I.KEPT_VERSIONS
    with pytest.raises(FileNotFoundError):
        I.open_index(spark, str(tmp_path / "none"))
