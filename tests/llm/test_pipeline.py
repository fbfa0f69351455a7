"""The pipeline's stages, each on what the one before it kept."""

from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline as P
from tests.llm import plain
from textloom.llm import queries, quality
from textloom.session import stash, work_path

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark):
    """The input of every stage, and the result of the last."""
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for name, stage in P.STAGES:
        docs.append(stash(stage(spark, docs[-1], FOLDER), name))
    return docs


def _rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_return_the_columns_of_documents(tables):
    for df in tables[:5]:
        assert df.columns == COLUMNS
        assert df.dtypes == tables[0].dtypes


def test_quality_keeps_what_the_operator_keeps(tables):
    kept = {r.doc_id for r in quality.judge(tables[0]).collect() if r.kept}
    before, after = _rows(tables[0]), _rows(tables[1])
    assert set(after) == kept
    assert all(after[d] == before[d] for d in after)


def test_lines_are_removed_as_by_brute_force(tables):
    before, after = _rows(tables[1]), _rows(tables[2])
    gone = plain.removed_lines([(d, r.text) for d, r in before.items()])
    for d, r in before.items():
        kept = [x for i, x in enumerate(r.text.split("\n")) if (d, i) not in gone]
        if kept:
            assert after[d].text == "\n".join(kept) and after[d].n_chars == len(after[d].text)
        else:
            assert d not in after


def test_one_document_of_each_group_stays(tables):
    before, after = _rows(tables[2]), _rows(tables[3])
    found = plain.components({d: r.text for d, r in before.items()}, 3, 2)
    assert set(after) == {c for _, c in found.values()}


def test_copies_and_fingerprints_two_bits_apart_are_near_duplicates(spark):
    """Random texts, exact copies, and copies with a few words changed, which fall on both
    sides of the limit."""
    rng = np.random.default_rng(5)
    fresh = lambda n: [f"w{x}" for x in rng.integers(0, 1 << 40, n)]
    texts, d = {}, 0
    for n in range(40):
        base = fresh(int(rng.integers(400, 900)))
        for changed in (0, 0, 1, 2, 3):
            for at in rng.choice(len(base), changed, replace=False):
                base[at] = fresh(1)[0]
            texts[d], d = " ".join(base), d + 1
    found = plain.components(texts, 3, 2)
    fps = {k: int(fp, 16) for k, (fp, _) in found.items()}
    apart = [(fps[a] ^ fps[b]).bit_count() for a, b in combinations(fps, 2)]
    assert all(apart.count(n) >= 5 for n in (0, 1, 2, 3, 4))
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    kept = P.simhash_near_dedup(spark, docs, FOLDER)
    assert {r.doc_id for r in kept.collect()} == {c for _, c in found.values()}


def test_mix_meets_its_targets(tables):
    sizes, taken = {}, {}
    for r in tables[3].collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(plain.words(r.text))
    for r in tables[4].collect():
        taken[r.source] = taken.get(r.source, 0) + len(plain.words(r.text))
    for source, target in plain.targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= 64


def test_tokens_decode_to_the_texts(tables):
    found = tables[5].collect()
    assert len(found) == tables[4].count()
    assert all(r.round_trip and len(r.ids) == r.n_tokens for r in found)


def test_run_gives_the_rows_of_the_stages(spark, tables):
    key = lambda r: (r.doc_id, r.n_tokens, tuple(r.ids))
    assert sorted(map(key, P.run(spark, FOLDER).collect())) == sorted(map(key, tables[5].collect()))


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_stages_take_odd_documents(spark, rows):
    docs = plain.odd_documents(spark) if rows == "odd" else plain.no_documents(spark)
    for name, stage in P.STAGES:
        found = stage(spark, docs, FOLDER)
        if name != "encode_texts":
            assert found.columns == COLUMNS
        found.collect()
    folder = work_path(spark, "odd-folder")
    docs.write.parquet(f"{folder}/documents.parquet")
    P.run(spark, folder).collect()
    for name in ("op2_simhash", "op3_pseudo_likelihood", "op5_line_dedup", "op6_sharding", "op7_bpe", "op8_mixing", "op9_quality", "op10_token_rollup"):
        found = queries.QUERIES[name](spark, folder)
        n = found.count()
        assert n == docs.count() or name == "op10_token_rollup"
