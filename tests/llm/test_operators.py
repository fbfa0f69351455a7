"""Every operator against SQL or a brute-force version, on a whole table and on odd rows."""

import math
import re
import random
import time
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.compare import compare, connect
from tests.llm import plain
from textloom.llm import (
    bpe, chat_format, line_dedup, mixing, pseudo_likelihood, quality, queries, segment_topk,
    sharding, simhash, token_rollup,
)
from textloom.session import work_path

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, queries.QUERIES[name], queries.ORACLE_SQL[name]) is None


# --- 1 ---


def test_topk_odd_vectors(spark):
    rows = [(i, [math.sin(i * 7 + j) for j in range(9)]) for i in range(0, 230)]
    rows += [(300, None), (400, [None] * 9), (500, [float("nan")] * 9), (600, [1.0, 2.0]),
             (601, [3.0, -2.5]), (None, [0.5] * 9), (700, []), (701, []), (7000, [0.25] * 9)]
    rows[50] = (50, rows[60][1])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS id", "'y' AS v")
    found = segment_topk.top_k(df, queries.F.col("id") % 100 == 0, 10).collect()
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in found}
    floats = [(i, None if v is None else [None if x is None else np.float32(x) for x in v]) for i, v in rows]
    assert got == plain.top(floats, 10)
    assert segment_topk.top_k(df.limit(0), queries.F.col("id") % 100 == 0, 10).count() == 0


def test_topk_few_candidates_and_ties(spark):
    rows = [(0, [1.0, 1.0]), (5, [1.0, 0.0]), (3, [1.0, 0.0]), (9, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = segment_topk.top_k(df, queries.F.col("id") % 100 == 0, 10).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in found] == [(3, 1048576), (5, 1048576), (9, 1048576)]


# --- 2 ---


def test_simhash_query(spark, documents):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op2_simhash(spark, FOLDER).collect()}
    assert got == plain.components({d.doc_id: d.text for d in documents}, 3, 2)


def test_simhash_odd_documents(spark):
    docs = plain.odd_documents(spark)
    found = simhash.near_duplicates(docs, words=3, radius=2, parts=4).collect()
    assert len(found) == docs.count()
    want = plain.components({r.doc_id: r.text for r in docs.collect() if r.doc_id}, 3, 2)
    for r in found:
        if r.doc_id:
            assert (f"{r.fp % (1 << 64):016x}", r.component_id) == want[r.doc_id]
    kept = simhash.without_near_duplicates(docs, words=3, radius=2, parts=4)
    # A row without an id is no copy of others where no group has its text.
    ids = Counter(r.doc_id for r in kept.collect())
    assert {d for d in ids if d} == {c for _, c in want.values()} and max(ids.values()) == 1
    assert simhash.near_duplicates(plain.no_documents(spark)).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5, 12])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    a = rng.integers(0, 1 << 63, 130, dtype=np.uint64)
    a[65:] = a[:65] ^ (np.uint64(1) << rng.integers(0, 64, 65).astype(np.uint64))
    want = {(i, j) for i in range(130) for j in range(130) if int(a[i] ^ a[j]).bit_count() <= radius}
    i, j = simhash.near_pairs(a, a, radius)
    assert set(zip(i.tolist(), j.tolist())) == want


def test_simhash_links_of_a_large_bucket(spark, monkeypatch):
    """Buckets beyond a block are compared block by block, and no link is lost."""
    monkeypatch.setattr(simhash, "BLOCK", 20)
    rng = np.random.default_rng(3)
    base = 0x0123456789ABCDEF
    fps = {base}
    while len(fps) < 150:
        fps.add(base ^ (1 << int(rng.integers(0, 16))) ^ (1 << int(rng.integers(0, 16))) ^ (1 << int(rng.integers(0, 16))))
    near = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 1]
    rows = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = [(r.a, r.b) for r in simhash.near_links(rows, 1, 3).collect()]
    assert all(a in fps and b in fps for a, b in links)
    assert plain.linked(fps, links) == plain.linked(fps, near)


# --- 3 ---


def test_pseudo_likelihood_learns_word_order(spark):
    rng = np.random.default_rng(5)
    cycle = [f"c{i}" for i in range(40)]
    texts = []
    for n in range(600):
        at = int(rng.integers(0, 40))
        texts.append(" ".join(cycle[(at + i) % 40] for i in range(400)))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = docs.coalesce(2)
    vocabulary = pseudo_likelihood.build_vocabulary(docs)
    flat = pseudo_likelihood.train_network(docs, vocabulary)
    mixed = " ".join(rng.permutation(texts[0].split()))
    held = spark.createDataFrame(
        [(1, " ".join(cycle[(7 + i) % 40] for i in range(200))), (2, mixed), (3, None), (4, " ")],
        "doc_id long, text string",
    )
    got = {r.doc_id: r for r in pseudo_likelihood.score_documents(held, vocabulary, flat).collect()}
    assert got[1].per_token > got[2].per_token + 0.5
    assert (got[3].n_tokens, got[3].log_likelihood, got[3].per_token) == (0, 0.0, None)
    assert got[4].n_tokens == 0


def test_pseudo_likelihood_sums_all_tokens(spark):
    docs = plain.odd_documents(spark)
    vocabulary = pseudo_likelihood.build_vocabulary(docs)
    flat = pseudo_likelihood.train_network(docs, vocabulary)
    network = pseudo_likelihood.Network(vocabulary, flat)
    # Probabilities of all classes at one place add up to one.
    around = np.array([[0], [1], [2], [3]])
    tokens = np.arange(len(vocabulary.class_of))
    each = network.log_probabilities(np.repeat(around, len(tokens), axis=1), tokens)
    assert abs(np.exp(each).sum() - 1) < 1e-3
    found = pseudo_likelihood.score_documents(docs, vocabulary, flat).collect()
    assert len(found) == docs.count()
    for r, text in {r.doc_id: (r, None) for r in found if r.doc_id in (7, 11)}.values():
        text = next(d.text for d in docs.collect() if d.doc_id == r.doc_id)
        ids = pseudo_likelihood.token_ids(text, vocabulary)
        rows = pseudo_likelihood.windows(ids, np.array([len(ids)]), vocabulary.size - 1)
        want = sum(float(network.log_probabilities(rows[:, [i]], ids[[i]])[0]) for i in range(min(len(ids), 50)))
        if len(ids) <= 50:
            assert abs(r.log_likelihood - want) < 1e-3
        assert r.n_tokens == len(plain.words(text))
    assert pseudo_likelihood.score_corpus(plain.no_documents(spark)).count() == 0


def test_pseudo_likelihood_gives_every_word_its_probability(spark, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "KNOWN_WORDS", 8)
    monkeypatch.setattr(pseudo_likelihood, "LISTED_WORDS", 60, raising=False)
    said = [f"w{i}" for i in range(300) for _ in range(1 + i % 7)]
    random.Random(3).shuffle(said)
    docs = spark.createDataFrame(
        [(i, " ".join(said[i::40])) for i in range(40)], "doc_id long, text string"
    )
    vocabulary = pseudo_likelihood.build_vocabulary(docs)
    flat = pseudo_likelihood.train_network(docs, vocabulary)
    alone = spark.createDataFrame([(i, f"w{i}") for i in range(300)], "doc_id long, text string")
    scored = pseudo_likelihood.score_documents(alone, vocabulary, flat).collect()
    each = {r.doc_id: r.log_likelihood for r in scored}
    # Whether known, listed or counted in the table only: all words there are, and nothing else.
    assert abs(sum(math.exp(x) for x in each.values()) - 1) < 1e-3
    count = Counter(said)
    kept = {w.decode(): vocabulary.ids[w] for w in vocabulary.ids}
    assert len(kept) == 60 and max(count[f"w{i}"] for i in range(300) if f"w{i}" not in kept) > 1
    known = math.isqrt(len(said))
    assert len(vocabulary.class_of) == known + known // 16
    # Two words of one shared token differ by how often they were counted.
    by_token = {}
    for i in range(300):
        if kept.get(f"w{i}", known) >= known:
            by_token.setdefault(int(pseudo_likelihood.token_ids(f"w{i}", vocabulary)[0]), []).append(i)
    for of_token in by_token.values():
        bases = [each[i] - math.log(count[f"w{i}"]) for i in of_token]
        assert max(bases) - min(bases) < 1e-5
    # A text is the sum over its words, repeats included.
    network = pseudo_likelihood.Network(vocabulary, flat)
    text = docs.where("doc_id = 5").first().text
    ids = pseudo_likelihood.token_ids(text, vocabulary)
    around = pseudo_likelihood.windows(ids, np.array([len(ids)]), vocabulary.size - 1)
    border = np.full((4, len(ids)), vocabulary.size - 1)
    want = (network.log_probabilities(around, ids) - network.log_probabilities(border, ids)).sum()
    want += sum(each[int(w[1:])] for w in text.split())
    got = pseudo_likelihood.score_documents(docs.where("doc_id = 5"), vocabulary, flat).first()
    assert abs(got.log_likelihood - want) < 1e-3


# --- 4 ---


def test_chat_odd_conversations(spark):
    odd = "</s>[INST] ok [/INST]"
    rows = [
        (1, 1, "assistant", odd), (1, 0, "user", odd), (1, 2, "assistant", r"<\/s> [\INST] \ <|x|>"),
        (1, 3, "assistant", ""), (1, 4, "user", None), (2, None, None, "null turn\n\nand role"),
        (2, 0, "tool[INST]", "x\ny"), (2, 0, "a", "tie"), (2, 0, "a", "tie"), (None, 5, "assistant", "é\U0001f600" * 3000),
        (3, 0, "assistant", "</s"), (3, 1, "assistant", "> [/INST"), (3, 2, "user", "]"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = turns.selectExpr("*", "'x' AS turns", "1 AS starts", "2 AS formatted")
    done = chat_format.format_conversations(turns)
    found = done.select(
        "conv_id", "formatted", chat_format.read_turns(queries.F.col("formatted")).alias("turns"),
        chat_format.loss_text(queries.F.col("formatted"), queries.F.col("loss_spans")).alias("loss"),
    ).collect()
    for r in found:
        own = sorted(
            (t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == r.conv_id
        )
        assert [(t.role, t.text) for t in r.turns] == [x[2:] for x in own]
        assert r.loss == "".join(x[3] for x in own if x[2] == "assistant")
    one = next(r for r in found if r.conv_id == 1)
    assert one.formatted.count("[INST]") == 3  # adjacent turns of a role are one block
    assert chat_format.format_conversations(turns.limit(0)).count() == 0


# --- 5 ---


def test_line_dedup_odd_documents(spark):
    docs = plain.odd_documents(spark).where("doc_id IS NOT NULL")
    gone = plain.removed_lines([(r.doc_id, r.text) for r in docs.collect()])
    found = line_dedup.dedup_lines(docs).collect()
    assert len(found) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in found:
        lines = (texts[r.doc_id] or "").split("\n")
        kept = [x for i, x in enumerate(lines) if (r.doc_id, i) not in gone]
        assert (r.text or "") == "\n".join(kept)
    assert {r.doc_id: r.text for r in found}[3] is None
    assert line_dedup.dedup_lines(plain.no_documents(spark)).count() == 0
    again = line_dedup.dedup_lines(plain.odd_documents(spark)).where("doc_id IS NULL").collect()
    assert len(again) == 2  # a null id is a document like any other, and the earliest


def test_line_dedup_large_lists_are_shuffled(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(docs).collect())
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    assert sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(docs).collect()) == want


def test_line_dedup_near_limits(spark):
    base = [f"w{i}" for i in range(9)]
    rows = [
        (1, " ".join(base)), (2, " ".join([*base[:8], "z"])), (3, " ".join([*base[:7], "y"])),
        (4, " ".join(base[:4])), (5, "\n".join(["w3 w2 w1 w0 w0", " ", "w0 w1 w2", "a", " a", "w0 w1 w2 w3 w4"])),
        (6, "\n a \n\nw0 w1"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(docs).collect()}
    # 8 of 10 words are alike: just enough; 7 of 10 are not, but 7 of 9 with the second.
    # Short lines count: 4 of 4 and 4 of 5 words, a word that repeats; 3 of 4 are too few.
    assert got == {1: 0, 2: 1, 3: 0, 4: 0, 5: 3, 6: 1}


def test_line_dedup_random_lines(spark):
    rng = random.Random(5)
    words = [f"v{i}" for i in range(400)]
    rows = []
    for d in range(120):
        lines = [rng.sample(words[: rng.choice([6, 40, 400])], k=rng.choice([1, 2, 3, 4, 5, 6])) for _ in range(6)]
        lines += [rng.sample(words, k=rng.choice([150, 260]))]
        if rows and rng.random() < 0.5:
            near = rng.choice(rows)[1].split("\n")[-1].split(" ")
            lines.append(near[: len(near) - rng.randint(0, 40)] + [f"n{d}"])
        rows.append((d, "\n".join(" ".join(line) for line in lines)))
    gone = plain.removed_lines(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, i) for r in line_dedup.dedup_lines(docs).collect() for i in r.removed}
    assert got == gone
    assert any(i == 7 for _, i in got) and any(i < 6 for _, i in got)


def test_line_dedup_large_group_of_near_copies(spark):
    """Lines of a group are settled by a few leaders, though the earliest is near to few."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for d in range(600):
        others = set(rng.sample(range(60), rng.randint(1, 6) if d else 12))
        rows.append((d, " ".join(f"o{d}x{i}" if i in others else w for i, w in enumerate(base))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = line_dedup.stash(line_dedup.rarity(docs), "t")
    leads = line_dedup.stash(line_dedup.lead_sets(line_dedup.line_sets(docs, classes)), "t")
    near = line_dedup.stash(line_dedup.pairs_with_leaders(leads), "t")
    assert near.count() <= 600 * line_dedup.RUNS * line_dedup.LEADERS
    gone = line_dedup.stash(line_dedup.verified(docs, classes, near), "t")
    assert line_dedup.candidates(leads, gone).count() < 15 * 600
    got = {(r.doc_id, i) for r in line_dedup.dedup_lines(docs).collect() for i in r.removed}
    assert got == plain.removed_lines(rows)


def _odd_lines(rng, count):
    """Lines of common and rare words, some near copies of others."""
    rare = [f"r{i}" for i in range(300)]
    lines = []
    for _ in range(count):
        if lines and rng.random() < 0.5:
            line = list(rng.choice(lines))
            for _ in range(rng.randint(0, 3)):
                line[rng.randrange(len(line))] = rng.choice(rare)
        else:
            line = [f"c{i}" for i in range(rng.choice([1, 3, 6, 9]))] + rng.sample(rare, rng.choice([0, 1, 4, 30, 80]))
        rng.shuffle(line)
        lines.append(line[: max(1, len(line) - rng.randint(0, 2))])
    return [" ".join(line) for line in lines]


def test_line_dedup_common_words(spark, monkeypatch):
    """Sets meet by a class of lengths or a second word where a word is common, with and
    without leaders; what is removed stays the same."""
    rng = random.Random(3)
    lines = _odd_lines(rng, 500)
    rows = [(d, "\n".join(lines[d * 5 : d * 5 + 5])) for d in range(100)]
    gone = plain.removed_lines(rows)
    assert len(gone) > 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for common, crowd in (((1, 3), 10**9), ((1, 10**9), 10**9), ((0, 0), 10**9), ((1, 3), 0), ((1, 10**9), 0)):
        monkeypatch.setattr(line_dedup, "COMMON", common)
        monkeypatch.setattr(line_dedup, "CROWD", crowd)
        got = {(r.doc_id, i) for r in line_dedup.dedup_lines(docs).collect() for i in r.removed}
        assert got == gone, (common, crowd)


def test_line_dedup_common_word_does_not_join_all(spark, monkeypatch):
    """Sets that share a common word meet those of their length only, or fewer."""
    rows = [(d, " ".join(["all", *[f"w{d}x{i}" for i in range(4 + d % 200)]])) for d in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = [1] * line_dedup.BUCKETS  # the common word first, so that it is in every prefix
    order[spark.sql("SELECT xxhash64('all')").first()[0] % line_dedup.BUCKETS] = 0
    classes = line_dedup.stash(spark.createDataFrame([(order,)], "classes array<tinyint>"), "t")
    leads = line_dedup.lead_sets(line_dedup.line_sets(docs, classes))
    met = []
    for common in ((10**9, 10**9), (50, 10**9), (50, 50)):
        monkeypatch.setattr(line_dedup, "COMMON", common)
        smaller, larger = line_dedup._met_rows(leads, None, None)
        met.append(smaller.select("key").join(larger.select("key"), "key").count() - smaller.count())
    assert met[0] > 4 * met[1] and met[0] > 100 * met[2]


def test_line_dedup_cuts_a_long_text_once(spark):
    """A text of many lines, some of them removed: time grows with its lines, not their square."""
    lines = [f"a{i} b{i} c{i} d{i}" for i in range(20_000)]
    rows = [(1, "\n".join([*lines, *lines[:100], *(f"e{i} f{i} g{i}" for i in range(20_000))]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    began = time.monotonic()
    got = line_dedup.dedup_lines(docs).collect()[0]
    assert (got.n_lines, got.n_removed) == (40_100, 100) and got.removed[0] == 20_000
    assert got.text.count("\n") == 39_999
    assert time.monotonic() - began < 30


# --- 6 ---


def _check_shards(rows, texts, n_shards):
    assert len(rows) == len(texts)
    slots = plain.by(rows, lambda r: r.shard, lambda r: r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(0 <= r.shard < n_shards and r.law == "bytes" and r.grown_shard is None for r in rows)
    per_text = plain.by(rows, lambda r: (r.size, r.text_crc32), lambda r: r.shard)
    assert all(len(set(s)) == 1 for s in per_text.values())


def test_sharding_query(spark, documents):
    rows = queries.op6_sharding(spark, FOLDER).collect()
    _check_shards(rows, documents, 24)
    texts = {d.doc_id: d.text for d in documents}
    for r in rows:
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id].encode()) + 8, plain.crc(texts[r.doc_id]))
    sizes = plain.by(rows, lambda r: r.shard, lambda r: r.size)
    sums = [sum(s) for s in sizes.values()]
    largest = max(plain.by(rows, lambda r: r.text_crc32, lambda r: r.size).values(), key=sum)
    assert len(sums) == 24 and max(sums) <= max(1.05 * sum(sums) / 24, sum(largest) * 1.05)


def test_sharding_odd_documents(spark):
    docs = plain.odd_documents(spark)
    _check_shards(sharding.shard_documents(docs, 4).collect(), docs.collect(), 4)
    assert sharding.shard_documents(plain.no_documents(spark), 4).count() == 0


def test_best_fit_takes_the_tightest_bin():
    assert sharding.best_fit([5, 4, 3], [9, 5, 6])[0] == [1, 2, 0]
    chosen, left = sharding.best_fit([4, 4, 4], [5, 5])
    assert sorted(chosen[:2]) == [0, 1] and min(left) == -3


def test_fewest_shards_of_a_capacity(spark):
    rows = [(str(i), size) for i, size in enumerate([6, 6, 5, 5, 4, 4, 3, 3, 2, 2])]
    groups = spark.createDataFrame(rows, "key string, bytes long")
    placed, n = sharding.shards_for_capacity(groups, 10)
    sums = Counter()
    sizes = dict(rows)
    for r in placed.collect():
        sums[r.shard] += sizes[r.key]
    assert n == 4 and max(sums.values()) <= 10
    with pytest.raises(ValueError):
        sharding.shards_for_capacity(groups, 5)


# --- 7 ---


def _library():
    tokenizer = Tokenizer.from_file(queries.VOCABULARY)
    return tokenizer


def _check_bpe(got, text):
    tokenizer = _library()
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    assert got.n_tokens == len(ids)
    assert got.ids_sha256 == plain.sha(",".join(map(str, ids)))
    assert got.decoded_sha256 == plain.sha(tokenizer.decode(ids, skip_special_tokens=False))


@pytest.mark.parametrize("limit", [400_000, 50])
def test_bpe_query(spark, documents, monkeypatch, limit):
    monkeypatch.setattr(bpe, "TABLE_WORDS", limit)
    texts = {d.doc_id: d.text for d in documents}
    for r in queries.op7_bpe(spark, FOLDER).collect():
        _check_bpe(r, texts[r.doc_id])


def test_bpe_odd_texts(spark):
    texts = [
        None, "", " ", "a  b", "\n\n\n x", "x \t\r\n ", "it's we'll 'S  'll", "a b 　c  d", "\x1c\x1d x\x1e",
        "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "\U0001f600é ǘ", "a" * 5000, "12 345٤ ½",
        "x\x00y", "﻿word", "  lead", "tail  ", "​ z", "a\x85b",
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 2)], "doc_id long, text string")
    docs = docs.selectExpr("*", "'x' AS ids", "'y' AS decoded", "1 AS word")
    done = queries._bpe_digests(bpe.decode_documents(bpe.encode_documents(docs, queries.VOCABULARY), queries.VOCABULARY))
    found = done.collect()
    assert len(found) == len(texts) * 2
    for r in found:
        _check_bpe(r, texts[r.doc_id % len(texts)])
    assert bpe.encode_documents(plain.no_documents(spark), queries.VOCABULARY).count() == 0


@pytest.mark.parametrize("most", [400_000, 3])
def test_bpe_word_counts(spark, monkeypatch, most):
    """Counts of a task are passed on whenever they hold ``most`` words, and added up."""
    monkeypatch.setattr(bpe, "COUNTED_WORDS", most)
    texts = [None, "", "a b a", " a  b\n\n", "x" * 65 + " a", "y" * 64 + " é\u3000é"] * 3
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    want = Counter(w for t in texts for w in re.findall(bpe.WORD, t or "") if len(w) <= 64)
    assert {r.word: r.n for r in bpe.word_counts(docs).collect()} == want


# --- 8 ---


def _check_mix(rows, texts):
    sizes = Counter()
    for _, source, text in texts:
        sizes[source] += len(plain.words(text))
    want = plain.targets(sizes)
    taken = Counter()
    for r in rows:
        assert r.taken <= 2 * r.size
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-6)
        assert r.source_size == sizes[r.source]
        taken[r.source] += r.taken
    for source in sizes:
        assert abs(taken[source] - want[source]) <= 2 * mixing.BLOCK_WORDS


def test_mixing_query(spark, documents):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows, slots = mixing.mix(docs, 1.5, 2.0, 20)
    assert slots.groupBy("shard", "slot").count().where("count > 1").count() == 0
    found = mixing.taken_words(rows, slots).collect()
    _check_mix(found, [(d.doc_id, d.source, d.text) for d in documents])
    said = {r.doc_id: r.taken for r in found}
    assert said == {r.doc_id: r.taken for r in queries.op8_mixing(spark, FOLDER).collect()}


def test_mixing_odd_documents(spark):
    docs = plain.odd_documents(spark)
    rows, slots = mixing.mix(docs, 1.5, 2.0, 1)
    found = mixing.taken_words(rows, slots).collect()
    assert len(found) == docs.count()
    _check_mix(found, [(d.doc_id, d.source, d.text) for d in docs.collect()])
    assert mixing.mix(plain.no_documents(spark), 1.5, 2.0)[0].count() == 0


def test_mixed_documents_hold_what_was_taken(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows, slots = mixing.mix(docs, 1.5, 2.0, 3)
    taken = {r.doc_id: r.taken for r in mixing.taken_words(rows, slots).collect() if r.taken}
    mixed = mixing.mixed_documents(docs, 1.5, 2.0, 3)
    assert mixed.columns == docs.columns
    found = mixed.collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = Counter()
    for r in found:
        got[r.doc_id] += len(plain.words(r.text))
        assert r.n_chars == len(r.text)
        left = iter(plain.words(texts[r.doc_id]))
        assert all(w in left for w in plain.words(r.text))
    assert got == taken
    assert sum(r.text == texts[r.doc_id] for r in found) > 0
    assert mixing.mixed_documents(plain.odd_documents(spark), 1.5, 2.0, 3).count() > 0
    assert mixing.mixed_documents(plain.no_documents(spark), 1.5, 2.0, 3).count() == 0


# --- 9 ---


def test_quality_query(spark, documents):
    texts = {d.doc_id: d.text for d in documents}
    found = queries.op9_quality(spark, FOLDER).collect()
    assert len(found) == len(documents)
    for r in found:
        want = plain.statistics(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert not (r.base_failed and r.kept)


def test_quality_odd_documents(spark):
    docs = plain.odd_documents(spark)
    found = quality.judge(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id}
    assert len(found) == docs.count()
    for r in found:
        if r.doc_id:
            assert r.n_repeat_words == plain.statistics(texts[r.doc_id])[4]
    assert quality.judge(plain.no_documents(spark)).count() == 0


def test_quality_rejects_what_is_far_and_keeps_clean_documents(spark):
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), int(rng.integers(2, 9))))
    rows = [(i, " ".join(word() for _ in range(int(rng.integers(60, 400)))), "en", "s") for i in range(120)]
    rows += [(1000 + i, " ".join(f"#{word()}|$*%" for _ in range(200)), "en", "s") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = quality.judge(docs).collect()
    assert {r.doc_id for r in found if not r.kept} == {1000 + i for i in range(5)}
    far = {r.doc_id: r.distance2 for r in found}
    again = quality.judge(docs.repartition(5)).collect()
    assert far == {r.doc_id: r.distance2 for r in again}
    kept = quality.keep_good(docs.union(docs))
    assert kept.columns == docs.columns and kept.count() == 240


def test_quality_rejects_documents_with_a_few_junk_words(spark):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), int(rng.integers(2, 9))))
    rows = [(i, " ".join(word() for _ in range(int(rng.integers(60, 400)))), "en", "s") for i in range(150)]
    # 3 and 5 junk words of a hundred.
    rows += [
        (1000 + i, " ".join("#$%" if n % 100 < 3 + 2 * (i % 2) else word() for n in range(200)), "en", "s")
        for i in range(6)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = quality.judge(docs).collect()
    assert {r.doc_id for r in found if not r.kept} == {1000 + i for i in range(6)}


# --- 10 ---


def _plain_totals(rows):
    count = {"words-1": lambda t: len(plain.words(t))}
    totals = Counter()
    for source, lang, text in rows:
        for v, f in count.items():
            totals[source, lang, v, "docs"] += 1
            totals[source, lang, v, "tokens"] += f(text)
    return {k: v for k, v in totals.items() if totals[(*k[:3], "docs")]}


def _totals(rollup):
    out = {}
    for r in rollup.totals().collect():
        out[r.source, r.lang, r.version, "docs"] = r.n_docs
        out[r.source, r.lang, r.version, "tokens"] = r.n_tokens
    return out


def test_token_rollup_follows_changes(spark):
    versions = {"words-1": token_rollup.word_counter}
    rollup = token_rollup.TokenRollup(spark, work_path(spark, "rollup-test"), versions)
    changes = "op string, doc_id long, source string, lang string, text string"
    said = [("insert", 1, "a", "en", "x y z"), ("insert", 2, "a", None, None), ("insert", None, None, "en", "q"),
            ("insert", 3, "b", "de", "u v"), ("insert", 3, "b", "de", "u v")]
    assert rollup.commit("one", spark.createDataFrame(said, changes))
    assert _totals(rollup) == _plain_totals([r[2:] for r in said])
    more = [("delete", 3, None, None, None), ("delete", 3, None, None, None), ("revise", 1, "c", "en", "x"), ("delete", 99, None, None, None), ("delete", None, None, None, None)]
    assert rollup.commit("two", spark.createDataFrame(more, changes))
    want = _plain_totals([("a", None, None), ("c", "en", "x")])
    assert _totals(rollup) == want
    assert not rollup.commit("one", spark.createDataFrame(said, changes))
    assert not rollup.commit("two", spark.createDataFrame(more, changes))
    assert rollup.commit("none", spark.createDataFrame([], changes))
    assert _totals(rollup) == want


def test_token_rollup_replaces_a_broken_batch(spark):
    """A run that wrote its entries and was lost before its sums counts for nothing."""
    versions = {"words-1": token_rollup.word_counter}
    root = work_path(spark, "rollup-broken")
    rollup = token_rollup.TokenRollup(spark, root, versions)
    changes = "op string, doc_id long, source string, lang string, text string"
    rollup.commit("one", spark.createDataFrame([("insert", 1, "a", "en", "x y")], changes))
    broken = [(2, "a", "en", "words-1", 1, 50)]
    spark.createDataFrame(broken, token_rollup.ENTRIES).write.parquet(f"{root}/entries/batch=two")
    assert rollup.state().count() == 1
    rollup.commit("two", spark.createDataFrame([("revise", 2, "a", "en", "q")], changes))
    assert _totals(rollup) == _plain_totals([("a", "en", "x y"), ("a", "en", "q")])


def test_token_rollup_query(spark, documents):
    first, rows = {}, []
    for d in sorted(documents, key=lambda d: d.doc_id):
        if d.text not in first:
            first[d.text] = d.doc_id
            rows.append((d.source, d.lang, "\n".join(dict.fromkeys(d.text.split("\n")))))
    found = queries.op10_token_rollup(spark, FOLDER).collect()
    got = {(r.source, r.lang, r.version, "tokens"): r.n_tokens for r in found if r.version == "words-1"}
    want = {k: v for k, v in _plain_totals(rows).items() if k[3] == "tokens"}
    assert got == want
    tokenizer = _library()
    tokenizer.encode_special_tokens = True
    total = sum(len(tokenizer.encode(t, add_special_tokens=False).ids) for _, _, t in rows)
    assert total == sum(r.n_tokens for r in found if r.version == "byte_bpe_50k")
