"""Toxicity, conversation repair and alignment against plain versions, and odd rows."""

import hashlib
import random
import zlib
from collections import Counter
from functools import partial
from itertools import product

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textloom.llm import alignment, queries, toxicity
from textloom.llm import conversation_repair as repair

FOLDER = "/root/testdata/sf0.001"

# --- 11 ---


def _held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    rows = queries.op11_toxicity(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert len(rows) == docs.count()
    assert all(r.held_out == _held(r.doc_id) and r.predicted == (r.score >= 0.5) for r in rows)
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    told = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    found = Counter(told)
    assert found[1, 1] / (found[1, 1] + found[1, 0]) >= 0.85
    assert found[0, 0] / (found[0, 0] + found[0, 1]) >= 0.99


def _bag_loss(model, bags):
    weights, bias = model[:-1], model[-1]
    loss = 0.0
    for toxic, sentences in bags:
        none = 1.0
        for features in sentences:
            none *= 1 - 1 / (1 + np.exp(-(bias + sum(weights[f] for f in features))))
        loss -= np.log(1 - none if toxic else none)
    return loss


def test_noisy_or_gradient():
    rng = random.Random(3)
    bags = [(rng.randrange(2), [sorted(rng.sample(range(5), rng.randrange(4))) for _ in range(rng.randrange(1, 6))]) for _ in range(30)]
    model = np.array([rng.uniform(-1, 1) for _ in range(5)] + [-0.7])
    bag, of_sentence, feature, plain = [], [], [], []
    for n, (_, sentences) in enumerate(bags):
        plain.append(sum(not s for s in sentences))
        for s in filter(None, sentences):
            of_sentence += [len(bag)] * len(s)
            feature += s
            bag.append(n)
    toxic = np.array([t for t, _ in bags])
    got = toxicity.gradient(model[:-1], model[-1], toxic, np.array(plain), np.array(bag), np.array(of_sentence), np.array(feature))
    for n in range(len(model)):
        step = np.zeros(len(model))
        step[n] = 1e-6
        slope = (_bag_loss(model + step, bags) - _bag_loss(model - step, bags)) / 2e-6
        assert abs(got[n] - slope) < 1e-4


def _teaching(spark):
    rng = random.Random(5)
    said = ["one two three", "four five six", "seven eight nine", "ten eleven twelve"]
    docs, labels = [], []
    for n in range(400):
        parts = [rng.choice(said) for _ in range(rng.randrange(1, 6))]
        toxic = int(n % 4 == 0)
        if toxic:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(["you vermin", "such vermine there", "Vermin all"]))
        docs.append((n, ". ".join(parts) + "."))
        labels.append((n, toxic))
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_offending_sentences(spark):
    docs, labels = _teaching(spark)
    model = toxicity.fit(docs, labels)
    told = ("vermin", "vermine", "you", "such", "there", "all")
    assert all(any(w.startswith(name.rstrip("*")) for w in told) for name in model["names"])
    odd = [
        (1, None), (2, ""), (3, "...!?\n"), (4, "One two three. You VERMIN there! Four five"), (4, "One two three. You VERMIN there! Four five"),
        (5, "five " * 50_000 + "vermin"), (None, "ten é vermin"),
    ]
    df = spark.createDataFrame(odd, "doc_id long, text string").selectExpr("*", "'x' AS score", "1 AS label", "2 AS worst")
    rows = toxicity.scored(df, model).collect()
    assert len(rows) == len(odd) and all(r.label == 1 for r in rows)
    by_id = {r.doc_id: r for r in rows}
    for n in (1, 2, 3):
        assert (by_id[n].score, by_id[n].worst, by_id[n].offending) == (0.0, None, [])
    for r in rows:
        if r.doc_id in (4, 5, None):
            assert r.score >= 0.5 and len(r.offending) == 1
    found = by_id[4].offending[0]
    assert odd[3][1][found.start : found.end] == " You VERMIN there"
    # The score is the noisy-or of the sentences.
    parts = [toxicity._sigmoid(model["bias"])] * 2 + [by_id[4].worst.score]
    assert abs(by_id[4].score - (1 - np.prod([1 - p for p in parts]))) < 1e-5
    assert toxicity.scored(df.limit(0), model).count() == 0


def test_toxicity_without_labels(spark):
    docs, labels = _teaching(spark)
    for some in (labels.limit(0), labels.withColumn("toxic", F.lit(0)), labels.withColumn("toxic", F.lit(None).cast("int"))):
        rows = toxicity.scored(docs, toxicity.fit(docs, some)).collect()
        assert len(rows) == 400 and max(r.score for r in rows) < 0.01
    rows = toxicity.scored(docs, toxicity.fit(docs.limit(0), labels)).collect()
    assert max(r.score for r in rows) < 0.01


def test_held_out_labels_teach_nothing(spark):
    docs, labels = _teaching(spark)
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = toxicity.fit(docs, labels), toxicity.fit(docs, turned)
    assert one["names"] == two["names"] and one["bias"] == two["bias"]


# --- 12 ---


def _step(state, role):
    return {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((state, role))


def _with_inserts(ways):
    changed = True
    while changed:
        changed = False
        for state, (cost, edits) in list(ways.items()):
            for role in "ua":
                to = _step(state, role)
                if to is not None and (cost + 2, edits + "I") < ways.get(to, (1 << 30, "")):
                    ways[to] = cost + 2, edits + "I"
                    changed = True
    return ways


def cheapest(symbols):
    """Least (cost, edits) by state, row by row."""
    ways = {0: (0, "")}
    for symbol in symbols:
        found = {}
        for state, (cost, edits) in _with_inserts(ways).items():
            options = [(state, cost + 3, "D")]
            if symbol > 1:
                role, cut = divmod(symbol - 2, 2)
                options.append((_step(state, "suax"[role]), cost + cut, "K"))
                options += [(_step(state, r), cost + cut + 2, "R") for r in "ua"]
            for to, price, edit in options:
                if to is not None and (price, edits + edit) < found.get(to, (1 << 30, "")):
                    found[to] = price, edits + edit
        ways = found
    return min(way for state, way in _with_inserts(ways).items() if state in (0, 3))


def _check(symbols):
    audit, _ = repair.expand(symbols, 0, 0, True)
    assert (repair.cost_of(audit, symbols), audit) == cheapest(symbols), symbols


def test_repair_of_all_short_conversations():
    for n in range(4):
        for symbols in product(range(1, repair.SYMBOLS), repeat=n):
            _check(list(symbols))


def test_repair_of_longer_conversations():
    rng = random.Random(1)
    for _ in range(2_000):
        _check([rng.randrange(1, repair.SYMBOLS) for _ in range(rng.randrange(4, 30))])


def test_tables_hold_every_vector():
    known = repair.tables()
    assert known.to.shape == (len(known.vectors), repair.SYMBOLS**repair.BLOCK)
    rng = random.Random(2)
    for _ in range(200):
        symbols = [rng.randrange(repair.SYMBOLS) for _ in range(repair.BLOCK)]
        for n, vector in enumerate(known.vectors):
            for symbol in reversed(symbols):
                vector = repair._before(vector, symbol)
            block = repair.blocks_of(symbols)[0]
            to, cost = known.to[n, block], known.cost[n, block]
            assert vector == tuple(c + cost for c in known.vectors[to])


def _symbol(role, text, seen):
    last = [c for c in text if c not in " \t\n\x0b\x0c\r"][-1:]
    if not last:
        return 1, "blank"
    if (role, text) in seen:
        return 1, "duplicate"
    cut = last[0] not in ".!?"
    return 2 + 2 * ("sua".find(role[:1]) if role[:1] and role[0] in "sua" else 3) + cut, "truncated" if cut else None


def _plain_repair(rows):
    """Of rows in order: fault counts, illegal pairs, gaps, (cost, audit) and the rows left."""
    seen, symbols, faults = set(), [], Counter()
    for _, role, text in rows:
        symbol, fault = _symbol(role, text, seen)
        seen.add((role, text))
        symbols.append(symbol)
        faults[fault] += 1
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = cheapest(symbols)
    left, state, at = [], 0, 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else rows[at][1:]
        at += edit != "I"
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if state == 2 else "user"
        state = _step(state, role[0])
        left.append((role, text))
    said = "\n".join(f"{r}:{t}" for r, t in left)
    digest = hashlib.sha256(said.encode()).hexdigest()
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit), left, digest


def _order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role.encode(), text.encode())


@pytest.mark.parametrize("segment_rows", [3, 4_096])
def test_repair_of_odd_and_long_conversations(spark, segment_rows):
    rng = random.Random(7)
    rows = [
        (None, 1, "user", "Lost."), (None, 2, "assistant", "Found."), (2, None, None, None), (2, None, "user", "Hi."),
        (2, 4, "tool", "x" * 50_000), (2, 4, "tool", "x" * 50_000), (2, 9, "", "No role."), (3, 1, "system", " \n\t"),
        (4, 5, "assistant", "\x0b?"), (5, 1, "s", "é…"), (5, 1, "a", "! "),
    ]
    for n in range(700):  # One large conversation: many segments.
        rows.append((7, n // 2 * 3, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["Yes.", "No", f"{n}.", f"{n}", " "])))
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    df = df.selectExpr("*", "1 AS part", "'x' AS symbol", "2 AS conv").repartition(5)
    found = repair.repair(df, segment_rows)
    got = {r.conv_id: tuple(r)[1:] for r in repair.reports(found).collect()}
    digests = {r.conv_id: r.repaired_sha256 for r in repair.digests(found).collect()}
    left = repair.repaired_turns(found).orderBy("conv_id", "part", "at", "place").collect()
    assert len(got) == 6
    for conv in got:
        mine = [(t, r or "", x or "") for c, t, r, x in rows if c == conv]
        report, turns, digest = _plain_repair(sorted(mine, key=_order))
        assert got[conv] == report
        assert [(r.role, r.text) for r in left if r.conv_id == conv] == turns
        assert digests[conv] == digest
    none = repair.repair(df.limit(0))
    assert repair.reports(none).count() == 0 and repair.digests(none).count() == 0


# --- 13 ---


class _Plain:
    """Both tokenizers through their own libraries' whole-text calls."""

    def __init__(self):
        self.a = Tokenizer.from_file(queries.VOCABULARY)
        self.a.encode_special_tokens = True
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.byte = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}
        self.b = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)

    def sides(self, text):
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        of_a = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in a]
        of_b = []
        for i in b:
            piece = self.b.id_to_piece(i)
            of_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        said = (" " + text).encode()
        if not text or b"".join(of_a) != said or b"".join(of_b) != said:
            return [], []
        spans = []
        for ids, pieces in ((a, of_a), (b, of_b)):
            at, found = 0, []
            for i, piece in zip(ids, pieces):
                found.append((i, at, at + len(piece)))
                at += len(piece)
            spans.append(found)
        return spans

    def corpus(self, texts):
        rows, total = [], Counter()
        for text in texts:
            a, b = self.sides(text or "")
            links, first = [], 0
            for i, start, end in a:
                while first < len(b) and b[first][2] <= start:
                    first += 1
                at = first
                while at < len(b) and b[at][1] < end:
                    links.append((i, b[at][0]))
                    at += 1
            total.update(links)
            ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
            groups, before = [], 0
            for end in ends:
                inside = [[str(i) for i, _, e in side if before < e <= end] for side in (a, b)]
                groups.append("|".join(map(",".join, inside)))
                before = end
            rows.append((a, b, groups, links))
        best = {}
        for (_, b), n in total.items():
            best[b] = max(best.get(b, 0), n)
        for a, b, groups, links in rows:
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
            yield (
                len(a), len(b), len(groups), len(links), sum(total[x] == best[x[1]] for x in links),
                sum(total[x] for x in links), digest,
            )


_COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
_ENCODERS = (
    partial(alignment.rank_encoder, queries.RANKS), partial(alignment.piece_encoder, queries.PIECES)
)


def test_alignment_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    # Groups by whole passes over the spans are slow on long texts, so these are checked apart.
    want = dict(zip(docs, _Plain().corpus(docs.values())))
    rows = queries.op13_alignment(spark, FOLDER).collect()
    assert {r.doc_id: (*[r[c] for c in _COLUMNS], r.groups_sha256) for r in rows} == want


def test_alignment_of_random_cuts():
    """Links and groups of cuts of the same bytes, against all pairs."""
    rng = np.random.default_rng(3)
    for docs in (0, 1, 5):
        lengths = rng.integers(1, 40, docs)
        base = np.cumsum(lengths) - lengths
        sides = []
        for _ in range(2):
            cuts = [np.unique(np.append(rng.integers(1, n + 1, 12), n)) for n in lengths.tolist()]
            sizes = [np.diff(np.append(0, c)) for c in cuts]
            sides.append(alignment._tokens(sizes, np.arange(41), base))
        a, b = sides
        one, two = (list(zip(x["start"], x["end"])) for x in sides)
        want = [(i, j) for i, x in enumerate(one) for j, y in enumerate(two) if max(x[0], y[0]) < min(x[1], y[1])]
        assert list(zip(*(x.tolist() for x in alignment.overlaps(a, b)))) == want
        both = sorted({x[1] for x in one} & {y[1] for y in two})
        group_a, group_b, doc_of = alignment._in_groups(a, b)
        for group, ranges in ((group_a, one), (group_b, two)):
            assert group.tolist() == [sum(e < r[1] for e in both) for r in ranges]
        assert doc_of.tolist() == [int(np.searchsorted(base + lengths, e)) for e in both]


@pytest.mark.parametrize("common", [0, 50, alignment.COMMON_PAIRS])
def test_alignment_of_odd_texts(spark, common):
    rng = random.Random(common)
    texts = [
        None, "", " ", "a", "  two  blanks ", "line\r\nfeed\ttab\x00nul", "<|endoftext|> </s><s><unk>", "naïve café ▁ 東京 🙂👩‍👩‍👧",
        "same words same words", "same words same words", "x" * 20_000, "▁", "é   　﻿�",
    ]
    texts += ["".join(rng.choices("ab é\n.😀ß1 ", k=rng.randrange(60))) for _ in range(60)]
    rows = [(None if n == 3 else n // 2, t) for n, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS row", "0 AS n", "1 AS pair")
    found = alignment.aligned_corpus(df, _ENCODERS, queries.N_PIECES, common, digest=True).collect()
    got = Counter((r.doc_id, *[r[c] for c in _COLUMNS], r.groups) for r in found)
    want = Counter((i, *told) for (i, _), told in zip(rows, _Plain().corpus(texts)))
    assert got == want
    assert alignment.aligned_corpus(df.limit(0), _ENCODERS, queries.N_PIECES, common).count() == 0


def test_groups_are_written_out(spark):
    df = spark.createDataFrame([(1, "unbelievable naïveté")], "doc_id long, text string")
    row = alignment.aligned_corpus(df, _ENCODERS, queries.N_PIECES).first()
    a = _Plain().a.encode(" unbelievable naïveté", add_special_tokens=False).ids
    written = [g.split("|") for g in row.groups.split(";")]
    assert [int(i) for one, _ in written for i in one.split(",")] == a
    assert len(written) == row.n_groups


def test_rank_file_is_the_same_vocabulary():
    plain = _Plain().a
    encode, pieces = alignment.rank_encoder(queries.RANKS)
    assert len(pieces) + 1 == plain.get_vocab_size()
    # Characters of every script between letters, digits, blanks and signs.
    texts = [f"a{chr(c)}b {chr(c)}1 {chr(c)}{chr(c)}!{chr(c)}" for c in range(0x20, 0x110000, 37) if not 0xD800 <= c < 0xE000]
    assert encode(texts) == [e.ids for e in plain.encode_batch([" " + t for t in texts], add_special_tokens=False)]
