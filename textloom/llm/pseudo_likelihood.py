"""LM scoring by masked pseudo-likelihood of a bidirectional window network, in numpy.

Every token is predicted from the two tokens on either side of it: their embeddings (one
table per place) are added, go through tanh, and give a softmax over classes of tokens and
a second one over the tokens of the class. A document's score is the sum of these
conditional log-probabilities.

The vocabulary is counted over the whole corpus, and every word counted has a probability of
its own. Known words are tokens alone; their number grows with the root of the corpus, and
with it the shared tokens, the classes and the network. Any other word has the probability
of its shared token times its share of that token's count. Counts of the most frequent ones
travel to the tasks; the rest stay a table, which the words of the texts are joined to.

Each task trains the network on all windows of its documents, from the same start, and the
networks are averaged, weighted by tokens, in a tree that brings about ``FAN_BYTES`` of them
into one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import words_of
from textloom.session import stash

#: Known words are the root of the corpus' number of words, and no fewer than this.
KNOWN_WORDS = 8192
#: Words that are not known share tokens by hash: one of them for so many known words.
KNOWN_A_SHARED = 16
#: The most frequent words, known or not, travel to the tasks with their counts.
LISTED_WORDS = 200_000
#: A class ends when the share of all words in it times its tokens exceeds this.
CLASS_COST = 0.7
WIDTH = 16
PLACES = (-2, -1, 1, 2)
BATCH = 8192
RATE = 1.0
#: Networks that one task averages, in bytes.
FAN_BYTES = 128 << 20
#: Windows take about forty times the bytes of their tokens.
TEXTS_AT_ONCE = 250


class Vocabulary(NamedTuple):
    """Tokens: known words and shared tokens by count, class by class, then the border token."""

    #: Listed words, and by their number the token of each and the log of its share of it.
    ids: dict[bytes, int]
    token_of: np.ndarray
    extra: np.ndarray
    #: Shared tokens by hash, and the log of the words that each stands for.
    shared: np.ndarray
    log_mass: np.ndarray
    class_of: np.ndarray
    log_share: np.ndarray
    class_bias: np.ndarray
    #: ``h, log_n``: the hash of every word not listed that occurs twice or more.
    rest: DataFrame | None

    @property
    def size(self) -> int:
        return len(self.class_of) + 1

    def sent(self) -> Vocabulary:
        """What travels to the tasks."""
        return self._replace(rest=None)


def build_vocabulary(docs: DataFrame) -> Vocabulary:
    """Counts every word of the corpus. The ``LISTED_WORDS`` most frequent ones and the sums
    of the shared tokens come to the driver; the counts of all others stay a table."""
    words = docs.select(F.explode(words_of("text")).alias("word"))
    counts = stash(words.groupBy("word").agg(F.count("*").alias("n")), "lm-words")
    power = F.floor(F.log2("n") * 8).cast("int")
    sizes = counts.groupBy(power.alias("power")).agg(F.count("*"), F.sum("n")).collect()
    listed, least = 0, 0
    for least, rows, _ in sorted(sizes, reverse=True):
        listed += rows
        if listed >= LISTED_WORDS:
            break
    frequent = counts.where(power >= least).orderBy(F.desc("n"), "word").limit(LISTED_WORDS)
    found = stash(frequent, "lm-listed")
    top = found.toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    top_words = [w.encode() for w in top.column("word").to_pylist()]
    n = top.column("n").to_numpy().astype(float)
    wanted = max(KNOWN_WORDS, math.isqrt(sum(total for _, _, total in sizes)))
    known, n_shared = min(wanted, len(n)), max(1, wanted // KNOWN_A_SHARED)
    bucket = F.pmod(F.xxhash64("word"), F.lit(n_shared))
    mass = np.zeros(n_shared)
    for b, total in counts.groupBy(bucket).agg(F.sum("n")).collect():
        mass[b] = total
    buckets = np.array([_signed_hash(w) % n_shared for w in top_words], np.int64)
    mass -= np.bincount(buckets[:known], n[:known], minlength=n_shared)
    log_mass = np.log(np.maximum(mass, 1))
    tokens = np.concatenate([n[:known], mass]) + 0.5
    # By count, so that classes are runs of tokens and frequent words are classes alone.
    order = np.argsort(-tokens, kind="stable")
    token = np.empty(len(tokens), np.int64)
    token[order] = np.arange(len(tokens))
    tokens = tokens[order]
    class_of = _classes(tokens / tokens.sum())
    totals = np.bincount(class_of, tokens)
    return Vocabulary(
        dict(zip(top_words, range(len(n)))),
        np.concatenate([token[:known], token[known + buckets[known:]]]),
        np.concatenate([np.zeros(known), np.log(n[known:]) - log_mass[buckets[known:]]]),
        token[known:], log_mass, class_of,
        np.log(tokens / totals[class_of]), np.log(totals / totals.sum()),
        _unlisted(counts, found),
    )


def _unlisted(counts: DataFrame, listed: DataFrame) -> DataFrame:
    """Words seen once are left out: the log of their count is nothing to add."""
    rest = counts.where("n > 1").join(F.broadcast(listed.select("word")), "word", "left_anti")
    hashed = rest.groupBy(F.xxhash64("word").alias("h")).agg(F.sum("n").alias("n"))
    return stash(hashed.select("h", F.log("n").alias("log_n")), "lm-rest")


def _classes(share: np.ndarray) -> np.ndarray:
    """The class of each token, by falling share. A class costs every word one more score,
    and each word of the class a score for every token in it: a class is closed where the
    two are about equal, so classes grow in number as well as in size."""
    out = np.empty(len(share), np.int64)
    at = inside = 0
    held = 0.0
    for token, part in enumerate(share):
        if inside and (held + part) * (inside + 1) > CLASS_COST:
            at, inside, held = at + 1, 0, 0.0
        out[token] = at
        inside, held = inside + 1, held + part
    return out


def _signed_hash(word: bytes) -> int:
    digest = xxhash.xxh64_intdigest(word, 42)
    return digest - (1 << 64) if digest >> 63 else digest


def _look_up(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of ``words``, the logs of their shares of them, and places of unlisted words
    with their hashes (two rows). A word not listed gets the share of a word seen once."""
    at = np.fromiter(map(vocabulary.ids.get, words, repeat(-1)), np.int64, len(words))
    others = np.flatnonzero(at < 0)
    tokens, extra = np.zeros(len(at), np.int64), np.zeros(len(at))
    if len(vocabulary.token_of):
        tokens, extra = vocabulary.token_of[at], vocabulary.extra[at]
    hashes = np.array([_signed_hash(words[i]) for i in others.tolist()], np.int64)
    bucket = hashes % len(vocabulary.shared)
    tokens[others], extra[others] = vocabulary.shared[bucket], -vocabulary.log_mass[bucket]
    return tokens, extra, np.stack([others, hashes])


def token_ids(text: str | None, vocabulary: Vocabulary) -> np.ndarray:
    return _look_up((text or "").encode().split(), vocabulary)[0]


def windows(ids: np.ndarray, lengths: np.ndarray, border: int) -> np.ndarray:
    """For every token of a batch of documents the tokens at ``PLACES``; beyond the ends
    of its document they are the border token."""
    ends = np.cumsum(lengths)
    at = np.arange(len(ids))
    begin = np.repeat(ends - lengths, lengths)
    end = np.repeat(ends, lengths)
    out = np.full((len(PLACES), len(ids)), border, np.int64)
    for n, place in enumerate(PLACES):
        there = at + place
        inside = (there >= begin) & (there < end)
        out[n, inside] = ids[there[inside]]
    return out


def _above(most: np.ndarray) -> np.ndarray:
    """What to take off logits that can reach ``most``, so that exponentials stay finite. All
    logits of a softmax are lowered alike, which leaves its shares as they are."""
    return np.maximum(most - 60, 0)


class Network:
    def __init__(self, vocabulary: Vocabulary, flat: np.ndarray | None = None) -> None:
        self.vocabulary = vocabulary
        n_tokens, classes = len(vocabulary.class_of), len(vocabulary.class_bias)
        shapes = [
            (len(PLACES), vocabulary.size, WIDTH), (WIDTH,), (WIDTH, classes), (classes,),
            (n_tokens, WIDTH), (n_tokens,),
        ]
        sizes = [int(np.prod(s)) for s in shapes]
        if flat is None:
            rng = np.random.default_rng(7)
            flat = np.concatenate(
                [rng.normal(0, 0.3, sizes[0]), np.zeros(sizes[1]), rng.normal(0, 0.1, sizes[2]),
                 vocabulary.class_bias, np.zeros(sizes[4]), vocabulary.log_share]
            )
        self.flat = flat.astype(np.float32)
        parts = np.split(self.flat, np.cumsum(sizes)[:-1])
        self.embed, self.bias, self.out, self.out_bias, self.inner, self.inner_bias = (
            part.reshape(shape) for part, shape in zip(parts, shapes)
        )
        self.first = np.searchsorted(vocabulary.class_of, np.arange(classes + 1))

    def _forward(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = self.bias + self.embed[0][around[0]]
        for place in range(1, len(PLACES)):
            hidden += self.embed[place][around[place]]
        np.tanh(hidden, out=hidden)
        logits = hidden @ self.out
        logits += self.out_bias - _above((self.out_bias + np.abs(self.out).sum(axis=0)).max())
        return hidden, logits

    def _bounded_bias(self) -> np.ndarray:
        """``inner_bias``, lowered class by class as ``_above`` says."""
        most = self.inner_bias + np.abs(self.inner).sum(axis=1)
        most = np.maximum.reduceat(most, self.first[:-1])
        return self.inner_bias - _above(most)[self.vocabulary.class_of]

    def _by_class(
        self, wanted: np.ndarray, hidden: np.ndarray, bias: np.ndarray
    ) -> Iterator[tuple[slice, slice, np.ndarray]]:
        """For every class of several tokens that occurs in ``wanted``, which is sorted: its
        windows, its tokens, and the exponentials of the logits of these."""
        bounds = np.searchsorted(wanted, np.arange(len(self.first)))
        several = (np.diff(bounds) > 0) & (np.diff(self.first) > 1)
        for c in np.flatnonzero(several).tolist():
            rows, tokens = slice(bounds[c], bounds[c + 1]), slice(self.first[c], self.first[c + 1])
            inside = hidden[rows] @ self.inner[tokens].T
            inside += bias[tokens]
            yield rows, tokens, np.exp(inside, out=inside)

    def _sorted(self, center: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words of a batch in order of their classes, and these classes."""
        wanted = self.vocabulary.class_of[center]
        # Short numbers are sorted in one pass.
        order = np.argsort(wanted.astype(np.uint16) if self.first.size < 1 << 16 else wanted, kind="stable")
        return order, wanted[order]

    def log_probabilities(self, around: np.ndarray, center: np.ndarray) -> np.ndarray:
        out, bias = np.zeros(len(center)), self._bounded_bias()
        for at in range(0, len(center), BATCH):
            order, wanted = self._sorted(center[at:at + BATCH])
            tokens = center[at:at + BATCH][order]
            hidden, logits = self._forward(around[:, at + order])
            found = logits[np.arange(len(wanted)), wanted]
            found -= np.log(np.exp(logits, out=logits).sum(axis=1))
            for rows, _, inside in self._by_class(wanted, hidden, bias):
                found[rows] -= np.log(inside.sum(axis=1))
            # Words alone in their class are certain there.
            several = np.flatnonzero(np.diff(self.first)[wanted] > 1)
            own = tokens[several]
            found[several] += np.einsum("ij,ij->i", hidden[several], self.inner[own]) + bias[own]
            out[at + order] = found
        return out

    def train(self, around: np.ndarray, center: np.ndarray) -> None:
        """One pass of gradient steps over the windows, ``BATCH`` at a time."""
        for at in range(0, len(center), BATCH):
            order, wanted = self._sorted(center[at:at + BATCH])
            own = center[at:at + BATCH][order] - self.first[wanted]
            here = around[:, at + order]
            hidden, delta = self._forward(here)
            np.exp(delta, out=delta)
            delta *= 1 / delta.sum(axis=1, keepdims=True)
            delta[np.arange(len(wanted)), wanted] -= 1
            back = delta @ self.out.T
            rate = RATE / len(wanted)
            self.out -= rate * (hidden.T @ delta)
            self.out_bias -= rate * delta.sum(axis=0)
            for rows, tokens, inside in self._by_class(wanted, hidden, self._bounded_bias()):
                inside *= 1 / inside.sum(axis=1, keepdims=True)
                inside[np.arange(len(inside)), own[rows]] -= 1
                back[rows] += inside @ self.inner[tokens]
                # The mean over the words of the class, as of all words for the classes.
                part = RATE / (len(inside) + 8)
                self.inner[tokens] -= part * (inside.T @ hidden[rows])
                self.inner_bias[tokens] -= part * inside.sum(axis=0)
            back *= 1 - hidden * hidden
            self.bias -= rate * back.sum(axis=0)
            # Numbers of the tokens that occur: a step costs by them, not by the vocabulary.
            occurs = np.zeros(self.vocabulary.size, bool)
            occurs[here] = True
            tokens = np.flatnonzero(occurs)
            number = np.empty(len(occurs), np.int64)
            number[tokens] = np.arange(len(tokens))
            values, lanes = back.ravel(), np.arange(WIDTH)
            # Rows of frequent tokens get many gradients in a batch: their mean is taken.
            for place in range(len(PLACES)):
                rows = number[here[place]]
                cells = (rows[:, None] * WIDTH + lanes).ravel()
                step = np.bincount(cells, values, minlength=len(tokens) * WIDTH).reshape(-1, WIDTH)
                seen = np.bincount(rows, minlength=len(tokens))
                self.embed[place][tokens] -= (
                    RATE * 0.3 * step / np.sqrt(seen + 8)[:, None] / 8
                ).astype(np.float32)


def _token_batches(batches, vocabulary: Vocabulary):
    """Texts as windows: (batch, around, center, extra, others, lengths), ``TEXTS_AT_ONCE``
    whole documents at a time."""
    parts = (
        batch.slice(at, TEXTS_AT_ONCE)
        for batch in batches for at in range(0, batch.num_rows, TEXTS_AT_ONCE)
    )
    for batch in parts:
        said = [(t or "").encode().split() for t in batch.column("text").to_pylist()]
        lengths = np.array([len(words) for words in said], np.int64)
        center, extra, others = _look_up(list(chain.from_iterable(said)), vocabulary)
        around = windows(center, lengths, vocabulary.size - 1)
        yield batch, around, center, extra, others, lengths


def train_network(docs: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Parameters of the averaged network. Tasks emit sums of parameters times tokens."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary.sent())

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        network, tokens = Network(shared.value), 0
        for _, around, center, _, _, _ in _token_batches(batches, shared.value):
            network.train(around, center)
            tokens += len(center)
        if tokens:
            yield pa.RecordBatch.from_pydict(
                {"weight": [float(tokens)], "flat": [network.flat.tobytes()]}
            )

    def average(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["weight", "flat"])
        total = group["weight"].sum()
        mean = np.zeros(len(group["flat"].iloc[0]) // 4)
        for weight, flat in zip(group["weight"], group["flat"]):
            mean += np.frombuffer(flat, np.float32) * (weight / total)
        return pd.DataFrame({"weight": [total], "flat": [mean.astype(np.float32).tobytes()]})

    schema = "weight double, flat binary"
    fan = max(2, min(32, FAN_BYTES // Network(vocabulary.sent()).flat.nbytes))
    level = stash(docs.select("text").mapInArrow(learn, schema), "lm-trained")
    count = level.count()
    while count > 1:
        groups = -(-count // fan)
        # Numbered by content, dealt by number: groups have ``fan`` rows on average.
        keyed = level.withColumn("g", F.pmod(F.xxhash64("flat"), F.lit(groups)))
        level = stash(keyed.groupBy("g").applyInPandas(
            lambda pdf: average(pdf[["weight", "flat"]]), schema), "lm-averaged")
        count = level.count()
    first = level.first()
    return Network(vocabulary).flat if first is None else np.frombuffer(first.flat, np.float32)


def score_documents(docs: DataFrame, vocabulary: Vocabulary, flat: np.ndarray) -> DataFrame:
    """``doc_id, n_tokens, log_likelihood, per_token``, a row for each row of ``docs``.

    ``log_likelihood`` sums the conditional log-probabilities of all words of the whole
    text; ``per_token`` is their mean. Texts without words (null, empty, blank) have no
    tokens, log-likelihood 0 and a null mean. A word that was not counted is scored like one
    counted once. Scores are rounded to 6 digits.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.sent(), flat))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, parameters = shared.value
        network = Network(known, parameters)
        for batch, around, center, extra, others, lengths in _token_batches(batches, known):
            each = network.log_probabilities(around, center) + extra
            summed = np.concatenate(([0.0], np.cumsum(each)))
            ends = np.cumsum(lengths)
            total = summed[ends] - summed[ends - lengths]
            places, hashes = others
            bounds = np.searchsorted(places, np.concatenate(([0], ends))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths), pa.array(total),
                 pa.ListArray.from_arrays(pa.array(bounds), pa.array(hashes))],
                names=["doc_id", "n_tokens", "total", "others"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    schema = "doc_id long, n_tokens long, total double, others array<long>"
    scored = rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())
    scored = stash(scored, "lm-scored")
    # Unlisted words have the share of a word seen once so far; what repeats is added.
    repeated = scored.select("row", F.explode("others").alias("h")).join(
        vocabulary.rest.hint("merge"), "h"
    )
    more = repeated.groupBy("row").agg(F.sum("log_n").alias("more"))
    total = F.col("total") + F.coalesce("more", F.lit(0.0))
    return scored.drop("others").join(more, "row", "left").select(
        "doc_id", "n_tokens", F.round(total, 6).alias("log_likelihood"),
        F.when(F.col("n_tokens") > 0, F.round(total / F.col("n_tokens"), 6)).alias("per_token"),
    )


def score_corpus(docs: DataFrame) -> DataFrame:
    """Vocabulary, training and scores over all of ``docs``; an empty table has no rows.
    Repeated rows are scored alike, and count in training each."""
    vocabulary = build_vocabulary(docs)
    return score_documents(docs, vocabulary, train_network(docs, vocabulary))
