"""Toxicity by multiple-instance learning.

Only documents are labelled, sentences are not. A sentence has the probability
``sigmoid(bias + weights of its features)``; a document is toxic if any sentence is, so
its score is the noisy-or ``1 - prod(1 - p)``. Weights are trained through the noisy-or
from document labels alone, and the sentences that carry a document's score are located
with the weights so learned.

Features are words and their beginnings. Spark counts, over the labelled documents of the
fit, how many documents hold each feature and how many of those are toxic; features more
common in toxic documents than chance allows are kept. Each round of the training is one
pass over the sentences of the fit, whose partial gradients are summed.

Bounds: the fit takes about ``FIT_DOCUMENTS`` labelled documents, drawn by a hash of their
id, with their whole texts; the model has at most ``MOST_FEATURES`` features. Every
document is scored, all of its text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.session import stash

#: Labelled documents the fit takes, about.
FIT_DOCUMENTS = 50_000
MOST_FEATURES = 8_192
#: A feature is kept when toxic documents hold it this many standard deviations more often
#: than documents in general, and this many documents hold it.
LEAST_Z, LEAST_DOCUMENTS = 4.0, 5
#: Lengths of the beginnings of words that are features of their own.
BEGINNINGS = range(3, 10)
ROUNDS, STEP, DECAY, FIRST_BIAS = 40, 0.3, 1e-5, -5.0
#: Tasks a training round is dealt over; the fit is bounded, so this is too.
FIT_PIECES = 16
#: Distinct features or words a task holds before it passes on or forgets them.
HELD = 200_000
TOXIC = 0.5

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W_]+")


def features_of(word: str) -> list[str]:
    """A word and its beginnings; these end with a star, which no word does."""
    return [word, *[f"{word[:n]}*" for n in BEGINNINGS if len(word) >= n]]


def sentences_of(text: str) -> list[tuple[int, int, list[str]]]:
    """Start, end (in characters) and lower-case words of each sentence with a word."""
    found = [(m.start(), m.end(), _WORD.findall(m.group().lower())) for m in _SENTENCE.finditer(text)]
    return [s for s in found if s[2]]


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents whose labels are never learned from; a null id
    counts as an empty one."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def fit_documents(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> DataFrame:
    """``text, toxic`` of the documents to learn from: labelled 0 or 1, not held out, about
    ``most`` of them. Of several labels of one document the highest counts."""
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id")
    known = stash(known.agg(F.max("toxic").cast("int").alias("toxic")), "toxic-labels")
    share = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, known.count()))) < most
    # About ``most`` rows of two numbers, whatever there is: no text is shuffled.
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(known.where(share)), "doc_id").select("text", "toxic")


def feature_counts(fit: DataFrame) -> DataFrame:
    """``feature, n, n_toxic``: documents that hold each feature."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, toxic = Counter(), Counter()

        def done() -> pa.RecordBatch:
            names = list(seen)
            columns = [names, [seen[f] for f in names], [toxic[f] for f in names]]
            types = (pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["feature", "n", "n_toxic"]
            )

        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                words = {w for _, _, said in sentences_of(text.as_py()) for w in said}
                found = {f for w in words for f in features_of(w)}
                seen.update(found)
                if label:
                    toxic.update(found)
                if len(seen) > HELD:
                    yield done()
                    seen, toxic = Counter(), Counter()
        yield done()

    parts = fit.mapInArrow(count, "feature string, n long, n_toxic long")
    return parts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"))


def chosen_features(counts: DataFrame, n: int, n_toxic: int) -> list[tuple[str, float]]:
    """The features of the model, the most telling first, each with the logarithm of how
    much more often toxic documents hold it."""
    share = n_toxic / n if n else 0.0
    if not 0 < share < 1:
        return []
    expected = F.col("n") * share
    z = (F.col("n_toxic") - expected) / F.sqrt(expected * (1 - share))
    lift = F.log(
        ((F.col("n_toxic") + 1) / (n_toxic + 2)) / ((F.col("n") - F.col("n_toxic") + 1) / (n - n_toxic + 2))
    )
    told = counts.where((F.col("n") >= LEAST_DOCUMENTS) & (z >= LEAST_Z))
    top = told.select("feature", z.alias("z"), lift.alias("lift"))
    top = top.orderBy(F.desc("z"), "feature").limit(MOST_FEATURES)
    return [(r.feature, r.lift) for r in top.collect()]


_START = min(BEGINNINGS)


class _Known(dict):
    """Numbers of the features of a word, worked out when the word is first met."""

    def __init__(self, names: list[str]):
        super().__init__()
        self.number = {name: n for n, name in enumerate(names)}
        #: Most words begin like no feature, which is cheaper to see than to look them up.
        self.starts = {name.rstrip("*")[:_START] for name in names}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > HELD:
            self.clear()
        if word[:_START] not in self.starts:
            self[word] = ()
            return ()
        found = tuple(self.number[f] for f in features_of(word) if f in self.number)
        self[word] = found
        return found


def _hits(known: _Known, words: list[str]) -> list[int]:
    return sorted({n for w in words for n in known[w]})


_BAGS = "toxic int, n_plain int, sentence array<int>, feature array<int>"


def bags(fit: DataFrame, names: list[str]) -> DataFrame:
    """Documents as bags of sentences: ``feature`` holds the feature numbers of all
    sentences with any, ``sentence`` the sentence each is in; ``n_plain`` sentences have
    none."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(names)
        for batch in batches:
            plain, sentence, feature = [], [], []
            for text in batch.column("text"):
                hits = [_hits(known, words) for _, _, words in sentences_of(text.as_py())]
                real = [h for h in hits if h]
                plain.append(len(hits) - len(real))
                sentence.append([n for n, h in enumerate(real) for _ in h])
                feature.append([f for h in real for f in h])
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("toxic"), pa.array(plain, pa.int32()),
                    pa.array(sentence, lists), pa.array(feature, lists),
                ],
                ["toxic", "n_plain", "sentence", "feature"],
            )

    return fit.mapInArrow(read, _BAGS)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def gradient(
    weights: np.ndarray, bias: float, toxic: np.ndarray, plain: np.ndarray,
    bag: np.ndarray, of_sentence: np.ndarray, feature: np.ndarray,
) -> np.ndarray:
    """Summed gradient of the log loss of the noisy-or: one number a weight, then the
    bias. ``bag`` is the document of each sentence with features, ``of_sentence`` the
    sentence of each feature.

    With P the document's score and p a sentence's, the gradient by the sentence's logit
    is p for a clean document and ``p (P - 1) / P`` for a toxic one.
    """
    p = _sigmoid(bias + np.bincount(of_sentence, weights[feature], minlength=len(bag)))
    p0 = _sigmoid(bias)
    none = np.bincount(bag, np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(toxic))
    score = np.clip(1 - np.exp(none + plain * np.log1p(-p0)), 1e-6, 1 - 1e-9)
    pull = np.where(toxic == 1, (score - 1) / score, 1.0)
    by_logit = p * pull[bag]
    by_weight = np.bincount(feature, by_logit[of_sentence], minlength=len(weights))
    return np.append(by_weight, by_logit.sum() + (p0 * plain * pull).sum())


def _batch_gradient(weights: np.ndarray, bias: float, batch: pa.RecordBatch) -> np.ndarray:
    toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
    plain = batch.column("n_plain").to_numpy(zero_copy_only=False)
    sentence, feature = batch.column("sentence"), batch.column("feature")
    inside = sentence.flatten().to_numpy(zero_copy_only=False)
    document = np.repeat(np.arange(batch.num_rows), np.diff(sentence.offsets.to_numpy()))
    # A sentence begins where the document or the number in it changes.
    new = np.ones(len(inside), bool)
    new[1:] = (np.diff(inside) != 0) | (np.diff(document) != 0)
    return gradient(
        weights, bias, toxic, plain, document[new], np.cumsum(new) - 1,
        feature.flatten().to_numpy(zero_copy_only=False),
    )


def train(rows: DataFrame, first: list[float], n: int) -> tuple[np.ndarray, float]:
    """Weights and bias after ``ROUNDS`` full passes over the bags, by adaptive steps. A
    round returns one gradient a piece, at most ``FIT_PIECES * MOST_FEATURES`` numbers."""
    size = len(first)
    model = np.append(np.array(first, float), FIRST_BIAS)
    mean, spread = np.zeros(size + 1), np.zeros(size + 1)
    for turn in range(1, ROUNDS + 1):
        weights, bias = model[:-1].copy(), float(model[-1])

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size + 1)
            for batch in batches:
                total += _batch_gradient(weights, bias, batch)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["g"])

        parts = rows.mapInArrow(part, "g binary").collect()
        slope = sum((np.frombuffer(r.g) for r in parts), np.zeros(size + 1)) / n
        slope[:-1] += DECAY * weights
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope**2
        step = mean / (1 - 0.9**turn) / (np.sqrt(spread / (1 - 0.99**turn)) + 1e-6)
        # Rounded, so that the order in which parts were added up does not show.
        model = np.round(model - STEP * step, 9)
    return model[:-1], float(model[-1])


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> dict[str, object]:
    """A model: ``names`` of the features, ``weights`` and ``bias``. Without documents of
    both labels it has no features and a bias that calls nothing toxic."""
    rows = stash(fit_documents(docs, labels, most), "toxic-fit")
    n, n_toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    chosen = chosen_features(feature_counts(rows), n, n_toxic)
    names = [name for name, _ in chosen]
    if not names:
        return {"names": [], "weights": np.zeros(0), "bias": -20.0}
    held = stash(bags(rows, names).repartition(FIT_PIECES), "toxic-bags")
    weights, bias = train(held.coalesce(FIT_PIECES), [lift for _, lift in chosen], n)
    return {"names": names, "weights": weights, "bias": bias}


_SPAN = T.StructType(
    [
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
    ]
)
_ADDED = T.StructType(
    [
        T.StructField("score", T.DoubleType()), T.StructField("n_sentences", T.IntegerType()),
        T.StructField("worst", _SPAN), T.StructField("offending", T.ArrayType(_SPAN)),
    ]
)


def _as_span(span: tuple[int, int, float]) -> dict[str, float]:
    return dict(zip(_SPAN.names, span))


def scored(docs: DataFrame, model: dict[str, object]) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``n_sentences``, ``worst`` (the sentence of the
    highest score, the first of several; null without sentences) and ``offending`` (all
    sentences of a score of 0.5 or more), each with its start and end in characters.

    A null or empty text has no sentences and scores 0. Repeated rows score alike; other
    columns pass through, those of these names are replaced; an empty table gives no rows.
    """
    docs = docs.drop(*_ADDED.names)
    names, weights, bias = model["names"], model["weights"].tolist(), model["bias"]
    at = docs.columns.index("text")
    p0 = float(_sigmoid(bias))
    none0, shown0 = math.log1p(-p0), round(p0, 6)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(names)
        for batch in batches:
            scores, counts, worst, offending = [], [], [], []
            for text in batch.column(at):
                n, none, most, bad = 0, 0.0, None, []
                for start, end, words in sentences_of(text.as_py() or ""):
                    n += 1
                    hits = [f for w in words for f in known[w]]
                    if hits:
                        z = bias + sum(weights[f] for f in sorted(set(hits)))
                        p = 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))
                        none += math.log1p(-min(p, 1 - 1e-9))
                        shown = round(p, 6)
                    else:
                        none += none0
                        shown = shown0
                    if most is None or shown > most[2]:
                        most = start, end, shown
                    if shown >= TOXIC:
                        bad.append((start, end, shown))
                scores.append(round(1 - math.exp(none), 6))
                counts.append(n)
                worst.append(_as_span(most) if most else None)
                offending.append([_as_span(s) for s in bad])
            added = [
                pa.array(scores, pa.float64()), pa.array(counts, pa.int32()),
                pa.array(worst, span), pa.array(offending, pa.list_(span)),
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added], [*batch.schema.names, *_ADDED.names]
            )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *_ADDED.fields]))
