"""A language detector trained on labelled texts.

A text is the counts of its hashed character trigrams; the model is, for each language, the
logarithm of every trigram's share in the labelled texts of that language. The counts are
one aggregate over the corpus, the model is a table of fixed size, and texts are scored
where they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.language import NAMED, UNKNOWN
from textloom.session import stash

#: Hash buckets of the trigrams.
BUCKETS = 8_192
#: Languages of a model: the most common labels. With the buckets they bound its size.
MOST_LANGUAGES = 64
#: Characters looked at in one go; a longer text is counted piece by piece.
CHARS_AT_ONCE = 1 << 20
#: Labels with a name in results; all others are unknown there.
NAMES = {"en": NAMED[0], "fr": NAMED[1]}


class LanguageModel(NamedTuple):
    """``weights``: a row for each bucket, a column for each of ``languages``."""

    languages: list[str]
    weights: np.ndarray


def _trigrams(codes: np.ndarray) -> np.ndarray:
    """Buckets of the trigrams around every letter of a piece, its ends left out.

    Capitals of Latin-1 are folded, and whatever is no letter counts as a blank. Letters
    are those of ASCII and all characters from the sharp s on but the division sign.
    """
    codes = codes.astype(np.int64)
    capital = ((codes >= 65) & (codes <= 90)) | ((codes >= 192) & (codes <= 222) & (codes != 215))
    folded = codes + 32 * capital
    letter = ((folded >= 97) & (folded <= 122)) | ((folded >= 223) & (folded != 247))
    folded = np.where(letter, folded, 32)
    hashed = (folded[:-2] * 961 + folded[1:-1] * 31 + folded[2:]) % BUCKETS
    return hashed[letter[1:-1]]


def trigram_counts(text: str) -> np.ndarray:
    """Occurrences by bucket, over the whole text."""
    codes = np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), np.uint32)
    counts = np.zeros(BUCKETS, np.int64)
    for start in range(0, len(codes) - 2, CHARS_AT_ONCE):
        found = _trigrams(codes[start : start + CHARS_AT_ONCE + 2])
        counts += np.bincount(found, minlength=BUCKETS)
    return counts


def language_counts(docs: DataFrame) -> DataFrame:
    """``lang, bucket, n`` over all texts with a label: ``docs`` is ``content, lang``. A
    task hands on at most one row a language and bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("content"), batch.column("lang").to_pylist()):
                counts = trigram_counts(text.as_py())
                totals[lang] = totals[lang] + counts if lang in totals else counts
        for lang, counts in totals.items():
            held = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(held)), pa.array(held, pa.int32()), pa.array(counts[held])],
                ["lang", "bucket", "n"],
            )

    known = docs.select("content", "lang").where("content IS NOT NULL AND lang IS NOT NULL")
    parts = known.mapInArrow(count, "lang string, bucket int, n long")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train_languages(docs: DataFrame, most: int = MOST_LANGUAGES) -> LanguageModel:
    """A model of the ``most`` languages with the most labelled trigrams; at most
    ``most * BUCKETS`` counts reach the driver. Without labels it knows no language."""
    counts = stash(language_counts(docs), "language-counts")
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(most)
    languages = sorted(row["lang"] for row in sizes.collect())
    found = np.zeros((BUCKETS, len(languages)))
    for row in counts.where(F.col("lang").isin(languages)).collect():
        found[row["bucket"], languages.index(row["lang"])] = row["n"]
    return LanguageModel(languages, np.log((found + 1) / (found.sum(axis=0) + BUCKETS)))


def most_likely(text: Column, model: LanguageModel) -> Column:
    """The label of the most likely language, ties to the first by name; null for a text
    without letters, or without a model."""

    @F.pandas_udf("string")
    def label(texts: pd.Series) -> pd.Series:
        found = []
        for said in texts:
            counts = trigram_counts(said or "")
            known = model.languages and counts.any()
            found.append(model.languages[int(np.argmax(counts @ model.weights))] if known else None)
        return pd.Series(found, dtype=object)

    return label.asNondeterministic()(text)


def detect_trained(text: Column, model: LanguageModel) -> Column:
    """english, french or unknown, by a trained model: takes the place of
    ``functions.language.detect_language``."""
    names = F.create_map(*[F.lit(part) for pair in NAMES.items() for part in pair])
    return F.coalesce(F.element_at(names, F.coalesce(most_likely(text, model), F.lit(""))), F.lit(UNKNOWN))
