"""Language detection by stop-word hits, and stop-word removal.

Everything is row-local: word lists become hash sets inside the expression, so
neither step explodes or shuffles the text.
"""

from __future__ import annotations

import functools
import zipfile
from pathlib import Path

import pyspark
from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.analysis import let

#: Languages told apart. Only the first two are named in the result; the others
#: are there so that their texts are not taken for English or French.
LANGUAGES = ("english", "french", "german", "spanish")
NAMED = ("english", "french")
UNKNOWN = "unknown"

_WORD = r"[\p{L}]+"


@functools.cache
def stop_words(language: str) -> tuple[str, ...]:
    """Spark's own list for a language, read from the jar that ships it."""
    jars = Path(pyspark.__file__).parent / "jars"
    name = f"org/apache/spark/ml/feature/stopwords/{language}.txt"
    for jar in sorted(jars.glob("spark-mllib_*.jar")):
        with zipfile.ZipFile(jar) as archive:
            return tuple(archive.read(name).decode("utf-8").split("\n"))
    from pyspark.ml.feature import StopWordsRemover

    return tuple(StopWordsRemover.loadDefaultStopWords(language))


def hit_words(language: str) -> list[str]:
    """Stop words made of letters only, as text split into letter runs yields them."""
    return sorted({word.strip() for word in stop_words(language) if word.strip().isalpha()})


def _hits(words: Column) -> Column:
    def count(lang: str) -> Column:
        return F.size(F.filter(words, lambda word: word.isin(*hit_words(lang)))).alias(lang)

    return F.struct(*[count(lang) for lang in LANGUAGES])


def _label(hits: Column) -> Column:
    best = F.greatest(*[hits[lang] for lang in LANGUAGES])
    label = F.when(best == 0, F.lit(UNKNOWN))
    for lang in LANGUAGES:
        label = label.when(hits[lang] == best, F.lit(lang if lang in NAMED else UNKNOWN))
    return label


def detect_language(text: Column) -> Column:
    """english, french or unknown: the language with most hits, if it has any.

    Ties go to the earlier name in ``LANGUAGES``.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))
    every = sorted({word for lang in LANGUAGES for word in hit_words(lang)})
    stop_words_only = F.filter(words, lambda word: word.isin(*every))
    return let(let(stop_words_only, _hits), _label)


def drop_stop_words(tokens: Column, language: Column) -> Column:
    """Tokens longer than one letter that are no stop word of their language."""

    def keep(words: Column, lang: str | None) -> Column:
        if lang is None:
            return F.filter(words, lambda word: F.length(word) > 1)
        return F.filter(
            words, lambda word: (F.length(word) > 1) & ~word.isin(*stop_words(lang))
        )

    def by_language(row: Column) -> Column:
        words, name = row["words"], row["name"]
        kept = F.when(name == NAMED[0], keep(words, NAMED[0]))
        for lang in NAMED[1:]:
            kept = kept.when(name == lang, keep(words, lang))
        return kept.otherwise(keep(words, None))

    return let(F.struct(tokens.alias("words"), language.alias("name")), by_language)
