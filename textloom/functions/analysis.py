"""Text analysis for search and row-local term counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Word boundaries of Unicode text segmentation: letters may be joined by one
# apostrophe, point, colon or middle dot, digits by one apostrophe, point, comma
# or semicolon, and either by underscores. Ideographs stand alone.
_IDEOGRAPH = r"[\p{IsHan}\p{IsHiragana}]"
_LETTER = r"[\p{L}&&[^\p{IsHan}\p{IsHiragana}]]\p{M}*+"
_WORD = (
    rf"{_IDEOGRAPH}|_*+(?:(?:{_LETTER}(?:['’.:·]?{_LETTER})*+"
    r"|\p{N}(?:['’.,;]?\p{N})*+)_*+)++"
)
MAX_TOKEN_CHARS = 255


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once per row, not once per use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _cut_long(words: Column) -> Column:
    def cut(word: Column) -> Column:
        return F.regexp_extract_all(word, F.lit(f"(?s).{{1,{MAX_TOKEN_CHARS}}}"), F.lit(0))

    too_long = F.exists(words, lambda word: F.length(word) > MAX_TOKEN_CHARS)
    return F.when(too_long, F.flatten(F.transform(words, cut))).otherwise(words)


def analyze(text: Column) -> Column:
    """Lower-case words of a text, in order; no stemming, no stop words."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_WORD), F.lit(0))
    return let(words, _cut_long)


def with_term_counts(df: DataFrame, tokens: str, out: str) -> DataFrame:
    """Add ``out``: ``array<struct<term, tf>>`` counted inside each row.

    A document is one row, so its counts need no grouping: sort the tokens, find
    where each run starts, and take the distance to the next start. Nothing is
    shuffled, whatever the number of documents or the size of one of them.
    """
    words, starts = f"__{out}_sorted", f"__{out}_starts"
    return (
        df.withColumn(words, F.sort_array(tokens))
        .withColumn(
            starts,
            F.filter(
                F.transform(
                    words,
                    lambda word, i: F.when(
                        (i == 0) | (word != F.coalesce(F.get(words, i - 1), F.lit(""))), i
                    ),
                ),
                lambda i: i.isNotNull(),
            ),
        )
        .withColumn(
            out,
            F.transform(
                starts,
                lambda start, k: F.struct(
                    F.get(words, start).alias("term"),
                    (F.coalesce(F.get(starts, k + 1), F.size(words)) - start)
                    .cast("long")
                    .alias("tf"),
                ),
            ),
        )
        .drop(words, starts)
    )


def explode_structs(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """One row per struct of ``column``, its fields beside the ``keep`` columns.

    The outer form is used on purpose: for the plain one the optimizer adds a
    "not empty" filter and pushes it, with the whole array expression inside it,
    down to the scan, where it is worked out again for every use.
    """
    first = df.schema[column].dataType.elementType.names[0]
    return df.select(*keep, F.inline_outer(column)).where(F.col(first).isNotNull())
