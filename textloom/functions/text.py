"""Text cleaning and projection as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions import fixed
from textloom.functions.analysis import let
from textloom.functions.html import without_markup

_LINK = rf"http[^{fixed.SPACE_CLASS}]+"
# "Not one of these" is a cheap ASCII class that finds candidates, and a look-behind
# that decides about them. One negated class with all characters in it is tested
# at every position and runs ten times slower in the JVM.
_NOT_KEPT = rf"[\W_&&\S](?<![À-ÿ'’\-.,;!?(){fixed.SPACE_CLASS}])"
_NOT_LETTER = rf"[\W\d_&&\S](?<![àâçéèêëîïôûùüÿñæœ{fixed.SPACE_CLASS}])"
_ODD_SPACE = rf"[^ -~\s](?<=[{fixed.SPACE_CLASS}])"
_PAGE_SUFFIX = rf"(?i)[{fixed.SPACE_CLASS}]*-[{fixed.SPACE_CLASS}]*Page[{fixed.SPACE_CLASS}]*\p{{Nd}}+"
# Words the tokenizer splits in two. The test for a word start comes after the
# first half so that it runs on candidates only.
_HALVED = ("cannot", "gimme", "gonna", "gotta", "lemme", "wanna")
_SPLIT_WORDS = (
    r"(can(?=not)|gim(?=me)|gon(?=na)|got(?=ta)|lem(?=me)|wan(?=na))"
    rf"(?<![^{fixed.SPACE_CLASS}].{{3}})(not|me|na|ta)(?![^{fixed.SPACE_CLASS}])"
)


def _plain_spaces(text: Column) -> Column:
    """Whitespace outside ASCII, and separators, as plain spaces."""
    return F.regexp_replace(text, _ODD_SPACE, " ")


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(_plain_spaces(text), r"\s+", " "))


def clean_characters(text: Column) -> Column:
    """Keep letters, digits and basic punctuation; single spaces; trimmed."""
    return collapse_spaces(F.regexp_replace(text, _NOT_KEPT, ""))


def keeps_something(text: Column) -> Column:
    """True when ``clean_characters`` leaves something; ends at the first such sign."""
    return F.coalesce(text.rlike(r"[a-zA-Z0-9À-ÿ'’\-.,;!?()]"), F.lit(False))


def clean_text(text: Column) -> Column:
    """Item cleaning: entities and tags first, then characters and spaces."""
    return clean_characters(without_markup(text))


def keyword_clean(text: Column) -> Column:
    """Lower-case letters and spaces only; anything else is deleted, not spaced."""

    def without_links(lowered: Column) -> Column:
        found = lowered.contains("http")
        return F.when(found, F.regexp_replace(lowered, _LINK, "")).otherwise(lowered)

    return F.regexp_replace(let(F.lower(text), without_links), _NOT_LETTER, "")


def tokenize(cleaned: Column) -> Column:
    """Words of keyword-cleaned text."""

    def halved(text: Column) -> Column:
        # A plain substring test is far cheaper than the pattern, and mostly fails.
        found = F.lit(False)
        for word in _HALVED:
            found = found | text.contains(word)
        return F.when(found, F.regexp_replace(text, _SPLIT_WORDS, "$1 $2")).otherwise(text)

    words = F.split(_plain_spaces(let(cleaned, halved)), r"\s+")
    return F.filter(words, lambda word: word != "")


def snippet(content: Column) -> Column:
    return F.concat(F.substring(content, 1, fixed.SNIPPET_CHARS), F.lit("..."))


def normalize_title(title: Column) -> Column:
    """Title without its " - Page 3" parts, so pages of one series compare equal."""
    return F.regexp_replace(title, _PAGE_SUFFIX, "")
