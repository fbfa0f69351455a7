"""The page job: pages in, clean valid items out."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import fixed
from textloom.functions.text import clean_characters, keeps_something
from textloom.operators.extract import (
    clean_items,
    decoded_pages,
    emitted,
    extract_pages,
)
from textloom.operators.links import unseen, without_repeats


def cleaned_items(
    pages: DataFrame,
    exclude_keywords: Iterable[str] = fixed.EXCLUDE_KEYWORDS,
    exclude_tags: Iterable[str] = (),
) -> DataFrame:
    return clean_items(emitted(extract_pages(pages, exclude_keywords, exclude_tags)))


def pages_to_items(
    pages: DataFrame,
    seen_urls: DataFrame | None = None,
    exclude_keywords: Iterable[str] = fixed.EXCLUDE_KEYWORDS,
    exclude_tags: Iterable[str] = (),
) -> DataFrame:
    """``page_id, title, url, content`` of valid items, each URL once: its row with the
    smallest ``page_id`` gives the item, or none if it is blank. No page is shuffled
    unless very many URLs repeat.

    URLs already seen, and repeats, are removed before a page is parsed, not after.
    """
    if seen_urls is not None:
        pages = unseen(pages, seen_urls)
    pages = without_repeats(pages)
    return items_of(decoded_pages(pages, exclude_keywords, exclude_tags))


def items_of(decoded: DataFrame) -> DataFrame:
    """Clean valid items of decoded pages."""
    # A filter on cleaned fields would have them cleaned twice, in the filter and
    # in the projection; whether anything is left of a field is cheaper to see.
    title, content = F.col("title"), F.col("content")
    kept = decoded.where("shown").where(
        keeps_something(title) & keeps_something(content) & (F.col("url") != "")
    )
    return kept.drop("shown").withColumns(
        {"title": clean_characters(title), "content": clean_characters(content)}
    )
