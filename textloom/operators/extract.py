"""Pages to items: extraction, cleaning, validation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import fixed
from textloom.functions.html import page_text
from textloom.functions.text import clean_text
from textloom.session import bound_batches

REQUIRED = ("title", "url", "content")


def extract_pages(
    pages: DataFrame,
    exclude_keywords: Iterable[str] = fixed.EXCLUDE_KEYWORDS,
    exclude_tags: Iterable[str] = (),
) -> DataFrame:
    """``page_id, title, url, content`` of every page, in one pass over its HTML."""
    bound_batches(pages.sparkSession)
    parsed = pages.withColumn("page", page_text(F.col("html"), exclude_keywords, exclude_tags))
    return parsed.select("page_id", "page.title", "url", "page.content")


def emitted(extracted: DataFrame) -> DataFrame:
    """Pages that give an item: no robots file, and some visible text."""
    return extracted.where(~F.col("url").contains("robots.txt") & (F.col("content") != ""))


def decoded_pages(
    pages: DataFrame,
    exclude_keywords: Iterable[str] = fixed.EXCLUDE_KEYWORDS,
    exclude_tags: Iterable[str] = (),
) -> DataFrame:
    """``extract_pages`` of all but robots files, with entities and leftover tags resolved
    and characters not yet cleaned, in one pass over the HTML; ``shown`` tells whether a
    page has visible text."""
    bound_batches(pages.sparkSession)
    named = pages.where(~F.col("url").contains("robots.txt"))
    text = page_text(F.col("html"), exclude_keywords, exclude_tags, decoded=True)
    read = named.withColumn("page", text)
    return read.select("page_id", "page.title", "url", "page.content", "page.shown")


def clean_items(items: DataFrame) -> DataFrame:
    return items.withColumns(
        {"title": clean_text(F.col("title")), "content": clean_text(F.col("content"))}
    )


def _has(name: str):
    return F.coalesce(F.col(name), F.lit("")) != ""


def valid_items(cleaned: DataFrame) -> DataFrame:
    """Items with all required fields."""
    title, url, content = (_has(name) for name in REQUIRED)
    return cleaned.where(title & url & content)


def rejected_items(cleaned: DataFrame) -> DataFrame:
    """The other items, with a flag per field telling whether it is there."""
    title, url, content = (_has(name) for name in REQUIRED)
    return cleaned.where(~(title & url & content)).select(
        "page_id",
        "url",
        title.alias("has_title"),
        url.alias("has_url"),
        content.alias("has_content"),
    )


def split_kinds(records: DataFrame, kind: str = "kind") -> tuple[DataFrame, DataFrame]:
    """(items, everything else). Only items are cleaned and validated."""
    is_item = F.coalesce(F.col(kind) == "item", F.lit(False))
    return records.where(is_item), records.where(~is_item)
