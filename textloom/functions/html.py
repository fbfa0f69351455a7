"""HTML to title, visible text and links, as one Arrow-batched pandas UDF.

Ancestor tests need an element stack, which no built-in expression offers, so
this is the one place page bytes cross into Python. A page is scanned once, by a
compiled pattern, and only ``id``, ``class`` and ``href`` values are looked at.
The UDFs are marked non-deterministic so that a filter on their result is not
pushed below them, which would run them twice per page.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import fixed
from textloom.schemas import LINK

# One token of markup. Every alternative may end at the end of the page, so a
# truncated page costs a single pass and its cut-off tag is not taken as text.
_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)
      | <(?P<raw>script|style)(?=[\s/>])[^>]*(?:>.*?(?:</(?P=raw)\b[^>]*(?:>|\Z)|\Z)|\Z)
      | <[!?][^>]*(?:>|\Z)
      | </(?P<close>[a-z][^\s/>]*)?[^>]*(?:>|\Z)
      | <(?P<open>[a-z][^\s/>]*)(?P<attrs>(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?)*+)(?:>|\Z)
    """,
    re.S | re.I | re.X,
)
_ATTRIBUTE = re.compile(
    r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']*)))?"""
)
_ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_HEAD_ONLY = frozenset("html head title base link meta script style noscript".split())
_NO_TEXT = frozenset(("noscript", "iframe"))
# Elements an opening tag ends when they are still open right above it.
_BLOCKS = frozenset(
    "address article aside blockquote center div dl fieldset footer form h1 h2 h3 h4 h5 "
    "h6 header hr main menu nav ol p pre section table ul".split()
)
_ENDED_BY = {
    "p": _BLOCKS,
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "option": frozenset(("option", "optgroup")),
    "td": frozenset(("td", "th", "tr", "tbody", "tfoot")),
    "th": frozenset(("td", "th", "tr", "tbody", "tfoot")),
    "tr": frozenset(("tr", "tbody", "tfoot")),
    "head": frozenset(("body",)),
}
# A stray end tag never closes an element that binds tighter than itself.
_STRENGTH = {
    "div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180,
    "tfoot": 180, "table": 190, "head": 200, "body": 200, "html": 220,
}
_WEAKEST = 100


class Text(NamedTuple):
    value: str


class Open(NamedTuple):
    name: str
    attrs: str


class Close(NamedTuple):
    name: str


def _tokens(page: str) -> Iterator[Text | Open | Close]:
    at = 0
    for match in _MARKUP.finditer(page):
        if match.start() > at:
            yield Text(page[at : match.start()])
        at = match.end()
        if match["open"]:
            yield Open(match["open"].lower(), match["attrs"])
        elif match["close"]:
            yield Close(match["close"].lower())
    if at < len(page):
        yield Text(page[at:])


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), html_lib.unescape(double or single or bare))
    return found


class PageReader:
    """Reads one page at a time; holds only the compiled options."""

    def __init__(
        self,
        exclude_keywords: Iterable[str] = fixed.EXCLUDE_KEYWORDS,
        exclude_tags: Iterable[str] = (),
    ):
        words = [re.escape(word) for word in exclude_keywords]
        self._excluded = re.compile("|".join(words)) if words else None
        self._silent_tags = _NO_TEXT | frozenset(tag.lower() for tag in exclude_tags)

    def _hides(self, tag: Open) -> bool:
        if tag.name in self._silent_tags:
            return True
        if self._excluded is None or not tag.attrs or tag.attrs.isspace():
            return False
        lowered = tag.attrs.lower()
        if "id" not in lowered and "class" not in lowered:
            return False
        attrs = _attributes(tag.attrs)
        return any(
            self._excluded.search(attrs.get(key, "").translate(_ASCII_LOWER))
            for key in ("id", "class")
        )

    def read(self, page: str) -> tuple[str, str]:
        """(title, visible text), both trimmed."""
        title: str | None = None
        shown: list[str] = []
        stack: list[tuple[str, bool]] = []
        hidden = 0
        in_body = False
        for token in _tokens(page):
            if type(token) is Text:
                value = html_lib.unescape(token.value) if "&" in token.value else token.value
                inside = stack[-1][0] if stack else ""
                if inside == "title":
                    title = value if title is None else title
                elif not in_body and not value.isspace():
                    in_body = True
                if in_body and not hidden:
                    shown.append(value)
            elif type(token) is Open:
                name = token.name
                if name not in _HEAD_ONLY:
                    in_body = True
                while stack and name in _ENDED_BY.get(stack[-1][0], ()):
                    hidden -= stack.pop()[1]
                if name not in _VOID:
                    hides = self._hides(token)
                    stack.append((name, hides))
                    hidden += hides
            elif token.name not in ("body", "html"):
                strength = _STRENGTH.get(token.name, _WEAKEST)
                for depth in range(len(stack) - 1, -1, -1):
                    name = stack[depth][0]
                    if name == token.name:
                        hidden -= sum(hides for _, hides in stack[depth:])
                        del stack[depth:]
                        break
                    if _STRENGTH.get(name, _WEAKEST) > strength:
                        break
        return (title or "").strip(), " ".join(shown).strip()


def page_links(page: str, url: str) -> list[dict[str, str]]:
    """Followable targets of a page in order, once per resolved URL."""
    base = url
    seen: dict[str, str] = {}
    for token in _tokens(page):
        if type(token) is not Open or token.name not in ("a", "area", "base"):
            continue
        href = _attributes(token.attrs).get("href")
        if href is None:
            continue
        try:
            target = urljoin(base, href.strip())
        except ValueError:
            continue
        if token.name == "base":
            base = target
        elif target.split("://", 1)[0] in fixed.LINK_SCHEMES and "://" in target:
            seen.setdefault(target, href)
    return [{"href": href, "dst_url": target} for target, href in seen.items()]


_ENTITY = re.compile("&[#A-Za-z]")


def strip_markup(text: str) -> str:
    """Decode entities, then drop tags if any seem left in the text."""
    text = html_lib.unescape(text).replace("\xa0", " ")
    if "<" in text and ">" in text:
        return " ".join(
            html_lib.unescape(token.value) for token in _tokens(text) if type(token) is Text
        )
    return text


def _needs_stripping(text: str) -> bool:
    return ("&" in text and _ENTITY.search(text) is not None) or ("<" in text and ">" in text)


def page_text(
    html: Column,
    exclude_keywords: Iterable[str] = fixed.EXCLUDE_KEYWORDS,
    exclude_tags: Iterable[str] = (),
    decoded: bool = False,
) -> Column:
    """``struct<title, content, shown>`` of a page; ``shown`` tells whether it has visible
    text. ``decoded`` resolves entities and leftover tags of both in the same pass."""
    reader = PageReader(exclude_keywords, exclude_tags)
    fields = [T.StructField("title", T.StringType()), T.StructField("content", T.StringType())]

    def read(page: str) -> tuple[str, str, bool]:
        title, content = reader.read(page)
        shown = content != ""
        if decoded:
            title, content = (
                strip_markup(text) if _needs_stripping(text) else text for text in (title, content)
            )
        return title, content, shown

    @F.pandas_udf(T.StructType([*fields, T.StructField("shown", T.BooleanType())]))
    def read_pages(pages: pd.Series) -> pd.DataFrame:
        rows = [read(page or "") for page in pages]
        return pd.DataFrame(rows, columns=["title", "content", "shown"], dtype=object)

    return read_pages.asNondeterministic()(html)


def links_of(url: Column, html: Column) -> Column:
    """``array<struct<href, dst_url>>`` of a page."""

    @F.pandas_udf(T.ArrayType(LINK))
    def read_links(urls: pd.Series, pages: pd.Series) -> pd.Series:
        return pd.Series(
            [page_links(page or "", url or "") for url, page in zip(urls, pages)], dtype=object
        )

    return read_links.asNondeterministic()(url, html)


def without_markup(text: Column) -> Column:
    """``strip_markup`` for the few rows that need it; the rest stay in the JVM.

    A Python UDF is evaluated for every row whatever ``when`` says, so rows that
    need nothing are sent as NULL.
    """

    @F.pandas_udf(T.StringType())
    def strip_all(texts: pd.Series) -> pd.Series:
        return pd.Series(
            [None if text is None else strip_markup(text) for text in texts], dtype=object
        )

    needed = text.rlike("&[#A-Za-z]") | (text.contains("<") & text.contains(">"))
    return F.coalesce(strip_all.asNondeterministic()(F.when(needed, text)), text)
