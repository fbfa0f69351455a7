"""Extraction rules, one page each."""

import pytest
from pyspark.sql import functions as F

from textloom.functions.html import PageReader, page_links, strip_markup
from textloom.functions.text import clean_text
from textloom.operators.extract import extract_pages
from textloom.plans.items import pages_to_items

PAGE = (
    "<!doctype html><html><head><title>Test Page</title><style>p {margin: 0}</style></head>"
    "<body><main class='text'><script>let seen = 0;</script>"
    "<p>This is a test paragraph.</p><style>main {color: red}</style></main></body></html>"
)
READER = PageReader()


def content(html, reader=READER):
    return " ".join(reader.read(html)[1].split())


def test_one_item_per_page(spark):
    url = "https://www.example.com/test-page"
    pages = spark.createDataFrame([(1, url, PAGE)], "page_id long, url string, html string")
    (row,) = extract_pages(pages).collect()
    assert (row.title, row.url, row.content) == ("Test Page", url, "This is a test paragraph.")
    assert [r.asDict() for r in pages_to_items(pages).collect()] == [
        {"page_id": 1, "title": "Test Page", "url": url, "content": "This is a test paragraph."}
    ]


@pytest.mark.parametrize(
    "html, expected",
    [
        # Tags named like boilerplate are kept; only id and class count.
        ("<body><nav>a</nav><header>b</header><footer>c</footer></body>", "a b c"),
        ('<body><div class="Nav-Bar">a</div>b</body>', "b"),
        ("<body><div id=SIDEBAR>a<p>b</p></div>c</body>", "c"),
        # Substrings match: roads holds ads, unavailable holds nav.
        ('<body><p id="roads">a</p><p class="unavailable">b</p>c</body>', "c"),
        ('<body class="has-header"><p>a</p></body>', ""),
        ('<html class="schema"><body>a</body></html>', ""),
        ('<body><div class="structured-data">a</div></body>', "a"),
        ('<body><div class="structured-final_data">a</div></body>', ""),
        ('<body data-class="nav">a</body>', "a"),
        # Every text node is a word of its own.
        ("<body>a<b>b</b>c</body>", "a b c"),
        ("<body>a<!-- no -->b</body>", "a b"),
        ("<body><noscript>a</noscript><iframe>b</iframe>c</body>", "c"),
        ("<body>a<script>if (x < 1) { '</p>' }</script>b</body>", "a b"),
        ("<body>a<script>document.write('</style>')</script>b</body>", "a b"),
        ("<body>a<SCRIPT>x</Script >b</body>", "a b"),
        ("<body>a<script>never closed", "a"),
        ("<body>a<style>p{}</style>b", "a b"),
        # Broken markup.
        ('<body><div class="nav"><b>a</div>b</body>', "b"),
        ('<body><p class="nav">a<p>b</body>', "b"),
        ('<body><ul><li class="nav">a<li>b</ul></body>', "b"),
        ('<body><div class="nav">a</b></p>b</div>c</body>', "c"),
        ('<body><p>a<img class="nav" src=x>b</p></body>', "a b"),
        ("<body>a</body></html>b", "a b"),
        ("<body>a<div cla", "a"),
        ("<body>a<!-- cut", "a"),
        ("<body>a < b and c > d</body>", "a < b and c > d"),
        ('<body><a title="x > y">a</a></body>', "a"),
        ("<body><p it's>a</p><p>b's</p></body>", "a b's"),
        # A body is implied.
        ("<p>a</p>b", "a b"),
        ("<title>t</title>a", "a"),
        ("<html><head><title>t</title></head><p>a</p></html>", "a"),
        # Entities.
        ("<body>&lt;b&gt; &eacute; &#233; &amp;amp;</body>", "<b> é é &amp;"),
        ("", ""),
    ],
)
def test_visible_text(html, expected):
    assert content(html) == expected


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<title> a </title>", "a"),
        ("<TITLE lang=en>a</TITLE><title>b</title>", "a"),
        ("<title></title><title>b</title>", "b"),
        ("<title>a &amp; b</title>", "a & b"),
        ("<body>no title</body>", ""),
        ("<body><svg><title>in svg</title></svg></body>", "in svg"),
    ],
)
def test_title(html, expected):
    assert READER.read(html)[0] == expected


def test_options():
    html = '<body><nav>a</nav><div class="ad">b</div>c</body>'
    assert content(html, PageReader(exclude_keywords=("ad",))) == "a c"
    assert content(html, PageReader(exclude_keywords=())) == "a b c"
    assert content(html, PageReader(exclude_tags=("NAV",))) == "b c"


def test_links():
    html = (
        '<a href="/x">1</a><a href=" y?q=1#f ">2</a><area href="//h.org/z"><a href="/x">again</a>'
        '<a href="mailto:a@b.c">m</a><a href="javascript:void(0)">j</a><a>none</a>'
        "<a href='../up'>u</a><a href=''>self</a><a href='ftp://f/a'>f</a><link href='/css'>"
        "<!-- <a href='/hidden'> --><script>'<a href=\"/no\">'</script>"
    )
    found = [link["dst_url"] for link in page_links(html, "http://e.com/d/p.html")]
    assert found == [
        "http://e.com/x", "http://e.com/d/y?q=1#f", "http://h.org/z", "http://e.com/up",
        "http://e.com/d/p.html", "ftp://f/a",
    ]
    based = page_links('<base href="http://o.org/"><a href="x">', "http://e.com/")
    assert [link["dst_url"] for link in based] == ["http://o.org/x"]
    assert page_links('<a href="http://[bad">', "http://e.com/") == []


CLEAN = [
    ("a &amp; b", "a b"),
    ("a b c", "a b c"),
    ("<p>a</p><script>x</script><style>y</style>b", "a b"),
    ("&lt;b&gt;bold&lt;/b&gt;", "bold"),
    ("a < b", "a b"),
    ("10 > 5 and 3 < 4", "10 5 and 3 4"),
    ("×÷ œ «q» % : / \" & € é ’ ' - . , ; ! ? ( )", "×÷ q é ’ ' - . , ; ! ? ( )"),
    ("  a \n\t b  ", "a b"),
    ("under_score\x1fsep", "underscore sep"),
    ("日本", ""),
    ("", ""),
]


def test_clean_text(spark):
    rows = [(i, text) for i, (text, _) in enumerate(CLEAN)]
    df = spark.createDataFrame(rows, "i long, t string").coalesce(1)
    cleaned = df.select("i", clean_text(F.col("t")).alias("t"))
    want = [expected for _, expected in CLEAN]
    assert [row.t for row in cleaned.orderBy("i").collect()] == want
    again = cleaned.select("i", clean_text(F.col("t")).alias("t"))
    assert [row.t for row in again.orderBy("i").collect()] == want


def test_strip_markup_joins_text_nodes():
    assert strip_markup("a<b>b</b>c").split() == ["a", "b", "c"]
