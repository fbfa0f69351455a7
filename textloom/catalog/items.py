"""Extraction, cleaning, validation and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.catalog import fixtures, sql
from textloom.functions import text
from textloom.operators import extract
from textloom.plans.items import cleaned_items, pages_to_items
from textloom.session import work_path
from textloom.sinks.jsonl import write_enriched, write_failures, write_items
from textloom.sources.jsonl import (
    scan_documents,
    scan_failed_urls,
    scan_items,
    scan_processed_urls,
)
from textloom.sources.tables import read_documents, read_pages, read_table, spread

#: The test pages mark advertising with class="ad", which no default keyword hits.
AD_KEYWORDS = ("ad", "header")


def extract_title(spark, folder):
    return extract.extract_pages(read_pages(spark, folder)).select("page_id", "title")


def extract_content(spark, folder):
    return extract.extract_pages(read_pages(spark, folder)).select("page_id", "content")


def extract_content_excl(spark, folder):
    pages = extract.extract_pages(read_pages(spark, folder), AD_KEYWORDS)
    return pages.select("page_id", "content")


def clean_text_native(spark, folder):
    docs = read_documents(spark, folder)
    return docs.select("doc_id", text.clean_characters(F.col("content")).alias("cleaned"))


def clean_text(spark, folder):
    """Page source as the text to clean, so that entities and tags are there."""
    pages = read_pages(spark, folder)
    return pages.select("page_id", text.clean_text(F.col("html")).alias("cleaned"))


def items(spark, folder):
    return pages_to_items(read_pages(spark, folder)).select("title", "url", "content")


def valid_items(spark, folder):
    """Cleaned items held against the required fields, one rule at a time."""
    return extract.valid_items(cleaned_items(read_pages(spark, folder)))


def rejected_items(spark, folder):
    """A title of signs only is empty once cleaned; blank some more by language."""
    cleaned = cleaned_items(read_pages(spark, folder))
    blanked = cleaned.withColumns(
        {
            "title": F.when(F.col("url").contains("/de/"), "").otherwise(F.col("title")),
            "content": F.when(F.col("url").contains("/fr/"), "").otherwise(F.col("content")),
        }
    )
    return extract.rejected_items(blanked)


def keyword_clean(spark, folder):
    docs = read_documents(spark, folder)
    return docs.select("doc_id", text.keyword_clean(F.col("content")).alias("cleaned"))


def snippet(spark, folder):
    docs = read_documents(spark, folder)
    return docs.select("doc_id", text.snippet(F.col("content")).alias("snippet"))


def normalize_title(spark, folder):
    found = extract.extract_pages(read_pages(spark, folder))
    page = F.col("page_id").cast("string")
    paged = F.concat("title", F.lit(" - Page "), page, F.lit(" -PAGE"), page, F.lit(" end"))
    return found.select("page_id", text.normalize_title(paged).alias("norm_title"))


def result_defaults(spark, folder):
    """Documents with fields taken away by language and source."""
    from textloom.operators.search import fill_defaults

    docs = spread(read_table(spark, folder, "documents"))
    lang = F.col("lang")
    holes = docs.select(
        "doc_id",
        F.when(lang != "de", lang).alias("title"),
        F.when(F.col("source") != "src0", F.col("source")).alias("url"),
        F.when(lang != "fr", F.array("lang", "source")).alias("keywords"),
        F.when(lang != "es", F.col("text")).alias("content"),
    )
    filled = fill_defaults(holes)
    return filled.withColumn("keywords", F.array_join("keywords", ","))


def processed_urls(spark, folder):
    """Items written as JSON lines, then scanned for the URLs they hold."""
    path = write_items(
        fixtures.items(spark, folder),
        {"type": "local", "directory_path": work_path(spark, "processed")},
    )
    return scan_processed_urls(spark, path)


def scan_items_jsonl(spark, folder):
    """Items written as JSON lines and read back tolerantly."""
    path = write_items(
        fixtures.items(spark, folder),
        {"type": "local", "directory_path": work_path(spark, "scanned")},
    )
    return scan_items(spark, path).select("title", "url", "content")


def items_once(spark, folder):
    """Every page twice, the second time under a larger id: one item each."""
    pages = read_pages(spark, folder)
    again = pages.withColumn("page_id", F.col("page_id") + 1_000_000)
    return pages_to_items(pages.unionByName(again))


def repeated_pages(pages):
    """``pages``, and rows that repeat their ids and URLs: every row twice; another URL
    under the same id; and, of every fifth page, a blank page of its URL before it."""
    other = pages.withColumn("url", F.concat("url", F.lit("/b")))
    blank = pages.where("page_id % 5 = 0").withColumns(
        {"page_id": F.col("page_id") - 1_000_000, "html": F.lit("<p> </p>")}
    )
    return pages.unionByName(pages).unionByName(other).unionByName(blank)


def items_first_of_url(spark, folder):
    """A URL's first row decides: none of a blank one; ids need not be unique."""
    return pages_to_items(repeated_pages(read_pages(spark, folder)))


def items_by_pattern(spark, folder):
    """Two JSON-lines folders, read by one pattern of names."""
    root = work_path(spark, "by-pattern")
    found = pages_to_items(read_pages(spark, folder))
    write_items(found.where("page_id % 2 = 0"), {"type": "local", "directory_path": f"{root}/even"})
    write_items(found.where("page_id % 2 = 1"), {"type": "local", "directory_path": f"{root}/odd"})
    return scan_items(spark, f"{root}/*/*.jsonl").select("title", "url", "content")


def _hard_lines(spark, folder):
    """Ten lines a page, as a folder of text files."""
    url = F.concat(F.lit("http://e/"), F.col("page_id").cast("string"))
    long = F.concat(F.repeat(F.lit("x"), 30), F.lit(" end"))
    line = lambda form, *parts: F.format_string(form, *parts)
    lines = F.array(
        line('{"title": "t", "url": "%s/a", "content": "c", "keywords": ["k", "l"]}', url),
        line('{"title": "t", "url": "%s/b", "content": "c", "keywords": "k"}', url),
        line('{"title": "old", "url": "%s/c", "content": "c", "title": "new"}', url),
        line('{"title": "t", "url": "%s/d", "content": null}', url),
        line('{"title": "t", "url": "%s/e"}', url),
        line('{"url": "%s/f", "content": "%s"}', url, long),
        line("{bad %s", url), line("[%s]", F.col("page_id")), F.lit(""), F.lit("null"),
    )
    path = work_path(spark, "hard-lines")
    rows = read_table(spark, folder, "pages").select("page_id", F.explode(lines).alias("value"))
    rows.select("value").write.text(path)
    return path


def scan_hard_lines(spark, folder):
    found = scan_items(spark, _hard_lines(spark, folder))
    return found.withColumn("keywords", F.array_join("keywords", ","))


def documents_scan(spark, folder):
    found = scan_documents(spark, _hard_lines(spark, folder))
    return found.withColumn("keywords", F.array_join("keywords", ","))


def failed_scan(spark, folder):
    """Failures written to the sink, repeated, and read back once each."""
    config = {"type": "local", "directory_path": work_path(spark, "failed")}
    failed = fixtures.failed_pages(spark, folder)
    return scan_failed_urls(spark, write_failures(failed.unionByName(failed), config))


def enriched_round_trip(spark, folder):
    """Items with a keyword, written as enriched documents and read back."""
    items = fixtures.items(spark, folder).withColumn("keywords", F.array(F.substring("title", 1, 3)))
    path = write_enriched(items, work_path(spark, "enriched"))
    return scan_documents(spark, path).withColumn("keywords", F.array_join("keywords", ","))


def record_kinds(spark, folder):
    """Pages as items, fetch failures as the other kind, split and counted by URL."""
    pages = read_table(spark, folder, "pages").select("url", F.lit("item").alias("kind"))
    failed = fixtures.failed_pages(spark, folder).select(F.col("failed_url").alias("url"), F.lit(None).alias("kind"))
    items, others = extract.split_kinds(pages.unionByName(failed))
    both = items.withColumn("is_item", F.lit(True)).unionByName(others.withColumn("is_item", F.lit(False)))
    return both.groupBy("url", "is_item").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "extract_title": extract_title,
    "extract_content": extract_content,
    "extract_content_excl": extract_content_excl,
    "clean_text_native": clean_text_native,
    "clean_text": clean_text,
    "pages_to_items": items,
    "valid_items": valid_items,
    "rejected_items": rejected_items,
    "keyword_clean": keyword_clean,
    "snippet": snippet,
    "normalize_title": normalize_title,
    "result_defaults": result_defaults,
    "processed_urls": processed_urls,
    "scan_items_jsonl": scan_items_jsonl,
    "items_once": items_once,
    "items_first_of_url": items_first_of_url,
    "items_by_pattern": items_by_pattern,
    "scan_hard_lines": scan_hard_lines,
    "documents_scan": documents_scan,
    "failed_scan": failed_scan,
    "enriched_round_trip": enriched_round_trip,
    "record_kinds": record_kinds,
}

_TAGLESS = (
    "array_to_string(list_transform(list_filter(string_split_regex("
    "regexp_replace(regexp_replace({0}, '(?is)<script[^>]*>.*?(</script[^>]*>|$)"
    "|<style[^>]*>.*?(</style[^>]*>|$)', '<x>', 'g'), '(?s)<!--.*?(-->|$)', '<x>', 'g'),"
    " '<[^>]*(>|$)'), lambda n: n <> ''), lambda n: {1}), ' ')"
)


def oracles() -> dict[str, str]:
    decoded_page = sql.decoded("html")
    return {
        "extract_title": f"SELECT page_id, {sql.title_of('html')} AS title FROM pages",
        "extract_content": f"SELECT page_id, {sql.content_of('html')} AS content FROM pages",
        "extract_content_excl": (
            "SELECT page_id, "
            + sql.content_of("html", '(?is)<div class="ad">.*?(</div>|$)')
            + " AS content FROM pages"
        ),
        "clean_text_native": (
            f"SELECT doc_id, {sql.cleaned('text')} AS cleaned FROM documents"
        ),
        "clean_text": (
            f"SELECT page_id, {sql.cleaned(_TAGLESS.format(decoded_page, 'n'))} AS cleaned "
            "FROM pages"
        ),
        "pages_to_items": f"WITH {sql.ITEMS} SELECT title, url, content FROM items",
        "valid_items": (
            f"WITH {sql.ITEMS} SELECT doc_id AS page_id, title, url, content FROM items"
        ),
        "rejected_items": f"""WITH {sql.ITEMS},
            blanked AS (SELECT page_id, url,
              CASE WHEN contains(url, '/de/') THEN '' ELSE title END AS title,
              CASE WHEN contains(url, '/fr/') THEN '' ELSE content END AS content
              FROM clean_items)
            SELECT page_id, url, title <> '' AS has_title, url <> '' AS has_url,
              content <> '' AS has_content
            FROM blanked WHERE title = '' OR url = '' OR content = ''""",
        "keyword_clean": (
            f"SELECT doc_id, {sql.keyword_cleaned('text')} AS cleaned FROM documents"
        ),
        "snippet": "SELECT doc_id, substring(text, 1, 200) || '...' AS snippet FROM documents",
        "normalize_title": rf"""SELECT page_id, regexp_replace(
              {sql.title_of('html')} || ' - Page ' || page_id || ' -PAGE' || page_id || ' end',
              '(?i)[{sql.SPACE}]*-[{sql.SPACE}]*Page[{sql.SPACE}]*\d+', '', 'g') AS norm_title
            FROM pages""",
        "result_defaults": """SELECT doc_id,
              CASE WHEN lang <> 'de' THEN lang ELSE 'No Title' END AS title,
              CASE WHEN source <> 'src0' THEN source ELSE '#' END AS url,
              CASE WHEN lang <> 'fr' THEN lang || ',' || source ELSE '' END AS keywords,
              CASE WHEN lang <> 'es' THEN text ELSE 'No Content' END AS content
            FROM documents""",
        "processed_urls": f"WITH {sql.ITEMS} SELECT DISTINCT url FROM items",
        "items_once": f"WITH {sql.ITEMS} SELECT doc_id AS page_id, title, url, content FROM items",
        "items_first_of_url": f"""WITH {sql.ITEMS}
            SELECT doc_id AS page_id, title, url, content FROM items WHERE doc_id % 5 <> 0
            UNION ALL SELECT doc_id AS page_id, title, url || '/b' AS url, content FROM items""",
        "items_by_pattern": f"WITH {sql.ITEMS} SELECT title, url, content FROM items",
        "scan_hard_lines": """
            SELECT title, CASE WHEN name = '' THEN '' ELSE 'http://e/' || page_id || name END AS url,
              content, keywords
            FROM pages, (VALUES ('t', '/a', 'c', 'k,l'), ('t', '/b', 'c', 'k'), ('new', '/c', 'c', ''),
              ('', '', '', ''), ('t', '/e', '', ''), ('', '/f', repeat('x', 30) || ' end', ''),
              ('', '', '', ''), ('', '', '', '')) AS h(title, name, content, keywords)""",
        "documents_scan": """
            SELECT title, 'http://e/' || page_id || name AS url, content, keywords
            FROM pages, (VALUES ('t', '/a', 'c', 'k,l'), ('t', '/b', 'c', 'k'), ('new', '/c', 'c', NULL),
              ('t', '/d', NULL, NULL), ('t', '/e', NULL, NULL),
              (NULL, '/f', repeat('x', 30) || ' end', NULL)) AS h(title, name, content, keywords)""",
        "failed_scan": f"WITH {sql.VISITED} SELECT DISTINCT failed_url, error_code FROM failed",
        "enriched_round_trip": f"""WITH {sql.ITEMS}
            SELECT title, url, substring(title, 1, 3) AS keywords, content FROM items""",
        "record_kinds": f"""WITH {sql.VISITED}
            SELECT url, true AS is_item, count(*) AS n FROM pages GROUP BY url
            UNION ALL SELECT failed_url, false, count(*) FROM failed GROUP BY failed_url""",
        "scan_items_jsonl": f"WITH {sql.ITEMS} SELECT title, url, content FROM items",
    }
