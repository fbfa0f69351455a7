"""Links, URL admission, frontier and fetch failures."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.catalog import fixtures, sql
from textloom.functions import urls as U
from textloom.operators import failures as O
from textloom.operators import links as L
from textloom.operators.frontier import crawl_frontier as walk
from textloom.plans.crawl import crawl_step as step
from textloom.sources.tables import read_pages, read_table

DOMAINS = ("example.com", "spam-farm.example.org")
SCRIPT_HOSTS = (
    "Bücher.de", "xn--bcher-kva.de", "www.例え.テスト:8080", "пример.рф", "ü" * 70 + ".de",
)


def _urls(spark, folder):
    return read_table(spark, folder, "pages").select("page_id", "url")


def extract_links(spark, folder):
    links = L.extract_links(read_pages(spark, folder))
    return links.select("page_id", F.col("pos").cast("long").alias("pos"), "href", "dst_url")


def link_targets(spark, folder):
    links = L.extract_links(read_pages(spark, folder))
    return links.groupBy("dst_canonical").agg(F.count(F.lit(1)).alias("n_links"))


def canonical_url(spark, folder):
    """Page URLs, also with an upper-case host, a shuffled query and a fragment."""
    pages = _urls(spark, folder)
    bare = F.regexp_replace("url", "#.*$", "")
    more = F.concat(
        bare, F.when(bare.contains("?"), "&").otherwise("?"), F.lit("z=1&a=2&page=1&b#frag")
    )
    # Escapes of Latin-1 bytes, which are no UTF-8, and an empty port.
    latin = F.concat(
        F.lit("HTTP://e.com:/caf%e9/"), F.col("page_id").cast("string"), F.lit("/%E8?q=%e8&a=1#x")
    )
    return pages.select(
        "page_id",
        U.canonical_url(F.col("url")).alias("canonical"),
        U.canonical_url(more).alias("canonical_more"),
        U.canonical_url(latin).alias("canonical_latin"),
    )


def canonical_hosts(spark, folder):
    """Pages under hosts of other scripts; the last has no ASCII form and stays."""
    pages = _urls(spark, folder)
    hosts = F.array(*[F.lit(h) for h in SCRIPT_HOSTS])
    at = (F.col("page_id") % len(SCRIPT_HOSTS) + 1).cast("int")
    path = F.regexp_replace("url", r"^[a-z]+://[^/?#]+/?|[?#].*$", "")
    url = F.concat(F.lit("HTTP://"), F.element_at(hosts, at), F.lit("/"), path)
    return pages.select("page_id", U.canonical_url(url).alias("canonical"))


def url_admission(spark, folder):
    links = fixtures.candidate_links(spark, folder)
    return links.select("page_id", "link", U.admitted(F.col("link")).alias("admitted"))


def allowed_domains(spark, folder):
    return _urls(spark, folder).where(U.in_domains(F.col("url"), DOMAINS))


def allowed_domain_table(spark, folder):
    """The same with a table of domains: those of the list and 20,000 others."""
    others = spark.range(20_000).select(F.format_string("d%d.example.net", "id").alias("domain"))
    listed = spark.createDataFrame([(d,) for d in DOMAINS], "domain string")
    return L.within_domains(_urls(spark, folder), listed.unionByName(others))


def robots_admission(spark, folder):
    return L.robots_admission(
        _urls(spark, folder), fixtures.robots_rules(spark, folder), "page_id"
    )


def frontier_unprocessed(spark, folder):
    return L.unseen(_urls(spark, folder), fixtures.processed_pages(spark, folder)).select(
        "page_id", "url"
    )


def frontier_not_failed(spark, folder):
    failed = fixtures.failed_pages(spark, folder)
    kept = L.unseen(_urls(spark, folder), failed, seen_key="failed_url")
    return kept.select("page_id", "url")


def seen_urls(spark, folder):
    return L.seen_urls(
        fixtures.processed_pages(spark, folder), fixtures.failed_pages(spark, folder)
    )


def first_seen_url(spark, folder):
    log = fixtures.fetch_log(spark, folder).select("url", "ts", "fetch_id")
    return L.first_seen(log, "url", F.col("ts"), F.col("fetch_id")).select("url", "fetch_id")


def crawl_frontier(spark, folder):
    """From the first page of each top-level domain along the derived links."""
    domain = F.regexp_extract(U.host(F.col("url")), r"([^.]+)$", 1)
    starts = (
        _urls(spark, folder)
        .groupBy(domain.alias("domain"))
        .agg(F.min("page_id").alias("url"))
        .select("url")
    )
    reached = walk(starts, fixtures.edges(spark, folder))
    return reached.select(F.col("url").alias("page_id"), F.col("depth").cast("long").alias("depth"))


def crawl_step(spark, folder):
    """Links of all pages that are still to be fetched."""
    found = step(
        read_pages(spark, folder), fixtures.robots_rules(spark, folder),
        fixtures.processed_pages(spark, folder), fixtures.failed_pages(spark, folder),
    )
    return found.select("url", "canonical", F.col("depth").cast("long").alias("depth"))


def classify_status(spark, folder):
    log = fixtures.fetch_log(spark, folder).where(F.col("status").isNotNull())
    return log.select("fetch_id", O.classify_status(F.col("status")).alias("outcome"))


def classify_exception(spark, folder):
    log = fixtures.fetch_log(spark, folder).where(F.col("exception").isNotNull())
    return log.select("fetch_id", O.classify_exception(F.col("exception")).alias("outcome"))


def retry_exhausted(spark, folder):
    return O.retry_exhausted(fixtures.fetch_log(spark, folder))


def failed_urls(spark, folder):
    return O.failed_urls(fixtures.fetch_log(spark, folder))


def fetch_stats(spark, folder):
    return O.fetch_stats(fixtures.fetch_log(spark, folder))


QUERIES = {
    "extract_links": extract_links,
    "link_targets": link_targets,
    "canonical_url": canonical_url,
    "canonical_hosts": canonical_hosts,
    "url_admission": url_admission,
    "allowed_domains": allowed_domains,
    "allowed_domain_table": allowed_domain_table,
    "robots_admission": robots_admission,
    "frontier_unprocessed": frontier_unprocessed,
    "frontier_not_failed": frontier_not_failed,
    "seen_urls": seen_urls,
    "first_seen_url": first_seen_url,
    "crawl_frontier": crawl_frontier,
    "crawl_step": crawl_step,
    "classify_status": classify_status,
    "classify_exception": classify_exception,
    "retry_exhausted": retry_exhausted,
    "failed_urls": failed_urls,
    "fetch_stats": fetch_stats,
}

_LINKS = """
hrefs AS (
  SELECT page_id, url, unnest(h) AS href, unnest(range(len(h))) AS spot
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a\\s+href="([^"]*)"', 1) AS h
        FROM pages) p),
first_links AS (
  SELECT page_id, href, min(spot) AS spot, any_value(url) AS url FROM hrefs GROUP BY page_id, href),
links AS (
  SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY spot) - 1 AS pos, href,
    regexp_extract(url, '^[a-z]+://[^/]+', 0) || href AS dst_url
  FROM first_links)"""


def _canonical(url: str) -> str:
    query = rf"regexp_extract({url}, '\?([^#]*)', 1)"
    return rf"""regexp_extract({url}, '^[^?#]*', 0) || CASE WHEN {query} <> '' THEN '?' ||
      array_to_string(list_transform(list_sort(string_split({query}, '&')),
        lambda a: CASE WHEN contains(a, '=') THEN a ELSE a || '=' END), '&') ELSE '' END"""


def oracles() -> dict[str, str]:
    log = f"WITH {sql.FETCH_LOG}"
    more = (
        "regexp_replace(url, '#.*$', '') || CASE WHEN contains(regexp_replace(url, '#.*$', ''),"
        " '?') THEN '&' ELSE '?' END || 'z=1&a=2&page=1&b#frag'"
    )
    host = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"
    rules = (
        "(VALUES (false, '/de/', '^/de/'), (true, '/de/1', '^/de/1'), (false, '/en/2', '^/en/2'),"
        " (true, '/en/2', '^/en/2'), (false, '/*?page=', '^/.*\\?page='),"
        " (false, '/fr/*.html$', '^/fr/.*\\.html$'), (true, '/fr/9', '^/fr/9'))"
        " AS r(allow, pattern, regex)"
    )
    return {
        "extract_links": f"WITH {_LINKS} SELECT page_id, pos, href, dst_url FROM links",
        "link_targets": f"""WITH {_LINKS},
            named AS (SELECT regexp_extract(dst_url, '^[a-z]+://[^/]+', 0)
              || replace(replace(url_encode(regexp_extract(dst_url, '^[a-z]+://[^/]+(.*)$', 1)),
                   '%2F', '/'), '%2C', ',') AS dst_canonical FROM links)
            SELECT dst_canonical, count(*) AS n_links FROM named GROUP BY dst_canonical""",
        "canonical_url": (
            f"SELECT page_id, {_canonical('url')} AS canonical, "
            f"{_canonical('more')} AS canonical_more, "
            "'http://e.com/caf%E9/' || page_id || '/%E8?a=1&q=%E8' AS canonical_latin "
            f"FROM (SELECT page_id, url, {more} AS more FROM pages) p"
        ),
        "canonical_hosts": r"""
            SELECT page_id, 'http://' || (['xn--bcher-kva.de', 'xn--bcher-kva.de',
                'www.xn--r8jz45g.xn--zckzah:8080', 'xn--e1afmkfd.xn--p1ai', repeat('ü', 70) || '.de']
              )[CAST(page_id % 5 + 1 AS INTEGER)] || '/'
              || regexp_replace(url, '^[a-z]+://[^/?#]+/?|[?#].*$', '', 'g') AS canonical
            FROM pages""",
        "url_admission": r"""
            WITH links AS (SELECT page_id, unnest([url] || list_transform(
                ['/robots.txt', '/robots.txt?x=1', '/sitemap.xml', '/sfuser/me', '/connexion',
                 '/inscription', '/mentions-legales', '/aide', '/faq', '/faq/more',
                 '/infolettres', '/report.PDF', '/photo.jpg', '/a.zip?b=c', '/notes.txt#top'],
                lambda o: regexp_extract(url, '^[a-z]+://[^/]+', 0) || o)) AS link FROM pages)
            SELECT page_id, link, NOT contains(link, 'robots.txt') AND length(link) <= 2083
              AND NOT regexp_matches(link, '/robots\.txt$|/sitemap\.xml$|/sfuser/.*|/connexion$'
                || '|/inscription$|/mentions-legales$|/aide$|/faq$|/infolettres$')
              AND NOT regexp_matches(lower(regexp_extract(link, '^[a-z]+://[^/?#]+([^?#]*)', 1)),
                '\.(txt|xml|pdf|zip)$') AS admitted
            FROM links""",
        "allowed_domains": f"""SELECT page_id, url FROM pages
            WHERE {host} IN ('example.com', 'spam-farm.example.org')
              OR {host} LIKE '%.example.com' OR {host} LIKE '%.spam-farm.example.org'""",
        "allowed_domain_table": f"""SELECT page_id, url FROM pages
            WHERE {host} IN ('example.com', 'spam-farm.example.org')
              OR {host} LIKE '%.example.com' OR {host} LIKE '%.spam-farm.example.org'""",
        "robots_admission": rf"""
            WITH paths AS (SELECT page_id, url,
              regexp_extract(url, '^[a-z]+://[^/?#]+([^#]*)', 1) AS path FROM pages),
            hits AS (SELECT page_id, allow, row_number() OVER (
                PARTITION BY page_id ORDER BY length(pattern) DESC, allow DESC) AS n
              FROM paths JOIN {rules} ON regexp_matches(path, regex))
            SELECT page_id, url FROM pages
            WHERE page_id NOT IN (SELECT page_id FROM hits WHERE n = 1 AND NOT allow)""",
        "frontier_unprocessed": (
            f"WITH {sql.VISITED} SELECT page_id, url FROM pages "
            "WHERE url NOT IN (SELECT url FROM processed)"
        ),
        "frontier_not_failed": (
            f"WITH {sql.VISITED} SELECT page_id, url FROM pages "
            "WHERE url NOT IN (SELECT failed_url FROM failed)"
        ),
        "seen_urls": (
            f"WITH {sql.VISITED} SELECT url FROM processed UNION SELECT failed_url FROM failed"
        ),
        "first_seen_url": (
            f"{log} SELECT url, min(fetch_id) AS fetch_id FROM log GROUP BY url"
        ),
        "crawl_frontier": rf"""
            WITH RECURSIVE n AS (SELECT count(*) AS n FROM pages),
            edges AS (SELECT page_id AS src,
                unnest([(page_id * 7 + 3) % n, (page_id * 3 + 1) % n, page_id // 2]) AS dst
              FROM pages, n),
            walk AS (
              SELECT page_id, 0 AS depth FROM (
                SELECT min(page_id) AS page_id FROM pages
                GROUP BY regexp_extract({host}, '([^.]+)$', 1)) s
              UNION
              SELECT dst, depth + 1 FROM walk JOIN edges ON page_id = src WHERE depth < 40)
            SELECT page_id, CAST(min(depth) AS BIGINT) AS depth FROM walk GROUP BY page_id""",
        "crawl_step": rf"""
            WITH {_LINKS},
            {sql.VISITED},
            named AS (SELECT *, regexp_extract(dst_url, '^[a-z]+://[^/]+', 0)
              || replace(replace(url_encode(regexp_extract(dst_url, '^[a-z]+://[^/]+(.*)$', 1)),
                   '%2F', '/'), '%2C', ',') AS canonical FROM links
              WHERE NOT contains(dst_url, 'robots.txt') AND NOT regexp_matches(dst_url,
                '/sitemap\.xml$|/sfuser/.*|/connexion$|/inscription$|/mentions-legales$|/aide$|/faq$|/infolettres$')
              AND NOT regexp_matches(lower(dst_url), '\.(txt|xml|pdf|zip)$')),
            once AS (SELECT *, row_number() OVER (PARTITION BY canonical ORDER BY page_id, pos) AS nth
              FROM named),
            new AS (SELECT dst_url AS url, canonical,
                regexp_extract(dst_url, '^[a-z]+://[^/?#]+([^#]*)', 1) AS path
              FROM once WHERE nth = 1 AND dst_url NOT IN (SELECT url FROM processed)
                AND dst_url NOT IN (SELECT failed_url FROM failed)),
            hits AS (SELECT canonical, allow, row_number() OVER (
                PARTITION BY canonical ORDER BY length(pattern) DESC, allow DESC) AS n
              FROM new JOIN {rules} ON regexp_matches(path, regex))
            SELECT url, canonical, 1::BIGINT AS depth FROM new
            WHERE canonical NOT IN (SELECT canonical FROM hits WHERE n = 1 AND NOT allow)""",
        "classify_status": f"{log} SELECT fetch_id, outcome FROM classed WHERE exception IS NULL",
        "classify_exception": (
            f"{log} SELECT fetch_id, outcome FROM classed WHERE exception IS NOT NULL"
        ),
        "retry_exhausted": f"{log} SELECT failed_url, error_code FROM exhausted",
        "failed_urls": f"{log} SELECT * FROM at_once UNION SELECT * FROM exhausted",
        "fetch_stats": (
            f"{log} SELECT status, exception, count(*) AS n FROM log GROUP BY status, exception"
        ),
    }
