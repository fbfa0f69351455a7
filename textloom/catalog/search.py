"""Analysis, postings, scoring and ranked search."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.catalog import fixtures, sql
from textloom.catalog.keywords import JOINED
from textloom.functions import fixed
from textloom.functions.analysis import analyze
from textloom.functions.urls import host
from textloom.operators import postings as P
from textloom.operators import search as S
from textloom.plans.index import create_index, open_index, postings_of, refresh_index
from textloom.plans.search import best_documents, count_hits, search as run_search
from textloom.session import stash, work_path
from textloom.sources.tables import read_documents, read_pages

#: A query in the invented prose of the test tables, with a repeated word.
QUERY = "the thion une elle the Nicht"


def analyze_text(spark, folder):
    docs = read_documents(spark, folder)
    return docs.select("doc_id", F.array_join(analyze(F.col("content")), " ").alias("terms"))


def _analyzed(spark, folder):
    return P.analyze_documents(read_documents(spark, folder))


def build_postings(spark, folder):
    return P.build_postings(_analyzed(spark, folder))


def bm25_stats(spark, folder):
    stats = P.field_stats(P.analyze_documents(fixtures.index(spark, folder).docs))
    return stats.withColumn("avgdl", F.round("avgdl", 6))


def term_stats(spark, folder):
    return P.term_stats(P.build_postings(_analyzed(spark, folder)))


def search_bm25(spark, folder):
    """One text field, straight from the documents, without an index. One pass over
    the texts leaves lengths and the counts of the query terms."""
    terms = S.query_terms(spark, QUERY)
    analyzed = stash(P.analyze_documents(read_documents(spark, folder), terms), "scanned")
    scores = S.field_scores(P.build_postings(analyzed), P.field_stats(analyzed), terms, QUERY)
    return scores.select("doc_id", F.round("content", 6).alias("score"))


def _field_scores(spark, folder, query):
    index = fixtures.index(spark, folder)
    terms = S.query_terms(spark, query)
    postings, frequencies, _ = postings_of(index, sorted({*terms, query}))
    return S.field_scores(postings, index.stats, terms, query, frequencies)


def search_keywords(spark, folder):
    scores = _field_scores(spark, folder, _common_keyword(spark, folder))
    found = scores.where(F.col("keywords").isNotNull())
    return found.select("doc_id", F.round("keywords", 6).alias("score"))


def _common_keyword(spark, folder) -> str:
    """The keyword most documents have: the first of them by name."""
    docs = fixtures.index(spark, folder).docs
    counts = docs.select(F.explode_outer("keywords").alias("k")).where("k IS NOT NULL")
    best = counts.groupBy("k").count().orderBy(F.col("count").desc(), "k").first()
    return best["k"]


def search_best_fields(spark, folder):
    scores = S.best_field(_field_scores(spark, folder, QUERY))
    return scores.select("doc_id", F.round("score", 6).alias("score"))


def search_page(spark, folder):
    """The second page, of the best documents by block."""
    best = best_documents(fixtures.index(spark, folder), QUERY, 20)
    page = S.result_page(best.hits, 2, 10)
    return page.select(
        F.col("rank").cast("long").alias("rank"), "doc_id", F.round("score", 6).alias("score")
    )


def search_dedup_titles(spark, folder):
    """All pages as one result page; pages of a host share a title but its number."""
    pages = read_pages(spark, folder)
    number = F.col("page_id").cast("string")
    results = pages.select(
        F.col("page_id").alias("rank"),
        F.concat(host(F.col("url")), F.lit(" - Page "), number).alias("title"),
        "url",
    )
    return S.dedup_titles(results)


def search_full_ranking(spark, folder):
    """The best documents where more are asked for than there are: every hit, in order."""
    index = fixtures.index(spark, folder)
    n = count_hits(index, QUERY) + 1
    page = S.result_page(best_documents(index, QUERY, n).hits, 1, n)
    return page.select(
        F.col("rank").cast("long").alias("rank"), "doc_id", F.round("score", 6).alias("score")
    )


def empty_query(spark, folder):
    """A blank request is refused with a message; another one is counted."""
    index, rows = fixtures.index(spark, folder), []
    for request, query in (("blank", " \t "), ("words", f" {QUERY} ")):
        try:
            rows.append((request, None, count_hits(index, S.check_request(query, 1, 10))))
        except ValueError as refused:
            rows.append((request, str(refused), None))
    return spark.createDataFrame(rows, "request string, error string, total long")


def index_precondition(spark, folder):
    """Items are not indexed where no index was created, and are once there is one."""
    root = work_path(spark, "not-created")
    rows = fixtures.items(spark, folder).withColumn("keywords", F.array())
    without = refresh_index(rows, root) is not None
    create_index(spark, root)
    done = refresh_index(rows, root)
    return spark.createDataFrame(
        [(without, done.deleted, done.indexed)], "refreshed_without boolean, deleted long, indexed long"
    )


def search_total(spark, folder):
    index = fixtures.index(spark, folder)
    counted = spark.createDataFrame([(count_hits(index, QUERY),)], "total long")
    found = S.totals_of(counted, 1, 10)
    return found.select("total", "total_pages")


def search(spark, folder):
    results, _ = run_search(fixtures.index(spark, folder), f"  {QUERY} ", page=1, size=10)
    return results.select(
        F.col("rank").cast("long").alias("rank"), "doc_id", "title", "url",
        F.array_join("keywords", ",").alias("keywords"), "content",
    )


def lookup_url(spark, folder):
    """Stored documents under the alphabetically first URL."""
    docs = fixtures.index(spark, folder).docs
    first = docs.agg(F.min("url").alias("url")).first()["url"]
    return S.lookup_url(docs, first).select("doc_id", "title", "url")


def index_count(spark, folder):
    """A full refresh of a new index, then its document count."""
    root = work_path(spark, "counted-index")
    create_index(spark, root)
    refresh_index(fixtures.items(spark, folder).withColumn("keywords", F.array()), root)
    return open_index(spark, root).docs.agg(F.count(F.lit(1)).alias("n"))


def empty_index_search(spark, folder):
    """Totals of a search in a new index, and in one refreshed to no documents."""
    root = work_path(spark, "empty-index")
    create_index(spark, root)
    _, new = run_search(open_index(spark, root), QUERY)
    none = fixtures.items(spark, folder).where(F.col("title").isNull())
    refresh_index(none.withColumn("keywords", F.array()), root)
    found, emptied = run_search(open_index(spark, root), QUERY)
    counts = found.agg(F.count(F.lit(1)).alias("n_results"))
    return new.union(emptied).join(counts).select("total", "total_pages", "n_results")


QUERIES = {
    "analyze_text": analyze_text,
    "build_postings": build_postings,
    "term_stats": term_stats,
    "bm25_stats": bm25_stats,
    "search_bm25": search_bm25,
    "search_keywords": search_keywords,
    "search_best_fields": search_best_fields,
    "search_page": search_page,
    "search_full_ranking": search_full_ranking,
    "empty_query": empty_query,
    "index_precondition": index_precondition,
    "search_dedup_titles": search_dedup_titles,
    "search_total": search_total,
    "search": search,
    "lookup_url": lookup_url,
    "index_count": index_count,
    "empty_index_search": empty_index_search,
}


def _postings(source: str, fields: list[str]) -> str:
    parts = []
    for field in fields:
        if field == "keywords":
            parts.append(
                "SELECT doc_id, 'keywords' AS field, term, 1 AS tf, 1 AS dl FROM ranked"
            )
            continue
        parts.append(
            f"SELECT doc_id, '{field}' AS field, term, count(*) AS tf, any_value(dl) AS dl FROM "
            f"(SELECT doc_id, len(w) AS dl, unnest(w) AS term FROM "
            f"(SELECT doc_id, {sql.analyzed(field)} AS w FROM {source}) q) r GROUP BY doc_id, term"
        )
    return f"postings AS ({' UNION ALL '.join(parts)})"


_STATS = """
lengths AS (
  SELECT doc_id, field, CASE WHEN field = 'keywords' THEN count(*) ELSE any_value(dl) END AS dl
  FROM postings GROUP BY doc_id, field),
stats AS (SELECT field, count(*) AS n_docs, sum(dl) / count(*) AS avgdl
  FROM lengths GROUP BY field)"""

_SCORED = """
dfs AS (SELECT field, term, count(*) AS df FROM postings GROUP BY field, term),
wanted AS (
  SELECT term, count(*) AS times
  FROM (SELECT unnest({analyzed_query}) AS term) q GROUP BY term),
scores AS (
  SELECT p.doc_id, p.field,
    sum(coalesce(w.times, 1) * ln(1.0 + (n_docs - df + 0.5) / (df + 0.5)) * 2.2 * p.tf
      / (p.tf + 1.2 * (0.25 + 0.75 * p.dl / avgdl))) AS score
  FROM postings p JOIN dfs USING (field, term) JOIN stats USING (field)
    LEFT JOIN wanted w ON p.term = w.term AND p.field <> 'keywords'
  WHERE w.term IS NOT NULL OR (p.field = 'keywords' AND p.term = {keyword})
  GROUP BY p.doc_id, p.field),
best AS (SELECT doc_id, round(max(score), 9) AS score FROM scores GROUP BY doc_id),
placed AS (
  SELECT doc_id, score, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM best)"""


def oracles() -> dict[str, str]:
    query = f"'{QUERY}'"
    scored = _SCORED.format(analyzed_query=sql.analyzed(query), keyword=query)
    by_keyword = _SCORED.format(
        analyzed_query="[]::VARCHAR[]",
        keyword=(
            "(SELECT term FROM ranked GROUP BY term ORDER BY count(*) DESC, term LIMIT 1)"
        ),
    )
    one_field = f"WITH {sql.DOCS}, {_postings('docs', ['content'])}, {_STATS}"
    item_keywords = f"WITH {sql.ITEMS}, {sql.keywords_cte('items')}"
    indexed = (
        f"{item_keywords}, {_postings('items', ['title', 'keywords', 'content'])}, {_STATS}"
    )
    return {
        "analyze_text": (
            f"SELECT doc_id, array_to_string({sql.analyzed('text')}, ' ') AS terms FROM documents"
        ),
        "build_postings": f"{one_field} SELECT doc_id, field, term, tf, dl FROM postings",
        "term_stats": (
            f"{one_field} SELECT field, term, count(*) AS df FROM postings GROUP BY field, term"
        ),
        "bm25_stats": f"{indexed} SELECT field, n_docs, round(avgdl, 6) AS avgdl FROM stats",
        "search_bm25": (
            f"{one_field}, {scored} SELECT doc_id, round(score, 6) AS score FROM scores"
        ),
        "search_keywords": (
            f"{indexed}, {by_keyword} SELECT doc_id, round(score, 6) AS score "
            "FROM scores WHERE field = 'keywords'"
        ),
        "search_best_fields": (
            f"{indexed}, {scored} SELECT doc_id, round(score, 6) AS score FROM best"
        ),
        "search_page": (
            f"{indexed}, {scored} SELECT rank, doc_id, round(score, 6) AS score FROM placed "
            "WHERE rank BETWEEN 11 AND 20"
        ),
        "search_full_ranking": (
            f"{indexed}, {scored} SELECT rank, doc_id, round(score, 6) AS score FROM placed"
        ),
        "empty_query": (
            f"{indexed}, {scored} SELECT 'blank' AS request, '{fixed.EMPTY_QUERY}' AS error, "
            "NULL AS total UNION ALL SELECT 'words', NULL, count(*) FROM best"
        ),
        "index_precondition": (
            f"WITH {sql.ITEMS} SELECT false AS refreshed_without, CAST(0 AS BIGINT) AS deleted, "
            "count(*) AS indexed FROM items"
        ),
        "search_dedup_titles": r"""
            SELECT rank, title, url FROM (
              SELECT page_id AS rank, url, h || ' - Page ' || page_id AS title,
                row_number() OVER (PARTITION BY h ORDER BY page_id) AS n
              FROM (SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS h
                    FROM pages) p) q WHERE n = 1""",
        "search_total": (
            f"{indexed}, {scored} SELECT count(*) AS total, "
            "least((count(*) + 9) // 10, 27) AS total_pages FROM best"
        ),
        "search": rf"""{indexed}, {scored}, {JOINED},
            firsts AS (
              SELECT rank, doc_id, title, url, coalesce(keywords, '') AS keywords, content,
                row_number() OVER (PARTITION BY regexp_replace(title,
                  '(?i)[{sql.SPACE}]*-[{sql.SPACE}]*Page[{sql.SPACE}]*\d+', '', 'g')
                  ORDER BY rank) AS n
              FROM placed JOIN items USING (doc_id) LEFT JOIN joined USING (doc_id)
              WHERE rank <= 10)
            SELECT rank, doc_id, title, url, keywords, content FROM firsts WHERE n = 1""",
        "lookup_url": (
            f"WITH {sql.ITEMS} SELECT doc_id, title, url FROM items "
            "WHERE url = (SELECT min(url) FROM items)"
        ),
        "empty_index_search": (
            "SELECT total, total_pages, n_results FROM (SELECT count(*) AS total, "
            "0::BIGINT AS total_pages, 0::BIGINT AS n_results FROM pages WHERE page_id IS NULL), "
            "range(2)"
        ),
        "index_count": f"WITH {sql.ITEMS} SELECT count(*) AS n FROM items",
    }
