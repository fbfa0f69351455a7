"""Ranked search over postings: scoring, paging, title de-duplication, totals."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions import fixed
from textloom.functions.analysis import analyze
from textloom.functions.text import normalize_title
from textloom.operators.postings import FIELDS, TEXT_FIELDS, term_stats


def check_request(query: str, page: int, size: int) -> str:
    """The trimmed query; ``ValueError`` for a request that cannot be answered."""
    query = query.strip()
    if not query:
        raise ValueError(fixed.EMPTY_QUERY)
    if page < 1 or size < 1:
        raise ValueError("page and size start at 1")
    return query


def query_terms(spark: SparkSession, query: str) -> dict[str, int]:
    """Analysed query terms with their counts; a repeated term weighs more."""
    row = spark.range(1).select(analyze(F.lit(query)).alias("terms")).first()
    return dict(Counter(row["terms"]))


def matching_postings(postings: DataFrame, terms: dict[str, int], query: str) -> DataFrame:
    """Postings the query touches: its terms in text fields, or the whole query as
    one exact keyword."""
    in_text = F.col("field").isin(*TEXT_FIELDS) & F.col("term").isin(*terms)
    as_keyword = (F.col("field") == "keywords") & (F.col("term") == query)
    return postings.where(F.col("term").isin(*terms, query) & (in_text | as_keyword))


def inverse_frequency(df: Column, n_docs: Column) -> Column:
    return F.log(1.0 + (n_docs - df + 0.5) / (df + 0.5))


def saturation(tf: Column, dl: Column, avgdl: Column) -> Column:
    """The share of a term's weight that a document reaches."""
    k1, b = fixed.BM25_K1, fixed.BM25_B
    return (k1 + 1.0) * tf / (tf + k1 * ((1.0 - b) + b * dl / avgdl))


def bm25(tf: Column, dl: Column, df: Column, n_docs: Column, avgdl: Column) -> Column:
    return inverse_frequency(df, n_docs) * saturation(tf, dl, avgdl)


def _repeats(terms: dict[str, int]) -> Column:
    """How often the query has a row's term; once as a keyword."""
    repeats = F.coalesce(
        *[F.when(F.col("term") == term, F.lit(n)) for term, n in terms.items() if n > 1],
        F.lit(1),
    )
    return F.when(F.col("field") == "keywords", F.lit(1)).otherwise(repeats)


def field_scores(
    postings: DataFrame,
    stats: DataFrame,
    terms: dict[str, int],
    query: str,
    frequencies: DataFrame | None = None,
) -> DataFrame:
    """``doc_id, title, keywords, content``: a score per field, NULL without a hit.

    ``frequencies`` is ``field, term, df`` where it is stored, else it is counted.

    Both joined sides are tiny whatever the data: one row per field, and one per
    field and query term. The term frequencies are summed per task before the one
    shuffle, by document.
    """
    found = matching_postings(postings, terms, query)
    if frequencies is None:
        known = term_stats(found)
    else:
        known = frequencies.where(F.col("term").isin(*terms, query)).select("field", "term", "df")
    scored = (
        found.join(F.broadcast(known), ["field", "term"])
        .join(F.broadcast(stats), "field")
        .withColumn(
            "score",
            _repeats(terms) * bm25(*[F.col(c) for c in ("tf", "dl", "df", "n_docs", "avgdl")]),
        )
    )
    return _by_field(scored, "doc_id")


def _by_field(scored: DataFrame, key: str) -> DataFrame:
    per_field = [
        F.sum(F.when(F.col("field") == field, F.col("score"))).alias(field) for field in FIELDS
    ]
    return scored.groupBy(key).agg(*per_field)


def block_bounds(
    found: DataFrame,
    blocks: DataFrame,
    stats: DataFrame,
    terms: dict[str, int],
    frequencies: DataFrame,
    block_bits: int,
) -> DataFrame:
    """``block, bound``: no document of the block scores higher. ``found`` are the postings
    the query touches, ``blocks`` what is known of its common terms by block; its other
    terms, which are in few documents, are summed up here."""
    rare = frequencies.where(F.col("df") < (1 << block_bits)).select("field", "term")
    weight = frequencies.join(F.broadcast(stats), "field").select(
        "field", "term", (_repeats(terms) * inverse_frequency(F.col("df"), F.col("n_docs"))).alias("weight")
    )
    few = found.join(F.broadcast(rare), ["field", "term"]).join(F.broadcast(stats), "field")
    few = few.groupBy("field", "term", F.shiftright("pos", block_bits).alias("block")).agg(
        F.max(saturation(F.col("tf"), F.col("dl"), F.col("avgdl"))).alias("best")
    )
    known = blocks.select("field", "term", "block", "best").unionByName(few)
    weighed = known.join(F.broadcast(weight), ["field", "term"])
    per_field = _by_field(weighed.withColumn("score", F.col("weight") * F.col("best")), "block")
    best = F.greatest(*[F.coalesce(F.col(field), F.lit(0.0)) for field in FIELDS])
    return per_field.select("block", best.alias("bound"))


def count_documents_of(found: DataFrame) -> int:
    """Distinct documents of postings, by their place: tasks hand on bitmaps of 32,768
    places each, so no document is shuffled to be counted."""
    bits = found.groupBy(F.bitmap_bucket_number("pos").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("pos")).alias("bits")
    )
    return bits.agg(F.sum(F.bitmap_count("bits"))).first()[0] or 0


def best_field(scores: DataFrame) -> DataFrame:
    """``doc_id, score``: the best field decides. Rounded, so that the order of a
    sum cannot reorder equal documents."""
    best = F.greatest(*[F.coalesce(F.col(field), F.lit(0.0)) for field in FIELDS])
    return scores.select("doc_id", F.round(best, 9).alias("score"))


def rank_all(scored: DataFrame) -> DataFrame:
    """The whole ranking, best first; equal scores by document."""
    return scored.orderBy(F.col("score").desc(), F.col("doc_id"))


def best_documents(scored: DataFrame, count: int) -> DataFrame:
    """The first ``count`` of the whole ranking."""
    return rank_all(scored).limit(count)


def result_page(scored: DataFrame, page: int, size: int) -> DataFrame:
    """``rank, doc_id, score`` of one page. Its rows are at most ``size`` and known
    here, so the documents can be looked up by id instead of joined in full."""
    start = (page - 1) * size
    rows = rank_all(scored).offset(start).limit(size).collect()
    return scored.sparkSession.createDataFrame(
        [(start + i + 1, row["doc_id"], row["score"]) for i, row in enumerate(rows)],
        "rank int, doc_id long, score double",
    )


def fetch_documents(hits: DataFrame, docs: DataFrame) -> DataFrame:
    """Stored fields of a page of hits. The ids are pushed to the scan as a filter."""
    ids = [row["doc_id"] for row in hits.select("doc_id").collect()]
    return docs.where(F.col("doc_id").isin(*ids)).join(F.broadcast(hits), "doc_id")


def fill_defaults(results: DataFrame) -> DataFrame:
    """Placeholders for stored fields that are missing."""
    return results.withColumns(
        {
            "title": F.coalesce("title", F.lit(fixed.DEFAULT_TITLE)),
            "url": F.coalesce("url", F.lit(fixed.DEFAULT_URL)),
            "keywords": F.coalesce("keywords", F.array().cast("array<string>")),
            "content": F.coalesce("content", F.lit(fixed.DEFAULT_CONTENT)),
        }
    )


def dedup_titles(results: DataFrame) -> DataFrame:
    """First hit per normalised title. Works on one page of results, after paging,
    so a page may come out shorter and totals do not change."""
    same = Window.partitionBy(normalize_title(F.col("title"))).orderBy("rank")
    return results.withColumn("__n", F.row_number().over(same)).where("__n = 1").drop("__n")


def totals(scored: DataFrame, page: int, size: int) -> DataFrame:
    """One row ``total, page, size, total_pages`` of scored documents."""
    return totals_of(scored.agg(F.count(F.lit(1)).alias("total")), page, size)


def totals_of(counted: DataFrame, page: int, size: int) -> DataFrame:
    """The same of one row ``total``."""
    pages = F.expr(f"(total + {size} - 1) div {size}")
    return counted.select(
        "total",
        F.lit(page).alias("page"),
        F.lit(size).alias("size"),
        F.least(pages, F.lit(fixed.PAGE_CAP).cast("long")).alias("total_pages"),
    )


def search_keywords(docs: DataFrame, query: str) -> DataFrame:
    """``doc_id`` of documents having the whole query as one keyword, case-sensitive."""
    return docs.where(F.array_contains("keywords", query)).select("doc_id")


def lookup_url(docs: DataFrame, url: str) -> DataFrame:
    return docs.where(F.col("url") == url)
