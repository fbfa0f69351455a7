"""Search end to end: a query string in, one page of results and totals out."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import fixed
from textloom.operators import search as S
from textloom.plans.index import Index, postings_of
from textloom.session import stash

#: Blocks scored in the first rounds; the last round takes all that are left.
ROUNDS = (16, 128, 1_024)
#: Ranges of places that are pushed to the scan as they are; more are joined.
PUSHED_RANGES = 64
#: Scores are rounded, and bounds are sums in another order.
SLACK = 1e-6


class SearchAnswer(NamedTuple):
    results: DataFrame
    totals: DataFrame


class Best(NamedTuple):
    """``hits``: ``doc_id, score`` of the best documents. ``bounds``: ``block, bound`` of
    all blocks with a hit, of which ``scored`` had to be scored."""

    hits: DataFrame
    bounds: DataFrame
    scored: int


class Matched(NamedTuple):
    """A query held against an index: its terms, the postings it touches, and the document
    frequencies and blocks of its terms."""

    index: Index
    terms: dict[str, int]
    query: str
    postings: DataFrame
    frequencies: DataFrame
    blocks: DataFrame


def match(index: Index, query: str) -> Matched:
    terms = S.query_terms(index.docs.sparkSession, query)
    postings, frequencies, blocks = postings_of(index, sorted({*terms, query}))
    return Matched(
        index, terms, query, S.matching_postings(postings, terms, query),
        frequencies.where(F.col("term").isin(*terms, query)).select("field", "term", "df"),
        S.matching_postings(blocks, terms, query),
    )


def _scores(matched: Matched, postings: DataFrame) -> DataFrame:
    fields = S.field_scores(
        postings, matched.index.stats, matched.terms, matched.query, matched.frequencies
    )
    return S.best_field(fields)


def scored_documents(index: Index, query: str) -> DataFrame:
    """``doc_id, score`` of every document the query matches."""
    matched = match(index, query)
    return _scores(matched, matched.postings)


def _places(blocks: list[int], bits: int) -> Column | None:
    """A filter on the places of some blocks, as ranges that a scan can skip by; None if
    there are too many ranges."""
    runs: list[list[int]] = []
    for block in sorted(blocks):
        if runs and block == runs[-1][1] + 1:
            runs[-1][1] = block
        else:
            runs.append([block, block])
    if len(runs) > PUSHED_RANGES:
        return None
    inside = F.lit(False)
    for first, last in runs:
        inside = inside | F.col("pos").between(first << bits, ((last + 1) << bits) - 1)
    return inside


def best_documents(index: Index, query: str, count: int) -> Best:
    return best_matched(match(index, query), count)


def best_matched(matched: Matched, count: int) -> Best:
    """The ``count`` best documents of a query, without scoring every hit.

    Every block of documents has an upper bound of its scores. Blocks are scored in the
    order of their bounds, in a few rounds of growing size; a block whose bound is below
    the score of the last of the best so far is never read. What is left for the last
    round are the blocks that still could matter, however many these are.
    """
    found, bits = matched.postings, matched.index.block_bits
    spark = found.sparkSession
    bounds = S.block_bounds(
        found, matched.blocks, matched.index.stats, matched.terms, matched.frequencies, bits
    )
    bounds = stash(bounds, "block-bounds")
    place = F.shiftright("pos", bits)
    scored, best, least, last = 0, None, None, None
    for size in (*ROUNDS, None):
        left = bounds
        if least is not None:
            left = left.where(F.col("bound") >= least - SLACK)
        if last is not None:
            bound, block = F.col("bound"), F.col("block")
            same = (bound == last["bound"]) & (block > last["block"])
            left = left.where((bound < last["bound"]) | same)
        if size is None:
            left = stash(left, "block-rest")
            n = left.count()
            chosen = left.select(F.col("block").alias("__block"))
            some = found.join(chosen, place == F.col("__block"), "left_semi")
        else:
            taken = left.orderBy(F.desc("bound"), "block").limit(size).collect()
            n = len(taken)
            last = taken[-1] if taken else None
            inside = _places([row["block"] for row in taken], bits)
            if inside is not None:
                some = found.where(inside)
            else:
                chosen = spark.createDataFrame([(row["block"],) for row in taken], "__block long")
                some = found.join(F.broadcast(chosen), place == F.col("__block"), "left_semi")
        if n:
            new = S.best_documents(_scores(matched, some), count)
            both = new if best is None else S.best_documents(best.unionByName(new), count)
            best = stash(both, "best")
            scored += n
        if size is None or n < size:  # No block is left that could matter.
            break
        worst = best.agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).first()
        least = worst["least"] if worst["n"] == count else None
    if best is None:
        best = spark.createDataFrame([], "doc_id long, score double")
    return Best(best, bounds, scored)


def count_hits(index: Index, query: str) -> int:
    """Exact number of documents a query matches; nothing is scored for it."""
    return S.count_documents_of(match(index, query).postings)


def search(
    index: Index,
    query: str,
    page: int = 1,
    size: int = fixed.PAGE_SIZE,
) -> SearchAnswer:
    """``rank, doc_id, title, url, keywords, content, score`` and the totals row."""
    query = S.check_request(query, page, size)
    spark = index.docs.sparkSession
    matched = match(index, query)
    hits = S.result_page(best_matched(matched, page * size).hits, page, size)
    found = S.dedup_titles(S.fill_defaults(S.fetch_documents(hits, index.docs)))
    results = found.select("rank", "doc_id", "title", "url", "keywords", "content", "score")
    counted = spark.createDataFrame([(S.count_documents_of(matched.postings),)], "total long")
    return SearchAnswer(results, S.totals_of(counted, page, size))
