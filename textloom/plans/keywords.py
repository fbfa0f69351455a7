"""The keyword job: documents in, documents with ranked keywords out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import fixed
from textloom.operators import keywords as K
from textloom.operators.languages import LanguageModel
from textloom.session import stash

_COUNTS = "_term_counts"


def keyword_ranks(
    docs: DataFrame,
    min_df: int = fixed.MIN_DOC_FREQ,
    max_share: float = fixed.MAX_DOC_SHARE,
    top: int = fixed.KEYWORDS_PER_DOC,
    language_model: LanguageModel | None = None,
) -> DataFrame:
    """``doc_id, rank, term, weight`` of each document's best terms.

    Term counts serve the document frequencies and the ranking, so they are
    written once: tokenizing the corpus twice costs more than reading them back. Terms are
    ranked in their row, and only the best leave it.
    """
    counted = stash(K.count_terms(K.preprocess(docs, language_model)), "term-counts")
    n_docs = counted.count()
    tf = K.term_freq(counted)
    vocabulary = stash(K.doc_freq(tf, n_docs, min_df, max_share), "vocabulary")
    return K.ranks_by_document(counted, vocabulary, n_docs, top)


def enrich_documents(
    docs: DataFrame,
    min_df: int = fixed.MIN_DOC_FREQ,
    max_share: float = fixed.MAX_DOC_SHARE,
    top: int = fixed.KEYWORDS_PER_DOC,
    language_model: LanguageModel | None = None,
) -> DataFrame:
    """``docs`` plus ``keywords`` (replaced if there). ``doc_id`` is unique.

    Texts are written once, with the counts of their terms beside them. Document frequencies
    read the counts alone. Where the vocabulary is small enough to travel to every task, rows
    are ranked where they lie and nothing of a text is shuffled. Beyond, the ranked terms are
    joined to the texts by ``doc_id``.
    """
    rows = stash(K.with_counts(docs.drop("keywords"), _COUNTS, language_model), "counted-documents")
    n_docs = rows.count()
    counted = rows.select("doc_id", F.col(_COUNTS).alias("counts"))
    tf = K.term_freq(counted)
    vocabulary = stash(K.doc_freq(tf, n_docs, min_df, max_share), "vocabulary")
    if K.fits_broadcast(vocabulary):
        return K.rank_in_place(rows, _COUNTS, vocabulary, n_docs, top)
    ranks = K.ranks_by_document(counted, vocabulary, n_docs, top)
    return K.attach_keywords(rows.drop(_COUNTS), K.doc_keywords(ranks))


def enrich_items(items: DataFrame, **options) -> DataFrame:
    """Enrichment of items without an id of their own (a JSON-lines scan).

    Every line is a document of its own, so each gets a row id. Ids given out by a scan may
    change when it is rerun; ``enrich_documents`` writes the rows once.
    """
    numbered = items.drop("keywords").withColumn("doc_id", F.monotonically_increasing_id())
    enriched = enrich_documents(numbered, **options)
    return enriched.select("title", "url", "keywords", "content")
