"""Language, tokens, TF-IDF and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.catalog import fixtures, sql
from textloom.functions.language import detect_language as language_of
from textloom.functions.text import keyword_clean
from textloom.functions.text import tokenize as tokens_of
from textloom.operators import keywords as K
from textloom.operators import languages as L
from textloom.plans import keywords as jobs
from textloom.session import stash
from textloom.sources.tables import read_documents, read_table, spread


def detect_language(spark, folder):
    docs = read_documents(spark, folder)
    return docs.select("doc_id", language_of(F.col("content")).alias("lang"))


def detect_language_trained(spark, folder):
    """The label of every text, and its name, by a model of all labelled texts."""
    docs = spread(read_table(spark, folder, "documents")).withColumnRenamed("text", "content")
    model = L.train_languages(docs.select("content", "lang"))
    content = F.coalesce("content", F.lit(""))
    told = docs.select("doc_id", L.most_likely(content, model).alias("label"))
    name = F.when(F.col("label") == "en", "english").when(F.col("label") == "fr", "french")
    return told.select("doc_id", "label", F.coalesce(name, F.lit("unknown")).alias("lang"))


def tokenize(spark, folder):
    docs = read_documents(spark, folder)
    words = tokens_of(keyword_clean(F.col("content")))
    return docs.select("doc_id", F.array_join(words, " ").alias("tokens"))


def stopword_filter(spark, folder):
    return K.preprocess(read_documents(spark, folder)).select(
        "doc_id", F.size("terms").cast("long").alias("n_terms"),
        F.array_join("terms", " ").alias("terms"),
    )


def preprocess_document(spark, folder):
    terms = K.preprocess(read_documents(spark, folder))
    return terms.select("doc_id", "lang", F.array_join("terms", " ").alias("processed"))


def _counted(spark, folder):
    return K.count_terms(K.preprocess(read_documents(spark, folder)))


def term_freq(spark, folder):
    return K.term_freq(_counted(spark, folder))


def doc_freq_pruned(spark, folder):
    n_docs = read_documents(spark, folder).count()
    return K.doc_freq(K.term_freq(_counted(spark, folder)), n_docs)


def tfidf_weights(spark, folder):
    counted = stash(_counted(spark, folder), "term-counts")
    n_docs = counted.count()
    tf = K.term_freq(counted)
    weights = K.tfidf_weights(K.join_vocabulary(tf, K.doc_freq(tf, n_docs)), n_docs)
    return weights.withColumn("tfidf", F.round("tfidf", 6))


def top_keywords(spark, folder):
    ranks = jobs.keyword_ranks(read_documents(spark, folder))
    return ranks.select(
        "doc_id", F.col("rank").cast("long").alias("rank"), "term",
        F.round("weight", 6).alias("weight"),
    )


def doc_keywords(spark, folder):
    found = K.doc_keywords(jobs.keyword_ranks(read_documents(spark, folder)))
    return found.select("doc_id", F.array_join("keywords", ",").alias("keywords"))


def enrich_documents(spark, folder):
    enriched = jobs.enrich_documents(fixtures.items(spark, folder))
    joined = F.array_join("keywords", ",").alias("keywords")
    return enriched.select("title", "url", joined, "content")


QUERIES = {
    "detect_language": detect_language,
    "detect_language_trained": detect_language_trained,
    "tokenize": tokenize,
    "stopword_filter": stopword_filter,
    "preprocess_document": preprocess_document,
    "term_freq": term_freq,
    "doc_freq_pruned": doc_freq_pruned,
    "tfidf_weights": tfidf_weights,
    "top_keywords": top_keywords,
    "doc_keywords": doc_keywords,
    "enrich_documents": enrich_documents,
}

#: Trigrams of code points, unfolded row by row; the numbers are those of the method.
_TRAINED = """
WITH chars AS (
  SELECT doc_id, lang, unnest(range(1, len(t) + 1)) AS i, t FROM (
    SELECT doc_id, lang, ' ' || coalesce(text, '') || ' ' AS t FROM documents) d),
codes AS (SELECT doc_id, lang, i, unicode(t[i]) AS c FROM chars),
folded AS (
  SELECT doc_id, lang, i,
    CASE WHEN c BETWEEN 65 AND 90 OR (c BETWEEN 192 AND 222 AND c <> 215) THEN c + 32 ELSE c END AS f
  FROM codes),
letters AS (
  SELECT doc_id, lang, i, CASE WHEN f BETWEEN 97 AND 122 OR (f >= 223 AND f <> 247) THEN f ELSE 32 END AS f,
    f BETWEEN 97 AND 122 OR (f >= 223 AND f <> 247) AS is_letter FROM folded),
around AS (
  SELECT doc_id, lang, is_letter, lag(f) OVER w * 961 + f * 31 + lead(f) OVER w AS h
  FROM letters WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
grams AS (
  SELECT doc_id, lang, h % 8192 AS bucket, count(*) AS n FROM around
  WHERE is_letter AND h IS NOT NULL GROUP BY ALL),
counts AS (SELECT lang, bucket, sum(n) AS n FROM grams WHERE lang IS NOT NULL GROUP BY ALL),
sizes AS (SELECT lang, sum(n) AS size FROM counts GROUP BY lang),
scores AS (
  SELECT g.doc_id, s.lang, sum(g.n * ln((coalesce(c.n, 0) + 1.0) / (s.size + 8192))) AS score
  FROM grams g CROSS JOIN sizes s LEFT JOIN counts c ON c.lang = s.lang AND c.bucket = g.bucket
  GROUP BY ALL),
best AS (SELECT doc_id, arg_max(lang, score) AS label FROM scores GROUP BY doc_id)
SELECT doc_id, label, CASE label WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french' ELSE 'unknown' END AS lang
FROM documents LEFT JOIN best USING (doc_id)
"""

JOINED = """
joined AS (
  SELECT doc_id, string_agg(term, ',' ORDER BY rank) AS keywords FROM ranked GROUP BY doc_id)"""


def oracles() -> dict[str, str]:
    docs = f"WITH {sql.DOCS}"
    job = f"{docs}, {sql.keywords_cte('docs')}"
    return {
        "detect_language": f"{docs}, {sql.language_cte('docs')} SELECT doc_id, lang FROM langs",
        "detect_language_trained": _TRAINED,
        "tokenize": (
            f"SELECT doc_id, array_to_string({sql.words(sql.keyword_cleaned('text'))}, ' ') "
            "AS tokens FROM documents"
        ),
        "stopword_filter": (
            f"{docs}, {sql.terms_cte('docs')} SELECT doc_id, len(terms) AS n_terms, "
            "array_to_string(terms, ' ') AS terms FROM terms"
        ),
        "preprocess_document": (
            f"{docs}, {sql.terms_cte('docs')} "
            "SELECT doc_id, lang, array_to_string(terms, ' ') AS processed FROM terms"
        ),
        "term_freq": f"{job} SELECT doc_id, term, tf FROM tf",
        "doc_freq_pruned": f"{job} SELECT term, df FROM vocabulary",
        "tfidf_weights": (
            f"{job} SELECT doc_id, term, tf, df, "
            "round(weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)), 6) AS tfidf "
            "FROM weights"
        ),
        "top_keywords": (
            f"{job} SELECT doc_id, rank, term, round(weight, 6) AS weight FROM ranked"
        ),
        "doc_keywords": f"{job}, {JOINED} SELECT doc_id, keywords FROM joined",
        "enrich_documents": (
            f"WITH {sql.ITEMS}, {sql.keywords_cte('items')}, {JOINED} "
            "SELECT title, url, coalesce(keywords, '') AS keywords, content "
            "FROM items LEFT JOIN joined USING (doc_id)"
        ),
    }
