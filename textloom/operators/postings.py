"""Postings of the searchable fields, and the statistics their scores need."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.analysis import analyze, with_term_counts

TEXT_FIELDS = ("title", "content")
FIELDS = ("title", "keywords", "content")


def analyze_documents(
    docs: DataFrame, only_terms: Iterable[str] | None = None, keys: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``doc_id`` (or other ``keys``) and, per field, its term counts (``*_tf``) and length (``*_dl``).

    ``docs`` needs ``doc_id`` and any of title, keywords, content. A keyword is
    one exact term, counted once, and its field has no length normalisation.
    ``only_terms`` counts nothing else in the text fields: for one search over
    documents that are not indexed. Lengths are always those of the whole text.
    """
    only = None if only_terms is None else list(only_terms)
    out = docs
    kept = list(keys)
    for field in TEXT_FIELDS:
        if field in docs.columns:
            words = f"__{field}_words"
            out = out.withColumn(words, analyze(F.col(field)))
            out = out.withColumn(f"{field}_dl", F.size(words).cast("long"))
            if only is not None:
                out = out.withColumn(words, F.filter(words, lambda word: word.isin(*only)))
            out = with_term_counts(out, words, f"{field}_tf").drop(words)
            kept += [f"{field}_tf", f"{field}_dl"]
    if "keywords" in docs.columns:
        distinct = F.array_distinct(F.coalesce("keywords", F.array().cast("array<string>")))
        out = out.withColumn(
            "keywords_tf",
            F.transform(
                distinct, lambda k: F.struct(k.alias("term"), F.lit(1).cast("long").alias("tf"))
            ),
        ).withColumn("keywords_dl", F.size("keywords_tf").cast("long"))
        kept += ["keywords_tf", "keywords_dl"]
    return out.select(*kept)


def _fields(analyzed: DataFrame) -> list[str]:
    return [field for field in FIELDS if f"{field}_tf" in analyzed.columns]


def build_postings(analyzed: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``doc_id, field, term, tf, dl`` (or other ``keys``); narrow, no shuffle."""

    def entries(field: str):
        length = F.lit(1).cast("long") if field == "keywords" else F.col(f"{field}_dl")
        return F.transform(
            f"{field}_tf",
            lambda c: F.struct(
                F.lit(field).alias("field"),
                c["term"].alias("term"),
                c["tf"].alias("tf"),
                length.alias("dl"),
            ),
        )

    everything = F.concat(*[entries(field) for field in _fields(analyzed)])
    rows = analyzed.select(*keys, everything.alias("postings"))
    exploded = rows.select(*keys, F.inline_outer("postings"))
    return exploded.where(F.col("term").isNotNull())


def field_stats(analyzed: DataFrame) -> DataFrame:
    """``field, n_docs, avgdl``, over the documents that have the field.

    Read from the length columns; one row per task reaches the shuffle.
    """
    fields = _fields(analyzed)
    aggregates = []
    for field in fields:
        length = F.col(f"{field}_dl")
        aggregates.append(F.count_if(length > 0).alias(f"{field}_n"))
        aggregates.append(F.sum(length).alias(f"{field}_sum"))
    one_row = analyzed.agg(*aggregates)
    per_field = F.array(
        *[
            F.struct(
                F.lit(field).alias("field"),
                F.col(f"{field}_n").alias("n_docs"),
                F.try_divide(f"{field}_sum", f"{field}_n").alias("avgdl"),
            )
            for field in fields
        ]
    )
    return one_row.select(F.inline(per_field)).where(F.col("n_docs") > 0)


def term_stats(postings: DataFrame) -> DataFrame:
    """``field, term, df``."""
    return postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
