"""Explicit schemas; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

PAGE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

ITEM = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)

#: ``error_code`` holds an HTTP status or an exception name, so it is text.
FAILURE = T.StructType(
    [
        T.StructField("failed_url", T.StringType()),
        T.StructField("error_code", T.StringType()),
    ]
)

ENRICHED = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("keywords", T.ArrayType(T.StringType())),
        T.StructField("content", T.StringType()),
    ]
)

FETCH = T.StructType(
    [
        T.StructField("fetch_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("exception", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
)

LINK = T.StructType(
    [T.StructField("href", T.StringType()), T.StructField("dst_url", T.StringType())]
)

#: How each stored field is searched: analysed text or one exact term.
INDEX_MAPPING = {"title": "text", "url": "keyword", "keywords": "keyword", "content": "text"}


def index_schema() -> T.StructType:
    """Stored documents: the enriched fields, each tagged with its mapping."""
    fields = [T.StructField("doc_id", T.LongType())]
    for field in ENRICHED.fields:
        fields.append(
            T.StructField(
                field.name, field.dataType, True, {"index": INDEX_MAPPING[field.name]}
            )
        )
    return T.StructType(fields)


POSTING = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("field", T.StringType()),
        T.StructField("term", T.StringType()),
        T.StructField("tf", T.LongType()),
        T.StructField("dl", T.LongType()),
        T.StructField("pos", T.LongType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)

#: Of a common term in a block of documents: how many have it, and the greatest share of
#: the term's weight that it reaches in one of them.
BLOCK = T.StructType(
    [
        T.StructField("field", T.StringType()),
        T.StructField("term", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("best", T.DoubleType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)

#: Document frequencies of the terms, beside the postings.
TERM = T.StructType(
    [
        T.StructField("field", T.StringType()),
        T.StructField("term", T.StringType()),
        T.StructField("df", T.LongType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)

FIELD_STATS = T.StructType(
    [
        T.StructField("field", T.StringType()),
        T.StructField("n_docs", T.LongType()),
        T.StructField("avgdl", T.DoubleType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("block_bits", T.IntegerType()),
    ]
)
