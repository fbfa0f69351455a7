"""The trained language detector: counts by hand, held-out agreement, odd texts."""

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from textloom.operators import keywords as K
from textloom.operators import languages as L


def plain_counts(text):
    folded = []
    for c in map(ord, f" {text} "):
        c += 32 if 65 <= c <= 90 or (192 <= c <= 222 and c != 215) else 0
        folded.append(c if 97 <= c <= 122 or (c >= 223 and c != 247) else 32)
    found = Counter()
    for a, b, c in zip(folded, folded[1:], folded[2:]):
        if b != 32:
            found[(a * 961 + b * 31 + c) % L.BUCKETS] += 1
    return found


def test_trigram_counts(monkeypatch):
    texts = ["", "a", "Été à l'ÉTÉ ×÷ ß", "x1y 2", "日本 🙂 Ωμέγα", "long words " * 50]
    for size in (L.CHARS_AT_ONCE, 3):
        monkeypatch.setattr(L, "CHARS_AT_ONCE", size)
        for text in texts:
            counts = L.trigram_counts(text)
            assert {b: counts[b] for b in np.flatnonzero(counts)} == plain_counts(text)


def test_held_out_agreement_by_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").withColumnRenamed("text", "content")
    docs = docs.withColumn("held", F.crc32(F.col("doc_id").cast("string")) % 5 == 0).repartition(8)
    model = L.train_languages(docs.where("NOT held"))
    assert model.languages == ["de", "en", "es", "fr"]
    rows = docs.where("held").select("lang", L.most_likely(F.col("content"), model).alias("told")).collect()
    right, n = Counter(r.lang for r in rows if r.lang == r.told), Counter(r.lang for r in rows)
    assert len(rows) > 1_500
    assert sum(right.values()) / len(rows) > 0.99
    assert all(right[lang] / n[lang] > 0.98 for lang in n)


def test_odd_texts_and_labels(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "en"), (4, "x", None), (5, "", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, content string, lang string")
    model = L.train_languages(docs)
    assert model.languages == ["en", "fr"]
    told = {r.doc_id: (r.told, r.lang) for r in docs.select("doc_id", L.most_likely(F.col("content"), model).alias("told"), L.detect_trained(F.col("content"), model).alias("lang")).collect()}
    assert told[1] == ("en", "english") and told[2] == ("fr", "french")
    assert told[3] == told[5] == (None, "unknown")
    none = L.train_languages(docs.limit(0))
    assert [r.l for r in docs.select(L.most_likely(F.col("content"), none).alias("l")).collect()] == [None] * 5
    assert L.train_languages(docs, most=1).languages == ["en"]
    terms = {r.doc_id: r.terms for r in K.preprocess(docs, model).collect()}
    assert "the" not in terms[1] and "cat" in terms[1] and zlib.crc32(b"") == 0
