"""TF-IDF keywords over a corpus of ``doc_id, content`` rows.

Counting terms inside a document is row-local. One partial count per term and task is
shuffled for the document frequencies. ``rank_in_place`` shuffles nothing more;
``ranks_by_document`` shuffles the ten best terms of each row, and of the term table the
rows of uncommon terms when the vocabulary is too large to broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import fixed
from textloom.functions.analysis import explode_structs, with_term_counts
from textloom.functions.language import detect_language, drop_stop_words
from textloom.functions.text import keyword_clean, tokenize
from textloom.operators.languages import LanguageModel, detect_trained
from textloom.session import BROADCAST_BYTES, bound_batches, bytes_of, stash

#: At most this many vocabulary rows are broadcast (some 100 MB as a hash table).
BROADCAST_ROWS = 1_000_000
#: Term counts that are looked up at once: a lookup begins by hashing the whole vocabulary.
BYTES_AT_ONCE = 32 << 20


def preprocess(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """``doc_id, lang, terms``: detected language and the terms that count. Languages are
    told by word lists, or by a trained model if there is one."""
    told = detect_language if model is None else lambda text: detect_trained(text, model)
    content = F.coalesce(F.col("content"), F.lit(""))
    detected = docs.select("doc_id", content.alias("content")).withColumn(
        "lang", told(F.col("content"))
    )
    tokens = tokenize(keyword_clean(F.col("content")))
    return detected.select(
        "doc_id", "lang", drop_stop_words(tokens, F.col("lang")).alias("terms")
    )


def count_terms(terms: DataFrame) -> DataFrame:
    """``doc_id, counts``: each document's distinct terms with their counts."""
    return with_term_counts(terms.select("doc_id", "terms"), "terms", "counts").drop("terms")


def with_counts(docs: DataFrame, out: str, model: LanguageModel | None = None) -> DataFrame:
    """``docs`` with ``out``: the counts of ``count_terms`` beside the text they are of."""
    told = detect_language if model is None else lambda text: detect_trained(text, model)
    content = F.coalesce(F.col("content"), F.lit(""))
    lang, terms = f"__{out}_lang", f"__{out}_terms"
    rows = docs.withColumn(lang, told(content))
    rows = rows.withColumn(terms, drop_stop_words(tokenize(keyword_clean(content)), F.col(lang)))
    return with_term_counts(rows, terms, out).drop(lang, terms)


def term_freq(counted: DataFrame) -> DataFrame:
    """``doc_id, term, tf``, one row per document and distinct term."""
    return explode_structs(counted, "counts", ["doc_id"])


def doc_freq(
    tf: DataFrame,
    n_docs: int,
    min_df: int = fixed.MIN_DOC_FREQ,
    max_share: float = fixed.MAX_DOC_SHARE,
) -> DataFrame:
    """``term, df`` of terms that are neither too rare nor too common.

    A term is summed per task before the shuffle, so a term that occurs in every
    document costs one row per task.
    """
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return df.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_share * n_docs)))


def _common_from(vocabulary: DataFrame, max_rows: int) -> int | None:
    """Lowest power of two such that at most ``max_rows`` terms occur in that many
    documents or more; None when even the most common terms are too many."""
    power = F.floor(F.log2("df")).cast("int").alias("power")
    sizes = vocabulary.groupBy(power).agg(F.count(F.lit(1)).alias("n")).collect()
    cutoff, rows = None, 0
    for size in sorted(sizes, reverse=True):
        rows += size["n"]
        if rows > max_rows:
            break
        cutoff = 2 ** size["power"]
    return cutoff


def _room(vocabulary: DataFrame) -> tuple[int, int]:
    """Rows of a written vocabulary, and how many of them fit both limits of a broadcast if
    all are about as long."""
    rows, size = vocabulary.count(), bytes_of(vocabulary)
    return rows, min(BROADCAST_ROWS, rows * BROADCAST_BYTES // max(1, size))


def fits_broadcast(vocabulary: DataFrame) -> bool:
    rows, room = _room(vocabulary)
    return rows <= room


def join_vocabulary(tf: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Term rows with their document frequency; pruned terms drop out.

    The vocabulary is written out first, so its size is known when the join is
    planned. Small, it is broadcast. Too large, its most common terms are, as many
    as fit: they make up most term rows, and all the hot ones. Only rows of other
    terms are then shuffled, and no term among those has many rows.
    """
    vocabulary = stash(vocabulary, "vocabulary")
    rows, fit = _room(vocabulary)
    if rows <= fit:
        return tf.join(F.broadcast(vocabulary), "term")
    cutoff = _common_from(vocabulary, fit)
    if cutoff is None:
        return tf.join(vocabulary, "term")
    common = F.broadcast(vocabulary.where(F.col("df") >= cutoff))
    rare = vocabulary.where(F.col("df") < cutoff)
    rest = tf.join(common.select("term"), "term", "left_anti")
    return tf.join(common, "term").unionByName(rest.join(rare, "term"))


def _idf(n_docs: int) -> Column:
    return F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0


def _weight(n_docs: int) -> Column:
    return F.col("tf") * _idf(n_docs)


def tfidf_weights(joined: DataFrame, n_docs: int) -> DataFrame:
    """``doc_id, term, tf, df, tfidf``, each document scaled to unit length."""
    weighted = joined.withColumn("weight", _weight(n_docs))
    length = F.sqrt(
        F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("doc_id"))
    )
    return weighted.select(
        "doc_id", "term", "tf", "df", (F.col("weight") / length).alias("tfidf")
    )


def top_keywords(
    joined: DataFrame, n_docs: int, top: int = fixed.KEYWORDS_PER_DOC
) -> DataFrame:
    """``doc_id, rank, term``: the best terms of each document, ties by term, last first.

    Scaling a document does not reorder its terms, so it is left out. The rank
    limit is applied before the shuffle as well as after it.
    """
    return _ranked(joined.select("doc_id", "term", _weight(n_docs).alias("weight")), top)


def _ranked(weighted: DataFrame, top: int) -> DataFrame:
    best_first = Window.partitionBy("doc_id").orderBy(F.col("weight").desc(), F.col("term").desc())
    ranked = weighted.withColumn("rank", F.row_number().over(best_first))
    return ranked.where(F.col("rank") <= top).select("doc_id", "rank", "term", "weight")


def doc_keywords(top: DataFrame) -> DataFrame:
    """``doc_id, keywords``: ranked terms as one array per document."""
    ranked = F.sort_array(F.collect_list(F.struct("rank", "term")))
    return top.groupBy("doc_id").agg(F.transform(ranked, lambda x: x["term"]).alias("keywords"))


def attach_keywords(docs: DataFrame, keywords: DataFrame) -> DataFrame:
    """Documents with their keywords; an empty array where none qualified."""
    empty = F.array().cast("array<string>")
    joined = docs.join(keywords, "doc_id", "left")
    return joined.withColumn("keywords", F.coalesce("keywords", empty))


def rank_in_place(
    counted: DataFrame,
    counts: str,
    vocabulary: DataFrame,
    n_docs: int,
    top: int = fixed.KEYWORDS_PER_DOC,
) -> DataFrame:
    """``counted`` with ``keywords`` in place of ``counts``: every row's best terms by its own
    counts, in the order of ``top_keywords``; an empty array where none qualified.

    For a written vocabulary that ``fits_broadcast``. It travels to the tasks, so no row
    leaves its own: neither texts nor counts are shuffled. The weight of a term is worked out
    by Spark, as for the join, so both ways give the same numbers.
    """
    bound_batches(counted.sparkSession)
    sent = _send(vocabulary, n_docs)

    @F.arrow_udf("array<string>")
    def best(found: pa.Array) -> pa.Array:
        known = pa.ipc.open_stream(sent.value).read_all().combine_chunks()
        return best_terms(found, known, top)

    return counted.withColumn("keywords", best(F.col(counts))).drop(counts)


def _send(vocabulary: DataFrame, n_docs: int) -> Broadcast:
    """``term, idf`` sorted by term, as an Arrow stream in a broadcast."""
    spark = vocabulary.sparkSession
    weighted = vocabulary.select("term", _idf(n_docs).alias("idf")).orderBy("term").toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, weighted.schema) as writer:
        writer.write_table(weighted)
    return spark.sparkContext.broadcast(sink.getvalue().to_pybytes())


def best_terms(counts: pa.Array, known: pa.Table, top: int) -> pa.Array:
    """The ``top`` terms of each list of ``term, tf``, heaviest first and ties by term, last
    first. ``known`` has ``term, idf`` sorted by term."""
    best, _ = _best(counts, known, top)
    return pa.ListArray.from_arrays(best.offsets, best.values.field("term"))


def _best(counts: pa.Array, known: pa.Table, top: int) -> tuple[pa.Array, pa.Array]:
    """Lists of ``term, weight`` as of ``best_terms``, and of the ``term, tf`` not ``known``."""
    lengths = pc.fill_null(pc.list_value_length(counts), 0).to_numpy(zero_copy_only=False)
    each = counts.flatten()
    terms = known.column("term").combine_chunks()
    at = pc.fill_null(pc.index_in(pc.struct_field(each, "term"), value_set=terms), -1)
    at = at.to_numpy(zero_copy_only=False)
    keep = at >= 0
    rows = np.repeat(np.arange(len(counts)), lengths)
    rest = _lists(each.filter(pa.array(~keep)), rows[~keep], len(counts))
    row, at = rows[keep], at[keep]
    tf = pc.struct_field(each, "tf").to_numpy(zero_copy_only=False)[keep]
    weight = tf * known.column("idf").to_numpy()[at]
    order = np.lexsort((-at, -weight, row))
    row, at, weight = row[order], at[order], weight[order]
    first = np.searchsorted(row, np.arange(len(counts)))
    best = np.arange(len(row)) - first[row] < top
    found = pa.StructArray.from_arrays(
        [terms.take(pa.array(at[best])), pa.array(weight[best])], names=["term", "weight"]
    )
    return _lists(found, row[best], len(counts)), rest


def _lists(values: pa.Array, row: np.ndarray, rows: int) -> pa.Array:
    bounds = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), values)


def ranks_by_document(
    counted: DataFrame, vocabulary: DataFrame, n_docs: int, top: int = fixed.KEYWORDS_PER_DOC
) -> DataFrame:
    """``top_keywords`` of ``counted`` (``doc_id, counts``) for a written vocabulary.

    Terms of the vocabulary, or of its most common part if it is too large to broadcast, are
    ranked in their row: only ``top`` of them leave it. The rows of all other terms meet the
    rest of the vocabulary by a shuffle, and the best of both are ranked by ``doc_id``.
    """
    rows, fit = _room(vocabulary)
    common, rare = vocabulary, None
    if rows > fit:
        cutoff = _common_from(vocabulary, fit)
        if cutoff is None:
            tf = term_freq(counted)
            return top_keywords(tf.join(vocabulary, "term"), n_docs, top)
        common, rare = (vocabulary.where(c) for c in (F.col("df") >= cutoff, F.col("df") < cutoff))
    bound_batches(counted.sparkSession)
    sent, whole = _send(common, n_docs), rare is None
    kinds = {f.name: f.dataType.simpleString() for f in counted.schema.fields}

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.ipc.open_stream(sent.value).read_all().combine_chunks()
        for held in _gathered(batches):
            best, rest = _best(held.column("counts"), known, top)
            columns = [held.column("doc_id"), best] if whole else [held.column("doc_id"), best, rest]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "best", "rest"][:len(columns)])

    schema = f"doc_id {kinds['doc_id']}, best array<struct<term:string,weight:double>>"
    schema += "" if whole else f", rest {kinds['counts']}"
    found = counted.select("doc_id", "counts").mapInArrow(rank, schema)
    if not whole:
        found = stash(found, "best-terms")
    candidates = found.select("doc_id", F.inline("best"))
    if not whole:
        others = explode_structs(found, "rest", ["doc_id"]).join(rare, "term")
        others = others.select("doc_id", "term", _weight(n_docs).alias("weight"))
        candidates = candidates.unionByName(others)
    return _ranked(candidates, top)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined to some of about ``BYTES_AT_ONCE``."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= BYTES_AT_ONCE:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)
