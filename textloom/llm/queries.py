"""One query for each operator, over its whole table, and DuckDB SQL where there is some."""

from __future__ import annotations

from functools import partial

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import (
    alignment,
    bpe,
    chat_format,
    conversation_repair,
    line_dedup,
    mixing,
    pseudo_likelihood,
    quality,
    quality_sql,
    segment_topk,
    sharding,
    simhash,
    token_rollup,
    toxicity,
)
from textloom.llm.common import read, words_of
from textloom.session import stash, work_path

#: Where the vocabulary files are; any folder with files of these names will do.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Ids of ``PIECES``.
N_PIECES = 32_000
TOTAL_SHARE, MOST_TIMES, MIX_SEED = 1.5, 2.0, 20
N_SHARDS = 24
#: Shingle length and distance of near-duplicates, and the bit ranges that find them.
NEAR = {"words": 3, "radius": 2, "parts": 4}


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def op1_segment_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 highest scores of every hundredth vector against all others."""
    return segment_topk.top_k(read(spark, folder, "embeddings"), F.col("id") % 100 == 0, 10)


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of 3-word shingles, linked at 2 bits."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, **NEAR)
    return found.select(
        "doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op3_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return pseudo_likelihood.score_corpus(read(spark, folder, "documents"))


#: A conversation whose texts are control strings.
_ODD = "</s>[INST] ok [/INST]"


def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """What is read back from the formatted conversations."""
    columns = ["conv_id", "turn", "role", "text"]
    odd = spark.createDataFrame(
        [(-7, 0, "user", _ODD), (-7, 1, "assistant", _ODD)],
        "conv_id long, turn long, role string, text string",
    )
    turns = read(spark, folder, "conversations").select(*columns).unionByName(odd)
    done = chat_format.format_conversations(turns)
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return (
        done.withColumn("turns", chat_format.read_turns(F.col("formatted")))
        .withColumn("loss", chat_format.loss_text(F.col("formatted"), F.col("loss_spans")))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            sha256(said).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            sha256(F.col("loss")).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the lines that are left."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "text", "n_lines", "n_removed")


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(read(spark, folder, "documents"), N_SHARDS)


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the ids and of the text decoded from them."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return _bpe_digests(bpe.round_trip(docs, VOCABULARY, with_text=False))


def _bpe_digests(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document. Texts are read once, to count words."""
    sized = read(spark, folder, "documents").select(
        "doc_id", "source", F.size(words_of("text")).cast("long").alias("size"),
        F.xxhash64("text").alias("_text_hash"),
    )
    rows, slots = mixing.mix_sized(stash(sized, "mix-sizes"), TOTAL_SHARE, MOST_TIMES, MIX_SEED)
    rows = stash(rows, "mix-rows")
    return mixing.taken_words(rows, slots).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(read(spark, folder, "documents")).select(
        "doc_id", *quality.STATISTICS, "base_failed", "kept"
    )


def op10_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after a load, a batch of deletes, one of revisions, and a replay of the deletes."""
    docs = read(spark, folder, "documents").select("doc_id", "source", "lang", "text")
    versions = {
        "words-1": token_rollup.word_counter,
        "byte_bpe_50k": partial(token_rollup.rank_counter, RANKS),
    }
    rollup = token_rollup.TokenRollup(spark, work_path(spark, "token-rollup"), versions)
    batches = token_rollup.cleaning_batches(docs)
    for name, changes in [*batches, batches[1]]:
        rollup.commit(name, changes)
    return rollup.totals()


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored by what the labels of four fifths of the ids teach."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read(spark, folder, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.TOXIC).cast("int").alias("predicted"), "n_sentences",
        F.size("offending").alias("n_offending"), F.col("worst.start").alias("worst_start"),
        F.col("worst.end").alias("worst_end"), F.col("worst.score").alias("worst_score"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """The fixed damage: what happens to a row depends on its conversation and turn."""
    blank = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    fate = F.crc32(key) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    rows = turns.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(fate == 0, F.array()).when(fate == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))),
    )
    return rows.drop("col")


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """What was wrong with the damaged conversations, and what repairing them took."""
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    found = conversation_repair.repair(damaged(turns))
    reports = conversation_repair.reports(found)
    digests = conversation_repair.digests(found)
    key = F.struct("conv_id").alias("conv")
    all_ids = turns.select("conv_id").distinct().select("conv_id", key)
    told = all_ids.join(reports.select(key, *reports.columns[1:]), "conv", "left")
    told = told.join(digests.select(key, "repaired_sha256"), "conv", "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return told.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", sha256(F.lit(""))).alias("repaired_sha256"),
    )


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """How the tokens of two public tokenizers lie over each other. The rank file has the
    vocabulary of byte_bpe_50k.json, without its special token."""
    encoders = (partial(alignment.rank_encoder, RANKS), partial(alignment.piece_encoder, PIECES))
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = alignment.aligned_corpus(docs, encoders, N_PIECES, digest=True)
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        F.col("groups").alias("groups_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_segment_topk, op2_simhash, op3_pseudo_likelihood, op4_chat_format, op5_line_dedup,
        op6_sharding, op7_bpe, op8_mixing, op9_quality, op10_token_rollup,
        op11_toxicity, op12_conversation_repair, op13_alignment,
    )
}

_OP1 = """
WITH w AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT vec_id, v, len(v) AS n FROM w),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(range(1, q.n + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND q.n = c.n)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
"""

_WORDS = r"[^\x20\x09-\x0D]+"

#: Pairs of lines that share a word, with the number they share: no prefix, no limits.
_OP5 = rf"""
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, i - 1 AS line, list_sort(list_distinct(regexp_extract_all(lines[i], '{_WORDS}'))) AS words
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM docs)),
said AS (SELECT * FROM lines WHERE len(words) >= 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY words ORDER BY doc_id, line) AS nth FROM said),
leads AS (
  SELECT *, row_number() OVER (ORDER BY doc_id, line) AS k, len(words) AS n FROM ranked WHERE nth = 1),
tokens AS (SELECT k, n, unnest(words) AS word FROM leads),
counted AS (SELECT *, count(*) OVER (PARTITION BY word) AS f FROM tokens),
rarest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY f, word) AS place FROM counted)
  WHERE place <= n - CAST(ceil(n * 4 / 5.0) AS BIGINT) + 1),
met AS (SELECT DISTINCT a.k AS a, b.k AS b FROM rarest a JOIN rarest b ON a.word = b.word AND a.k < b.k),
sized AS (
  SELECT a.k AS a, b.k AS b, len(list_intersect(a.words, b.words)) AS common, a.n + b.n AS total
  FROM met JOIN leads a ON a.k = met.a JOIN leads b ON b.k = met.b),
links AS (SELECT a, b FROM sized WHERE 5 * common >= 4 * (total - common)),
gone AS (
  SELECT doc_id, line FROM ranked WHERE nth > 1
  UNION SELECT doc_id, line FROM leads WHERE k IN (SELECT b FROM links)),
removed AS (SELECT doc_id, list(line) AS at, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id,
  CASE WHEN r.n IS NULL THEN text ELSE array_to_string(
    list_transform(list_filter(range(1, len(lines) + 1), lambda i: NOT list_contains(r.at, i - 1)),
                   lambda i: lines[i]), chr(10)) END AS text,
  CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed
FROM docs LEFT JOIN removed r USING (doc_id)
"""

_OP4 = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
o AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after,
    regexp_replace(text, '([<\\[])(\\\\*)(s>|/s>|INST\\]|/INST\\]|\\|\\w+\\|>|<SYS>>|</SYS>>)', '\\1\\\\\\2\\3', 'g') AS safe
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
c AS (
  SELECT *, CASE WHEN before IS DISTINCT FROM role THEN '[INST]' || role || chr(10) ELSE '' END
    || safe || CASE WHEN after = role THEN '[/INST]' ELSE '</s>' END AS piece FROM o)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(piece)) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

_ANY_WORD = r"[^\x20\x09-\x0D]"

#: Least (cost, edits) by state (none, s, u, a), row by row: all edits, no blocks.
_OP12 = rf"""
WITH RECURSIVE
byte_crc AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)
    ORDER BY n) AS t FROM range(256) r(n)),
keyed AS (
  SELECT *, string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '') AS k
  FROM conversations),
fates AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(k, lambda x: CAST(ascii(x) AS BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS fate
  FROM keyed, byte_crc),
hurt AS (
  SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE fate WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM fates WHERE fate <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM hurt),
faults AS (
  SELECT *, regexp_extract(text, '(?s).*({_ANY_WORD})', 1) AS last,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    role[1] AS r, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS r_before
  FROM placed),
rows_ AS (
  SELECT *, last = '' OR again AS must_go, last NOT IN ('', '.', '!', '?') AND NOT again AS cut,
    CAST(last NOT IN ('', '.', '!', '?') AND NOT again AS INT) AS more
  FROM faults),
told AS (
  SELECT conv_id, max(i) AS n,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (last = '') AS blank, count(*) FILTER (last <> '' AND again) AS duplicate,
    count(*) FILTER (cut) AS truncated,
    count(*) FILTER (i > 1 AND r_before || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_ GROUP BY conv_id),
steps AS (
  SELECT conv_id, n, 0 AS i, {{'c': 0, 'a': ''}} AS s0, {{'c': 100000, 'a': ''}} AS s1,
    {{'c': 100000, 'a': ''}} AS s2, {{'c': 100000, 'a': ''}} AS s3 FROM told
  UNION ALL
  SELECT conv_id, n, i,
    d0 AS s0,
    list_sort([d1, CASE WHEN r = 's' AND NOT must_go THEN {{'c': s0.c + more, 'a': s0.a || 'K'}} ELSE d1 END])[1] AS s1,
    CASE WHEN must_go THEN d2 ELSE list_sort([d2,
      {{'c': s0.c + more + CASE r WHEN 'u' THEN 0 ELSE 2 END, 'a': s0.a || CASE r WHEN 'u' THEN 'K' ELSE 'R' END}},
      {{'c': s1.c + more + CASE r WHEN 'u' THEN 0 ELSE 2 END, 'a': s1.a || CASE r WHEN 'u' THEN 'K' ELSE 'R' END}},
      {{'c': e3.c + more + CASE r WHEN 'u' THEN 0 ELSE 2 END, 'a': e3.a || CASE r WHEN 'u' THEN 'K' ELSE 'R' END}}])[1]
    END AS s2,
    CASE WHEN must_go THEN d3 ELSE list_sort([d3,
      {{'c': e2.c + more + CASE r WHEN 'a' THEN 0 ELSE 2 END, 'a': e2.a || CASE r WHEN 'a' THEN 'K' ELSE 'R' END}}])[1]
    END AS s3
  FROM (
    SELECT *, {{'c': s0.c + 3, 'a': s0.a || 'D'}} AS d0, {{'c': s1.c + 3, 'a': s1.a || 'D'}} AS d1,
      {{'c': e2.c + 3, 'a': e2.a || 'D'}} AS d2, {{'c': e3.c + 3, 'a': e3.a || 'D'}} AS d3
    FROM (
      SELECT *, list_sort([s3, {{'c': e2.c + 2, 'a': e2.a || 'I'}}])[1] AS e3
      FROM (
        SELECT s.conv_id, s.n, s.i + 1 AS i, s0, s1, s3, x.r, x.must_go, x.more,
          list_sort([s2, {{'c': s0.c + 2, 'a': s0.a || 'I'}}, {{'c': s1.c + 2, 'a': s1.a || 'I'}},
            {{'c': s3.c + 2, 'a': s3.a || 'I'}}])[1] AS e2
        FROM steps s JOIN rows_ x ON x.conv_id IS NOT DISTINCT FROM s.conv_id AND x.i = s.i + 1) p) q) z),
best AS (
  SELECT conv_id, list_sort([s0, s3, {{'c': s2.c + 2, 'a': s2.a || 'I'}}, {{'c': s1.c + 4, 'a': s1.a || 'II'}},
    {{'c': s0.c + 4, 'a': s0.a || 'II'}}])[1] AS b
  FROM steps WHERE i = n),
edits AS (
  SELECT conv_id, unnest(string_split(b.a, '')) AS e, generate_subscripts(string_split(b.a, ''), 1) AS p FROM best),
counted AS (
  SELECT *, sum(CAST(e <> 'I' AS INT)) OVER w AS i, sum(CAST(e <> 'D' AS INT)) OVER w AS q
  FROM edits WHERE e <> '' WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
kept AS (
  SELECT c.conv_id, c.p, c.e, c.q, x.role, x.text, x.r,
    first_value(CASE WHEN c.e = 'K' AND x.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY c.conv_id ORDER BY c.p) AS lead_s
  FROM counted c LEFT JOIN rows_ x ON x.conv_id IS NOT DISTINCT FROM c.conv_id AND x.i = c.i AND c.e <> 'I'
  WHERE c.e <> 'D'),
said AS (
  SELECT conv_id, string_agg(
    CASE e WHEN 'K' THEN role ELSE CASE (q - lead_s) % 2 WHEN 1 THEN 'user' ELSE 'assistant' END END
      || ':' || CASE e WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS said
  FROM kept GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.c, 0) AS BIGINT) AS cost,
  coalesce(b.a, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN said ON said.conv_id IS NOT DISTINCT FROM o.conv_id
"""

ORACLE_SQL = {
    "op1_segment_topk": _OP1, "op4_chat_format": _OP4, "op5_line_dedup": _OP5,
    "op9_quality": quality_sql.query(), "op12_conversation_repair": _OP12,
}
