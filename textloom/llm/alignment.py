"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers cut the same bytes, so every token has a byte range on each side. The
start of a token lies in exactly one token of the other side, found by ``merge_asof``
keyed by document; the union of both directions is all pairs whose ranges overlap, since
of two ranges that overlap the later start lies in the other. Where tokens of both sides
end together, a group ends.

How often two ids are linked is counted over the corpus. Links are looked up in a bounded
table of the most frequent pairs of ids; the others are joined by a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.bpe_ranks import PATTERN, read_ranks
from textloom.session import stash

#: Pairs of ids in the table that every task holds: 16 bytes each.
COMMON_PAIRS = 1 << 20
#: Characters of text worked on at a time; a longer text is worked on alone.
CHARS_AT_ONCE = 1 << 18
#: What a sentence piece writes for a blank.
_BLANK = "▁"

#: Encodes texts to lists of ids; the second part has the bytes of every id.
Encoder = tuple[Callable[[list[str]], list[list[int]]], list[bytes]]


def rank_encoder(path: str) -> Encoder:
    """Byte-level BPE of a rank file, over a blank and the text. Special tokens' strings
    are plain text."""
    ranks = read_ranks(path)
    coder = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, number in ranks.items():
        pieces[number] = piece
    return lambda texts: [coder.encode_ordinary(" " + t) for t in texts], pieces


def piece_encoder(path: str) -> Encoder:
    """A sentence-piece model, which adds the blank itself."""
    coder = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for number in range(coder.get_piece_size()):
        piece = coder.id_to_piece(number)
        byte = coder.is_byte(number)
        pieces.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace(_BLANK, " ").encode())
    return lambda texts: coder.encode(texts, num_threads=1), pieces


def _tokens(ids: list[np.ndarray], sizes: np.ndarray, base: np.ndarray) -> pd.DataFrame:
    """A row for each token of a batch: its document and byte range. Ranges of document
    ``d`` begin at ``base[d]``, so that all of a batch are in order of ``start``."""
    lengths = [len(i) for i in ids]
    number = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    size = sizes[number]
    doc = np.repeat(np.arange(len(ids)), lengths)
    end = np.cumsum(size)
    before = np.append(0, end)[np.cumsum([0, *lengths[:-1]])] if ids else np.zeros(0, np.int64)
    end = end + np.repeat(base - before, lengths)
    return pd.DataFrame(
        {"doc": doc, "start": end - size, "end": end, "id": number, "token": np.arange(len(number))}
    )


def _distinct(ordered: np.ndarray) -> np.ndarray:
    """The different numbers of an array in order. ``np.unique`` would hash and sort them."""
    return ordered[np.append(True, ordered[1:] != ordered[:-1])] if len(ordered) else ordered


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all pairs whose ranges overlap, each pair once, in order."""

    def covering(one: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        return pd.merge_asof(
            one[["doc", "start", "token"]], other[["doc", "start", "token"]],
            on="start", by="doc", suffixes=("", "_other"),
        )

    from_a, from_b = covering(a, b), covering(b, a)
    width = np.int64(max(1, len(b)))
    pairs = np.concatenate(
        [
            from_a["token"].to_numpy(np.int64) * width + from_a["token_other"].to_numpy(np.int64),
            from_b["token_other"].to_numpy(np.int64) * width + from_b["token"].to_numpy(np.int64),
        ]
    )
    # Two runs in order, which a stable sort merges.
    pairs = _distinct(np.sort(pairs, kind="stable"))
    token_a = pairs // width
    return token_a, pairs - token_a * width


def _in_groups(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The group of every token of each side, and the document of every group. Both sides
    of a document end together, so groups never reach over documents."""
    end_a, end_b = a["end"].to_numpy(), b["end"].to_numpy()
    # Ends are in order on each side.
    at = np.minimum(np.searchsorted(end_b, end_a), max(0, len(end_b) - 1))
    both = _distinct(end_a[end_b[at] == end_a])
    group_a = np.searchsorted(both, end_a)
    group_b = np.searchsorted(both, end_b)
    doc = np.zeros(len(both), np.int64)
    doc[group_a] = a["doc"].to_numpy()
    return group_a, group_b, doc


def _written(
    a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, names: tuple[list[str], list[str]]
) -> list[str]:
    """Each token's id with the sign after it, in the order ``a1,a2|b1;a3|b2``."""
    group = np.concatenate([group_a, group_b])
    order = np.argsort(group * 2 + np.repeat([0, 1], [len(a), len(b)]), kind="stable")
    last_a = np.append(np.diff(group_a) != 0, True) if len(a) else np.zeros(0, bool)
    last_b = np.append(np.diff(group_b) != 0, True) if len(b) else np.zeros(0, bool)
    code = np.concatenate([a * 2 + last_a, b * 2 + last_b + len(names[0])])[order]
    table = names[0] + names[1]
    return list(map(table.__getitem__, code.tolist()))


_ROW = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "pair array<long>, n array<int>"
)


def _aligned(texts: list[str], one: Encoder, two: Encoder, sizes, names) -> list[dict]:
    """Counts, groups and links of a few texts."""
    empty = {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups": "", "pair": [], "n": []}
    rows = [dict(empty) for _ in texts]
    coded = []
    for side in (one, two):
        encode, pieces = side
        coded.append((encode(texts), pieces))
    used, ids = [], ([], [])
    for at, text in enumerate(texts):
        said = (" " + text).encode("utf-8")
        found = [c[0][at] for c in coded]
        # Texts that either side does not give back byte for byte have no tokens.
        if text and all(b"".join(map(c[1].__getitem__, f)) == said for c, f in zip(coded, found)):
            used.append(at)
            for side, f in zip(ids, found):
                side.append(np.array(f, np.int64))
    if not used:
        return rows
    total = np.array([sizes[0][i].sum() for i in ids[0]])
    base = np.cumsum(total) - total
    a, b = _tokens(ids[0], sizes[0], base), _tokens(ids[1], sizes[1], base)
    link_a, link_b = overlaps(a, b)
    id_a, id_b, doc_a, doc_b = (t[c].to_numpy() for c in ("id", "doc") for t in (a, b))
    group_a, group_b, doc_of = _in_groups(a, b)
    said = _written(id_a, id_b, group_a, group_b, names)
    count = len(used)
    n_a, n_b = np.bincount(doc_a, minlength=count), np.bincount(doc_b, minlength=count)
    n_groups = np.bincount(doc_of, minlength=count)
    n_links = np.bincount(doc_a[link_a], minlength=count)
    pair = id_a[link_a] * len(two[1]) + id_b[link_b]
    words, links = np.cumsum(n_a + n_b), np.cumsum(n_links)
    for n, at in enumerate(used):
        kinds, times = np.unique(pair[links[n] - n_links[n] : links[n]], return_counts=True)
        # The last token has the sign of a following group.
        groups = "".join(said[words[n] - n_a[n] - n_b[n] : words[n]])[:-1]
        rows[at] = {
            "n_a": int(n_a[n]), "n_b": int(n_b[n]), "n_groups": int(n_groups[n]),
            "n_links": int(n_links[n]), "groups": groups, "pair": kinds, "n": times.astype(np.int32),
        }
    return rows


def _few(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHARS_AT_ONCE`` characters in all."""
    first = chars = 0
    for at, text in enumerate(texts):
        if at > first and chars + len(text) > CHARS_AT_ONCE:
            yield first, at
            first, chars = at, 0
        chars += len(text)
    if first < len(texts):
        yield first, len(texts)


def align_documents(
    docs: DataFrame, encoders: tuple[Callable[[], Encoder], Callable[[], Encoder]], digest: bool = False
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups, pair, n`` of every row of ``docs``
    (``doc_id, text``): ``groups`` is written ``a1,a2|b1;a3|b2`` (or is its SHA-256 if
    ``digest``), ``pair`` holds the distinct linked pairs of ids as
    ``a * (ids of B) + b`` and ``n`` how often each is linked. Texts are not shuffled.

    A text that is null or empty, or that either side does not give back byte for byte,
    has no tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = encoders[0](), encoders[1]()
        sizes = [np.array([len(p) for p in side[1]], np.int64) for side in (one, two)]
        names = tuple(
            [f"{i}{sign}" for i in range(len(side[1])) for sign in signs]
            for side, signs in ((one, (",", "|")), (two, (",", ";")))
        )
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for first, last in _few(texts):
                rows = _aligned(texts[first:last], one, two, sizes, names)
                if digest:
                    for r in rows:
                        r["groups"] = hashlib.sha256(r["groups"].encode()).hexdigest() if r["n_a"] else ""
                columns = [batch.column("doc_id").slice(first, last - first)]
                columns += [pa.array([r[c] for r in rows], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
                columns.append(pa.array([r["groups"] for r in rows], pa.string()))
                columns.append(pa.array([r["pair"] for r in rows], pa.list_(pa.int64())))
                columns.append(pa.array([r["n"] for r in rows], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pair", "n"]
                )

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(run, _ROW)


def pair_counts(aligned: DataFrame, ids_of_b: int) -> DataFrame:
    """``pair, total, best``: links of each pair of ids in the corpus, and whether the id
    of B has no pair with more."""
    links = aligned.select(F.inline(F.arrays_zip("pair", "n")))
    totals = stash(links.groupBy("pair").agg(F.sum("n").alias("total")), "align-totals")
    b = F.pmod("pair", F.lit(ids_of_b))
    most = totals.groupBy(b.alias("b")).agg(F.max("total").alias("most"))
    known = totals.withColumn("b", b).join(most, "b")
    return known.select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def _serialized(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _frequent(counts: DataFrame, most: int) -> pa.Table:
    """The most frequent pairs, at most ``most``: all from the least count on that allows
    it, found by a histogram of counts, eight classes to a doubling, so nothing is sorted."""
    of = F.floor(F.log2(F.col("total").cast("double")) * 8).cast("int")
    sizes = counts.groupBy(of.alias("class")).count().collect()
    least, held = None, 0
    for row in sorted(sizes, reverse=True):
        held += row["count"]
        if held > most:
            break
        least = row["class"]
    return counts.where(of >= least if least is not None else F.lit(False)).toArrow()


def with_link_counts(aligned: DataFrame, counts: DataFrame, common: int = COMMON_PAIRS) -> DataFrame:
    """``row, n_best, count_sum`` of every row of ``aligned``: how many of its links are of
    a best pair, and the corpus-wide counts of all its links, summed.

    The ``common`` most frequent pairs are looked up in a table that tasks hold; links of
    all other pairs are joined. Rare pairs are in few rows, so that join has no hot key.
    """
    table = aligned.sparkSession.sparkContext.broadcast(_serialized(_frequent(counts, common)))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.ipc.open_stream(table.value).read_all()
        pairs = held.column("pair").to_numpy()
        order = np.argsort(pairs)
        pairs, total = pairs[order], held.column("total").to_numpy()[order]
        best = held.column("best").to_numpy()[order]
        for batch in batches:
            lists = batch.column("pair")
            offsets = lists.offsets.to_numpy()
            pair = lists.flatten().to_numpy(zero_copy_only=False)
            n = batch.column("n").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            at = np.minimum(np.searchsorted(pairs, pair), max(0, len(pairs) - 1))
            found = pairs[at] == pair if len(pairs) else np.zeros(len(pair), bool)
            hit, where, said = at[found], doc[found], n[found]
            # Sums of long numbers: exact, unlike sums weighted by bincount.
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], where, said * best[hit])
            np.add.at(sums[1], where, said * total[hit])
            rest, of = pair[~found], np.bincount(doc[~found], minlength=batch.num_rows)
            ends = pa.array(np.append(0, np.cumsum(of)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), *[pa.array(s) for s in sums],
                    pa.ListArray.from_arrays(ends, pa.array(rest)),
                    pa.ListArray.from_arrays(ends, pa.array(n[~found].astype(np.int32))),
                ],
                ["row", "n_best", "count_sum", "pair", "n"],
            )

    looked = stash(
        aligned.select("row", "pair", "n").mapInArrow(
            look_up, "row long, n_best long, count_sum long, pair array<long>, n array<int>"
        ),
        "align-looked-up",
    )
    rest = looked.select("row", F.inline(F.arrays_zip("pair", "n"))).join(counts.hint("merge"), "pair")
    times = F.col("n").cast("long")
    sums = rest.select("row", F.when(F.col("best"), times).otherwise(0).alias("n_best"), (times * F.col("total")).alias("count_sum"))
    both = looked.select("row", "n_best", "count_sum").unionByName(sums)
    return both.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def aligned_corpus(
    docs: DataFrame, encoders: tuple[Callable[[], Encoder], Callable[[], Encoder]], ids_of_b: int,
    common: int = COMMON_PAIRS, digest: bool = False,
) -> DataFrame:
    """Every row of ``docs`` (``doc_id, text``) as ``doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum, groups``. Rows alike are rows of their own and count twice in the
    corpus; null ids stay null; an empty table gives no rows; other columns are left out.
    """
    found = align_documents(docs.select("doc_id", "text"), encoders, digest)
    # Rows are numbered as they are written: the numbers hold for what is read back.
    aligned = stash(found.withColumn("row", F.monotonically_increasing_id()), "align-rows")
    counts = stash(pair_counts(aligned, ids_of_b), "align-counts")
    sums = with_link_counts(aligned, counts, common)
    return aligned.drop("pair", "n").join(sums, "row").drop("row")
