"""Exact top-k inner products by multi-resolution segment statistics.

A vector cut into equal segments has a mean and a deviation in each. Two vectors' squared
distance is at least the sum over segments of length * ((mean difference)^2 + (deviation
difference)^2), and a score is (|q|^2 + |v|^2 - distance^2) / 2, so a lower bound of
distances is an upper bound of scores. Blocks of candidates pass from coarse to fine
segments; pairs whose bound cannot reach a query's k-th best score drop out, and exact
scores are computed for those that are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import stash

#: Segments per vector, coarse to fine.
LEVELS = (2, 8, 16)
QUERY_ROWS = 1024
VECTOR_ROWS = 4096
#: Blocks of vectors that one block of queries meets in a row.
SHARD_BLOCKS = 8


def whole_vectors(rows: DataFrame, id_column: str, vector: str, scale: int) -> DataFrame:
    """``id, v``: vectors as floor(scale * x). Those that are null or hold a null or
    non-finite component, and rows without an id, take no part."""
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(F.col(id_column).isNotNull() & x.isNotNull() & ~bad).select(
        F.col(id_column).cast("long").alias("id"),
        F.transform(x, lambda c: F.floor(c * scale)).alias("v"),
    )


def _blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Vectors packed into rows of up to ``rows`` vectors of one length. A block is named
    by its task and number; packing moves nothing between tasks."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                lists = part.column(1)
                lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                ends = np.cumsum(lengths)
                for length in np.unique(lengths):
                    here = np.flatnonzero(lengths == length)
                    take = (ends[here] - length)[:, None] + np.arange(length)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "length": pa.array([int(length)], pa.int32()),
                            "ids": pa.array([ids[here].astype(np.int64).tobytes()], pa.binary()),
                            "values": pa.array([flat[take].tobytes()], pa.binary()),
                        }
                    )

    return vectors.mapInArrow(pack, "length int, ids binary, values binary")


def _statistics(v: np.ndarray, segments: int) -> tuple[np.ndarray, int]:
    """Means and deviations of equal segments, side by side; vectors are padded with
    zeros, which changes no score."""
    width = -(-v.shape[1] // segments)
    padded = np.zeros((len(v), width * segments))
    padded[:, : v.shape[1]] = v
    cut = padded.reshape(len(v), segments, width)
    mean = cut.mean(axis=2)
    deviation = np.sqrt(np.maximum((cut * cut).mean(axis=2) - mean * mean, 0))
    return np.concatenate([mean, deviation], axis=1), width


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Row-wise inner products as exact whole numbers."""
    return np.einsum("ij,ij->i", q, v)


def block_top(
    query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int, floor: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The up to ``k`` best of block ``v`` for each query: query row, id, score.

    ``floor`` is each query's k-th best score so far. It is raised here, first by the
    exact scores of the ``k`` best bounds of each query.
    """
    if not q.shape[1]:
        i, j = np.nonzero(query_ids[:, None] != ids[None, :])
        return _best(i, ids[j], np.zeros(len(i), np.int64), k)
    norm_q, norm_v = (q.astype(float) ** 2).sum(1), (v.astype(float) ** 2).sum(1)
    # Rounding of bounds stays far below one part in 10^9.
    slack = 1e-9 * (norm_q[:, None] + norm_v[None, :]) + 0.5
    pairs = None
    for level in LEVELS:
        sq, width = _statistics(q, level)
        sv, _ = _statistics(v, level)
        if pairs is None:
            dots = sq @ sv.T
            bound = width * dots + slack
            bound[query_ids[:, None] == ids[None, :]] = -np.inf
            top = np.argpartition(-bound, min(k, bound.shape[1] - 1), axis=1)[:, :k]
            first = np.einsum("qd,qkd->qk", q, v[top])
            own = query_ids[:, None] == ids[top]
            if top.shape[1] == k:
                worst = np.where(own, np.iinfo(np.int64).min, first).min(axis=1)
                np.maximum(floor, worst, out=floor)
            pairs = np.nonzero((bound >= floor[:, None]) & (bound > -np.inf))
        else:
            i, j = pairs
            keep = np.zeros(len(i), bool)
            for at in range(0, len(i), 1 << 18):
                a, b = i[at : at + (1 << 18)], j[at : at + (1 << 18)]
                bound = width * np.einsum("ij,ij->i", sq[a], sv[b]) + slack[a, b]
                keep[at : at + (1 << 18)] = bound >= floor[a]
            pairs = i[keep], j[keep]
    i, j = pairs
    score = np.zeros(len(i), np.int64)
    for at in range(0, len(i), 1 << 18):
        score[at : at + (1 << 18)] = _scores(q[i[at : at + (1 << 18)]], v[j[at : at + (1 << 18)]])
    good = score >= floor[i]
    found = _best(i[good], ids[j[good]], score[good], k)
    counts = np.bincount(found[0], minlength=len(q))
    full = np.flatnonzero(counts >= k)
    if len(full):
        ends = np.cumsum(counts)
        floor[full] = np.maximum(floor[full], found[2][ends[full] - 1])
    return found


def _best(i: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int):
    order = np.lexsort((ids, -score, i))
    i, ids, score = i[order], ids[order], score[order]
    begins = np.searchsorted(i, i, side="left")
    keep = np.arange(len(i)) - begins < k
    return i[keep], ids[keep], score[keep]


def top_k(rows: DataFrame, is_query, k: int, id_column="vec_id", vector="embedding", scale=1024):
    """``query_id, rank, vec_id, score``: the ``k`` highest inner products of each query
    against all rows but its own (all, if there are fewer), ties to the smaller id.

    Queries are the rows for which ``is_query`` (a condition on ``id``) holds. Vectors that
    are null or hold a null or non-finite component take no part; vectors meet those of
    their own length only. A row's own rows are all that share its id; a repeated row is a
    candidate each time and one query. Empty tables give no rows. Components times
    ``scale`` must stay below 2^26, which keeps scores exact.

    Blocks of queries meet blocks of vectors, so memory is bounded by two blocks.
    """
    vectors = stash(whole_vectors(rows, id_column, vector, scale), "whole-vectors")
    asked = _blocks(vectors.where(is_query).distinct(), QUERY_ROWS).select(
        "length", F.col("ids").alias("q_ids"), F.col("values").alias("q")
    )
    asked = stash(asked, "query-blocks")
    held = stash(_blocks(vectors, VECTOR_ROWS), "vector-blocks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors: dict[bytes, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                length = row["length"]
                q_ids = np.frombuffer(row["q_ids"], np.int64)
                q = np.frombuffer(row["q"], np.int64).reshape(len(q_ids), length)
                ids = np.frombuffer(row["ids"], np.int64)
                v = np.frombuffer(row["values"], np.int64).reshape(len(ids), length)
                if row["q_ids"] not in floors:
                    # One block of queries at a time: a bound that is lost only costs time.
                    floors = {row["q_ids"]: np.full(len(q_ids), np.iinfo(np.int64).min)}
                i, found, score = block_top(q_ids, q, ids, v, k, floors[row["q_ids"]])
                yield pa.RecordBatch.from_pydict(
                    {"query_id": q_ids[i], "vec_id": found, "score": score}
                )

    # Every block of queries against every block of vectors: a stated query set. Blocks
    # of vectors lie in shards, and each block of queries goes to every shard once.
    slots = rows.sparkSession.sparkContext.defaultParallelism
    shards = max(2 * slots, -(-held.count() // SHARD_BLOCKS))
    placed = held.withColumn("shard", F.pmod(F.xxhash64("ids"), F.lit(shards)).cast("int"))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    met = asked.select("*", everywhere).join(placed, ["shard", "length"])
    found = met.mapInArrow(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
