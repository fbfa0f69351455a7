"""SimHash near-duplicates, compared bit-sliced.

Two fingerprints within ``radius`` bits agree in ``parts - radius`` of ``parts`` bit
ranges, so candidates meet in buckets keyed by each choice of that many ranges. Inside a
bucket the bits of many fingerprints are stored as vertical planes: one word operation
works on 64 distances. Carry-save adders count differing bits eight planes at a time, and
a block is abandoned as soon as every distance is beyond the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.components import components
from textloom.session import stash

BITS = 64
#: Fingerprints of a bucket compared in one task; larger buckets are cut into blocks
#: of about this many, and every pair of blocks is a task of its own.
BLOCK = 4096
_LANES = np.uint64(0x0101010101010101)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


# --- fingerprints -------------------------------------------------------------------


def shingle_hashes(text: bytes | None, words: int) -> list[int]:
    """XXH64 (seed 42) of every shingle, repeats included, A-Z in lower case.

    ``bytes.split`` cuts at exactly space, tab, line feed, vertical tab, form feed and
    carriage return. Fewer words than a shingle make one shingle; none make none.
    """
    found = (text or b"").lower().split()
    digest = xxhash.xxh64_intdigest
    if len(found) < words:
        return [digest(b" ".join(found), 42)] if found else []
    parts = [found[i:] for i in range(words)]
    return [digest(b" ".join(gram), 42) for gram in zip(*parts)]


def majority_bits(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each run of ``hashes`` the word whose bits are set in over half of it; 0 if empty.

    Bits are added as eight byte lanes of a word, in runs of at most 255 words, so no
    lane overflows.
    """
    out = np.zeros(len(lengths), dtype=np.uint64)
    full = np.flatnonzero(lengths)
    if not len(full):
        return out
    sizes = lengths[full]
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    pieces = -(-sizes // 255)
    first = np.concatenate(([0], np.cumsum(pieces)[:-1]))
    nth = np.arange(pieces.sum()) - np.repeat(first, pieces)
    starts = np.repeat(begins, pieces) + 255 * nth
    for low in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(low)) & _LANES, starts)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first)
        most = (2 * counts > sizes[:, None]).astype(np.uint64)
        for byte in range(8):
            out[full] |= most[:, byte] << np.uint64(8 * byte + low)
    return out


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, fp``: the fingerprint as a signed long. Null and empty texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, lengths, done = [], [], []
            pending = 0
            for text in batch.column("text").to_pylist():
                found = shingle_hashes(text, words)
                hashes.extend(found)
                lengths.append(len(found))
                pending += len(found)
                if pending > 1 << 20:
                    done.append(majority_bits(np.array(hashes, np.uint64), np.array(lengths)))
                    hashes, lengths, pending = [], [], 0
            done.append(majority_bits(np.array(hashes, np.uint64), np.array(lengths, np.int64)))
            fps = np.concatenate(done).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(fps)], names=["doc_id", "fp"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


# --- bit-sliced distances -----------------------------------------------------------


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """Plane b holds bit b of every fingerprint, 64 fingerprints to a word."""
    padded = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    padded[: len(fps)] = fps
    rows = [
        np.packbits(((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), bitorder="little")
        for b in range(BITS)
    ]
    return np.stack(rows).view(np.uint64)


def _add(a, b, c):
    """Carry-save adder: carries and sums of three planes."""
    half = a ^ b
    return (a & b) | (half & c), half ^ c


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count (lowest bit first in ``counters``) is above ``radius``."""
    above, equal = np.zeros_like(counters[0]), np.full_like(counters[0], _ALL)
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            equal = equal & counters[k]
        else:
            above = above | (equal & counters[k])
            equal = equal & ~counters[k]
    return above


def far_lanes(planes: Iterator[np.ndarray], radius: int) -> np.ndarray:
    """A bit for each lane whose distance is above ``radius``; ``planes`` gives 64 planes
    of differing bits and is read no further once every lane is beyond."""
    counters: list[np.ndarray] = []
    far = None
    for _ in range(BITS // 8):
        p = [next(planes) for _ in range(8)]
        if not counters:
            counters = [np.zeros_like(p[0]) for _ in range(7)]
        one, two, four = counters[:3]
        two_a, one = _add(one, p[0], p[1])
        two_b, one = _add(one, p[2], p[3])
        four_a, two = _add(two, two_a, two_b)
        two_a, one = _add(one, p[4], p[5])
        two_b, one = _add(one, p[6], p[7])
        four_b, two = _add(two, two_a, two_b)
        carry, four = _add(four, four_a, four_b)
        counters[:3] = one, two, four
        for k in range(3, 7):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        far = _above(counters, radius)
        if (far == _ALL).all():
            break
    return far


def near_pairs(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (left, right) of fingerprints at most ``radius`` bits apart."""
    planes = bit_planes(right)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(0, len(left), 64):
        some = left[at : at + 64]
        # 0 - 1 is all ones: a query bit becomes a word of that bit.
        masks = [np.uint64(0) - ((some >> np.uint64(b)) & np.uint64(1)) for b in range(BITS)]
        far = far_lanes((masks[b][:, None] ^ planes[b][None, :] for b in range(BITS)), radius)
        if (far == _ALL).all():
            continue
        near = np.unpackbits((~far).view(np.uint8), axis=1, bitorder="little")[:, : len(right)]
        i, j = np.nonzero(near)
        found.append((i + at, j))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def near_of_lists(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Which of the pairs ``a[i], b[i]`` are near, 64 pairs to a word."""
    planes = bit_planes(a ^ b)
    far = far_lanes(iter(planes), radius)
    return ~np.unpackbits(far.view(np.uint8), bitorder="little")[: len(a)].astype(bool)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most ``n`` links that connect what the links ``i, j`` connect."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


# --- buckets ------------------------------------------------------------------------


def _links_of_run(fps: np.ndarray, side: np.ndarray, radius: int):
    """Links inside a block, or between two blocks where both sides are there."""
    if side.any():
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        i, j = near_pairs(fps[left], fps[right], radius)
        i, j = left[i], right[j]
    else:
        i, j = near_pairs(fps, fps, radius)
        i, j = i[i < j], j[i < j]
    if len(i) > 2 * len(fps):
        i, j = forest(len(fps), i, j)
    return fps[i], fps[j]


def _compare(radius: int):
    keys = ["choice", "bits", "low", "high"]

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        fps = pdf["fp"].to_numpy().view(np.uint64)
        side = pdf["side"].to_numpy()
        new = np.ones(len(pdf), bool)
        new[1:] = (pdf[keys].to_numpy()[1:] != pdf[keys].to_numpy()[:-1]).any(axis=1)
        bounds = np.append(np.flatnonzero(new), len(pdf))
        sizes = np.diff(bounds)
        out_a, out_b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        # Runs of up to 16 share their words: lane = one pair at the same offset.
        run_of = np.repeat(sizes, sizes)
        end_of = np.repeat(bounds[1:], sizes)
        at = np.arange(len(pdf))
        for step in range(1, 16):
            i = np.flatnonzero((run_of <= 16) & (at + step < end_of))
            if not len(i):
                break
            near = near_of_lists(fps[i], fps[i + step], radius)
            near &= (side[i] != side[i + step]) | (pdf["low"] == pdf["high"]).to_numpy()[i]
            out_a.append(fps[i[near]])
            out_b.append(fps[i[near] + step])
        for begin, end in pairwise(bounds):
            if end - begin > 16:
                a, b = _links_of_run(fps[begin:end], side[begin:end], radius)
                out_a.append(a)
                out_b.append(b)
        a, b = np.concatenate(out_a), np.concatenate(out_b)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by bucket; the last bucket of a batch waits for the next.
        Buckets are blocks of about ``BLOCK`` rows, so what waits is bounded."""
        held = None
        for batch in batches:
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = batch[keys].iloc[-1]
            tail = (batch[keys] == last).all(axis=1).to_numpy()
            cut = len(batch) - int(tail[::-1].argmin()) if not tail.all() else 0
            if cut:
                yield links(batch.iloc[:cut].reset_index(drop=True))
            held = batch.iloc[cut:].reset_index(drop=True)
        if held is not None and len(held):
            yield links(held)

    return run


def near_links(distinct: DataFrame, radius: int, parts: int) -> DataFrame:
    """``fp`` (each once) to links ``a, b``: enough of the pairs within ``radius`` that
    everything they connect stays connected."""
    width = BITS // parts
    ranges = [
        ((1 << (BITS if p == parts - 1 else (p + 1) * width)) - 1) & ~((1 << (p * width)) - 1)
        for p in range(parts)
    ]
    masks = [sum(chosen) for chosen in combinations(ranges, parts - radius)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    choices = F.array(
        *[
            F.struct(F.lit(n).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits"))
            for n, m in enumerate(signed)
        ]
    )
    keyed = distinct.select("fp", F.explode(choices).alias("c")).select("fp", "c.*")
    crowded = keyed.groupBy("choice", "bits").agg(F.count("*").alias("n")).where("n > 1")
    # A merge join: the optimizer takes the keys for as few as the fingerprints.
    met = keyed.join(crowded.hint("merge"), ["choice", "bits"])
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    met = met.select("choice", "bits", "fp", own.alias("own"), blocks.alias("blocks"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select(
        "choice", "bits",
        F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "fp",
    )
    sorted_rows = met.repartition("choice", "bits", "low", "high").sortWithinPartitions(
        "choice", "bits", "low", "high", "side"
    )
    return sorted_rows.mapInPandas(_compare(radius), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, radius: int = 3, parts: int = 5) -> DataFrame:
    """``doc_id, fp, component_id``, a row for every row of ``docs``.

    Fingerprints at most ``radius`` bits apart are linked and ``component_id`` is the
    smallest ``doc_id`` reachable over links, its own included. Equal fingerprints meet
    once, so copies cost nothing. Texts without words (null, empty, blank) have
    fingerprint 0 and are linked like any other. A null ``doc_id`` stays, and counts in
    no minimum; repeated rows stay. An empty table gives no rows.
    """
    rows = stash(fingerprints(docs, words), "fingerprints")
    distinct = stash(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fps")
    links = stash(near_links(distinct.select("fp"), radius, parts), "fp-links")
    found = components(links)
    rooted = distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = stash(rooted, "fp-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id")


def fingerprint_text(fp) -> Column:
    """16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def without_near_duplicates(docs: DataFrame, words: int, radius: int, parts: int) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is the smallest of its group.

    Of a group without any ``doc_id``, and of repeated rows with that id, one row stays.
    """
    found = near_duplicates(docs, words, radius, parts)
    keep = found.where("doc_id <=> component_id").select(F.struct("doc_id").alias("_keep")).distinct()
    # A row number among equal ids needs no text: ids meet, then one row of each is taken.
    kept = docs.join(keep, F.struct("doc_id") == F.col("_keep"), "left_semi")
    return kept.dropDuplicates(["doc_id"])
