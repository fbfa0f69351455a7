"""Brute-force versions, and documents with odd cases."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import xxhash

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves.
CLASHING = (
    "size", "ids", "words", "key", "removed", "n_lines", "_d", "_key", "start", "target", "fp",
    "row_key", "kept", "n", "component_id", "decoded", "tokens", "block", "times", "_pieces",
)


def odd_documents(spark):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows and extra
    columns whose names clash."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    said = "one two three four five six seven eight nine ten"
    rows = [
        (1, said, "en", "a"), (1, said, "en", "a"), (2, said, "en", "a"), (3, None, "en", "a"),
        (4, "", "en", "a"), (5, " \t\n\x0b\f\r ", "de", None), (None, said + " eleven", None, "b"),
        (7, long, "en", "b"), (8, long + " tail", "en", "b"), (9, "x", None, None),
        (10, said + "\n" + said + "\nlast line of it all here", "en", "c"),
        (None, None, None, None), (11, "café É <|endoftext|> </s>[INST] \U0001f600 ü z", "fr", "c"),
    ]
    full = [(*r, len(r[1]) if r[1] is not None else None) for r in rows]
    docs = spark.createDataFrame(full, DOCUMENTS)
    return docs.selectExpr("*", *[f"'{c}' AS {c}" for c in CLASHING])


def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fingerprint(text, k):
    found = [w.encode() for w in words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    grams = [found[i : i + k] for i in range(len(found) - k + 1)] or ([found] if found else [])
    hashes = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(nodes, links):
    """Smallest node reachable, by union-find."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in nodes}


def components(texts, k, radius):
    """doc_id to (fingerprint, component), by all pairs."""
    fps = {d: fingerprint(t, k) for d, t in texts.items()}
    near = [(a, b) for a, b in combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= radius]
    found = linked(fps, near)
    return {d: (f"{fps[d]:016x}", found[d]) for d in fps}


def removed_lines(rows):
    """(doc_id, line) of lines with an earlier similar one, by all pairs of sets."""
    lines = [
        (d, i, frozenset(words(line)))
        for d, t in rows if t is not None for i, line in enumerate(t.split("\n"))
    ]
    first, gone = {}, set()
    for d, i, s in sorted((x for x in lines if x[2]), key=lambda x: x[:2]):
        if s in first:
            if first[s] != (d, i):
                gone.add((d, i))
        else:
            first[s] = (d, i)
    for (s, at), (u, to) in combinations(first.items(), 2):
        if 5 * len(s & u) >= 4 * len(s | u):
            gone.add(max(at, to))
    return gone


def statistics(text):
    found = words(text)
    grams = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    times, marked = Counter(grams), set()
    for i, g in enumerate(grams):
        if times[g] > 1:
            marked.update((i, i + 1, i + 2))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    n = len(found)
    return (
        n, sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(marked),
        n < 50 or 100 * len(marked) > 50 * n,
    )


def targets(sizes, share=1.5, most=2.0):
    """Targets by source, by resharing until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, stopped = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in stopped)
        free = [s for s in order if s not in stopped]
        now = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if now[s] > most * sizes[s]}
        if not above:
            return now | {s: most * sizes[s] for s in stopped}
        stopped |= above


def top(vectors, k):
    """(query, rank) to (id, score) from ``[(id, list or None)]``."""
    whole = {
        i: [int(np.floor(1024 * float(x))) for x in v]
        for i, v in vectors
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    }
    out = {}
    for q in (i for i in whole if i % 100 == 0):
        scores = sorted(
            (-sum(a * b for a, b in zip(whole[q], v)), i)
            for i, v in whole.items() if i != q and len(v) == len(whole[q])
        )
        out |= {(q, r + 1): (i, -s) for r, (s, i) in enumerate(scores[:k])}
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(text):
    return zlib.crc32((text or "").encode())


def by(rows, key, value):
    out = defaultdict(list)
    for r in rows:
        out[key(r)].append(value(r))
    return out
