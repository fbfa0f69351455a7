"""Mixing sources to target weights with fixed-length blocks of tokens (words here).

Each source is one long row of words cut into blocks. The mix has output shards of a fixed
number of slots; how many slots of a shard a source gets is a multinomial draw. The n-th
slot of a source takes the block that a pseudorandom permutation of the source's block
numbers puts n-th, going round again once all were taken, so slots and blocks meet in one
join on (source, block).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm.common import cells_for, with_offsets, words_of
from textloom.session import stash

BLOCK_WORDS = 32
SHARDS = 64
WEIGHT_CYCLE = (3, 1, 2)
#: Swap-or-not rounds of a permutation.
ROUNDS = 24
#: Slots made from one row.
RUN = 8192


def source_targets(sizes: DataFrame, total_share: float, most_times: float) -> DataFrame:
    """``source, source_size`` (a row a source) to these with ``weight`` and ``target``.

    Sources by code point, null last, weigh 3, 1, 2, repeating, and share ``total_share``
    of all sizes. A target stops at ``most_times`` its source's size; the excess is
    reshared by weight among the others until none is above. Sources fill up in order of
    size over weight, so the number f that stop is found by one pass over that order:
    source f + 1 is the first one whose cap is above what is left by weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in WEIGHT_CYCLE])
    nth = F.row_number().over(by_name) - 1
    weighed = sizes.withColumn("weight", cycle[nth % len(WEIGHT_CYCLE)].cast("double"))
    everything = Window.partitionBy(F.lit(0))
    cap = F.col("source_size") * most_times
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = weighed.select(
        "*",
        (F.sum("source_size").over(everything) * total_share
         - F.coalesce(F.sum(cap).over(before), F.lit(0.0))).alias("left"),
        (F.sum("weight").over(everything)
         - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("of"),
    )
    stops = cap * F.col("of") <= F.col("left") * F.col("weight")
    # The first that does not stop has the largest weight left.
    first = F.max(F.when(~stops, F.struct("of", "left"))).over(everything)
    ranked = ranked.select("*", stops.alias("stops"), first.alias("first"))
    by_weight = F.col("first.left") * F.col("weight") / F.col("first.of")
    target = F.when(F.col("stops"), cap).otherwise(by_weight).cast("double")
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def _mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, size: int, salt: int) -> np.ndarray:
    """The places of ``index`` in a pseudorandom permutation of 0 .. size - 1.

    Swap-or-not rounds: an index and its mirror (key - index) share a coin, so a round
    either swaps them or not and any size is permuted onto itself.
    """
    out = index.astype(np.int64)
    seed = np.uint64(salt % (1 << 64))
    for turn in range(ROUNDS):
        turn_seed = int(_mixed(np.array([seed + np.uint64(turn)]))[0])
        mirror = (turn_seed % size - out) % size
        shared = np.maximum(out, mirror).astype(np.uint64)
        coin = _mixed(shared ^ np.uint64(turn_seed)) & np.uint64(1)
        out = np.where(coin == 1, mirror, out)
    return out


def multinomial_slots(quotas: list[int], n_shards: int, seed: int) -> np.ndarray:
    """Slots of each source (columns) in each output shard (rows of near-equal sums).

    Every shard is a multinomial draw in proportion to what the sources have left. What
    is drawn above that is drawn again among the others, so the last shard ends every
    quota exactly.
    """
    left = np.array(quotas, dtype=np.int64)
    rng = np.random.Generator(np.random.PCG64(seed))
    total = int(left.sum())
    shards = np.zeros((n_shards, len(left)), np.int64)
    for k in range(n_shards):
        wanted = total * (k + 1) // n_shards - total * k // n_shards
        while wanted:
            free = left - shards[k]
            got = np.minimum(rng.multinomial(wanted, free / free.sum()), free)
            shards[k] += got
            wanted -= int(got.sum())
        left -= shards[k]
    return shards


def mix(docs: DataFrame, total_share: float, most_times: float, seed: int = 0):
    """The mix of ``docs`` as two tables: ``rows, slots``.

    ``rows``: the documents (of whose columns ``doc_id, source, text`` are read) with
    ``size``, the number of words, ``source_size`` and ``target`` of their source, and
    ``start``, the word of their source at which they begin. Columns of these names, and
    those that begin with ``_``, are left out. ``slots``: ``shard, slot, source, block``, one row
    for each block the mix takes. A null text has no words and is never taken; nulls are
    a source of their own. An empty table gives two empty tables.
    """
    own = {"size", "source_size", "target", "start"}
    docs = docs.select(*[c for c in docs.columns if c not in own and c[0] != "_"])
    sized = docs.withColumns(
        {"size": F.size(words_of("text")).cast("long"), "_text_hash": F.xxhash64("text")}
    )
    return mix_sized(stash(sized, "mix-sizes"), total_share, most_times, seed)


def mix_sized(sized: DataFrame, total_share: float, most_times: float, seed: int = 0):
    """``mix`` of a table on disk that has ``size`` and ``_text_hash`` already."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stash(source_targets(sources, total_share, most_times), "mix-targets")
    placed = with_offsets(
        sized, ["source"], ["doc_id", "_text_hash"], F.col("size"),
        cells_for(sized.count()), "start",
    )
    known = targets.select(F.col("source").alias("_s"), "source_size", "target")
    rows = placed.join(known, F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "_text_hash")
    blocks = F.ceil(F.col("source_size") / BLOCK_WORDS)
    # The last block is short: a slot brings source_size / blocks words on average.
    quota = F.round(F.col("target") * blocks / F.col("source_size"))
    wanted = targets.where("source_size > 0").select(
        "source", blocks.cast("long").alias("blocks"),
        F.least(quota, blocks * int(most_times)).cast("long").alias("quota"),
        F.xxhash64("source", F.lit(seed)).alias("salt"),
    )
    return rows, _slots(wanted, seed)


def _slots(wanted: DataFrame, seed: int) -> DataFrame:
    """One row a slot. The driver sees a row a source and draws ``SHARDS`` counts for
    each, whatever the size of the data; tasks make the slots, ``RUN`` at a time."""
    spark = wanted.sparkSession
    sources = wanted.orderBy(F.col("source").asc_nulls_last()).collect()
    drawn = multinomial_slots([s.quota for s in sources], SHARDS, seed)
    begins = np.cumsum(drawn, axis=0) - drawn
    inside = np.cumsum(drawn, axis=1) - drawn
    counts = [
        (k, s.source, s.blocks, s.salt, int(begins[k, n]), int(drawn[k, n]), int(inside[k, n]),
         int(drawn[k].sum()))
        for k in range(len(drawn)) for n, s in enumerate(sources) if drawn[k, n]
    ]
    table = spark.createDataFrame(
        counts,
        "shard int, source string, blocks long, salt long, begin long, n long, inside long, "
        "slots long",
    )
    runs = table.withColumn(
        "run", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / RUN)))
    ).repartition(_tasks(spark, int(drawn.sum())), "shard", "source", "run")

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                tick = np.arange(r.run * RUN, min(r.n, (r.run + 1) * RUN))
                yield pd.DataFrame(
                    {
                        "shard": r.shard,
                        "slot": permuted(r.inside + tick, r.slots, seed + r.shard),
                        "source": r.source,
                        "block": permuted((r.begin + tick) % r.blocks, r.blocks, r.salt),
                    }
                )

    return runs.mapInPandas(make, "shard int, slot long, source string, block long")


def _tasks(spark: SparkSession, slots: int) -> int:
    """Given as a number, which adaptive execution does not lower: rows are few before
    slots are made of them."""
    return max(2 * spark.sparkContext.defaultParallelism, slots // (16 * RUN))


def pieces(rows: DataFrame) -> DataFrame:
    """Documents cut at the borders of blocks: a row for each block a document touches,
    with the word ``at`` of the document where the piece begins and its ``words``."""
    first = F.floor(F.col("start") / BLOCK_WORDS)
    last = F.floor((F.col("start") + F.col("size") - 1) / BLOCK_WORDS)
    cut = rows.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("start"), F.col("block") * BLOCK_WORDS)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * BLOCK_WORDS)
    return cut.withColumns({"at": begin - F.col("start"), "words": end - begin})


def taken_pieces(rows: DataFrame, slots: DataFrame) -> DataFrame:
    """Pieces of documents with the ``times`` the mix takes their block."""
    times = slots.groupBy("source", "block").agg(F.count("*").alias("times"))
    times = times.withColumn("source", F.struct("source"))
    cut = pieces(rows).withColumn("_source", F.struct("source"))
    same = (cut["_source"] == times["source"]) & (cut["block"] == times["block"])
    # A merge join: the optimizer takes pieces for as few as the documents they come from.
    return cut.join(times.hint("merge"), same).select(
        *[cut[c] for c in cut.columns if c not in ("_source", "block")],
        cut["block"], times["times"],
    )


def taken_words(rows: DataFrame, slots: DataFrame) -> DataFrame:
    """``rows`` with ``taken``: words of the document in the mix, repeats counted.

    Only offsets travel, no texts. A document is known by its source and first word.
    """
    light = rows.select("source", "start", "size")
    taken = (
        taken_pieces(light, slots)
        .groupBy(F.struct("source").alias("_s"), F.col("start").alias("_start"))
        .agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    )
    same = (F.struct("source") == F.col("_s")) & (F.col("start") == F.col("_start"))
    joined = rows.join(taken, same & (F.col("size") > 0), "left")
    return joined.drop("_s", "_start").withColumn(
        "taken", F.coalesce("taken", F.lit(0)).cast("long")
    )


def mixed_documents(docs: DataFrame, total_share: float, most_times: float, seed: int = 0):
    """Documents of the mix: ``doc_id, text, lang, source, n_chars``, which is counted anew.

    A document is there once for each time any of its blocks is taken. Its text holds the
    blocks that are taken at least that often, in order, with their own white space; it
    is unchanged where all are.
    """
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    rows, slots = mix(docs.select(*columns), total_share, most_times, seed)
    rows = stash(rows, "mix-rows")
    found = taken_pieces(rows.select("source", "start", "size"), slots)
    by_doc = found.groupBy(F.struct("source").alias("_s"), F.col("start").alias("_start")).agg(
        F.sort_array(F.collect_list(F.struct("at", "words", "times"))).alias("_pieces"),
        F.max("times").alias("_most"),
    )
    same = (F.struct("source") == F.col("_s")) & (F.col("start") == F.col("_start"))
    rows = rows.where("size > 0").join(by_doc, same)
    rows = rows.withColumn("_pass", F.explode(F.sequence(F.lit(1), F.col("_most"))))
    gap = "[ \\t\\n\\x0B\\f\\r]"
    parts = F.split(F.col("text"), f"(?<={gap})(?=[^{gap[1:]})")
    # White space before the first word is a part of its own.
    lead = F.when(F.col("text").rlike(f"^{gap}"), 2).otherwise(1)
    kept = F.filter("_pieces", lambda p: p["times"] >= F.col("_pass"))
    cut = F.array_join(
        F.flatten(F.transform(kept, lambda p: F.slice("_parts", p["at"] + lead, p["words"]))), ""
    )
    whole = F.aggregate(kept, F.lit(0).cast("long"), lambda n, p: n + p["words"]) == F.col("size")
    rows = rows.withColumn("_parts", parts)
    rows = rows.withColumn("text", F.when(whole, F.col("text")).otherwise(cut))
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(
        *columns
    )
