"""Sharding: indivisible groups put into shards of near-equal size by best-fit decreasing.

Few groups are large. Those above a thousandth of a shard are at most a thousand per
shard, whatever the input, so the driver places them one by one. All others are dealt
over cells by a hash of their key; each cell is one task that fills its own slice of what
the large groups left of every shard. Slices add up to the shards, and a cell misses its
slice by about one of its smallest groups.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import cells_for, with_offsets
from textloom.session import stash

#: A group above this part of a shard is placed by the driver.
LARGE_PART = 1000


class CapacityTree:
    """Bins by remaining capacity in a treap: insert, tightest fit and emptiest bin.

    Priorities come from the bin number, so the same bins always make the same tree.
    """

    def __init__(self) -> None:
        self._root = None

    @staticmethod
    def _merge(left, right):
        if left is None or right is None:
            return left or right
        if left[1] < right[1]:
            left[3] = CapacityTree._merge(left[3], right)
            return left
        right[2] = CapacityTree._merge(left, right[2])
        return right

    @staticmethod
    def _split(node, key):
        """Nodes below ``key`` and the rest."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], rest = CapacityTree._split(node[3], key)
            return node, rest
        rest, node[2] = CapacityTree._split(node[2], key)
        return rest, node

    def insert(self, remaining: float, number: int) -> None:
        left, right = self._split(self._root, (remaining, number))
        priority = (number * 2654435761) % 4294967296
        node = [(remaining, number), priority, None, None]
        self._root = self._merge(self._merge(left, node), right)

    def take_tightest(self, wanted: float) -> tuple[float, int] | None:
        """Removes and returns the fullest bin that still has room for ``wanted``."""
        left, right = self._split(self._root, (wanted, -1))
        if right is None:
            self._root = left
            return None
        found = right
        while found[2] is not None:
            found = found[2]
        _, after = self._split(right, (found[0][0], found[0][1] + 1))
        self._root = self._merge(left, after)
        return found[0]

    def take_emptiest(self) -> tuple[float, int]:
        node = self._root
        while node[3] is not None:
            node = node[3]
        self._root, _ = self._split(self._root, node[0])
        return node[0]


def best_fit(sizes: list[int], room: list[float]) -> tuple[list[int], list[float]]:
    """A bin for each of ``sizes`` (which descend), and what room is left in each bin.

    A size that fits nowhere goes to the emptiest bin, whose room may become negative.
    """
    tree, left, chosen = CapacityTree(), list(room), []
    for number, free in enumerate(room):
        tree.insert(free, number)
    for size in sizes:
        free, number = tree.take_tightest(size) or tree.take_emptiest()
        left[number] = free - size
        tree.insert(free - size, number)
        chosen.append(number)
    return chosen, left


def place_groups(groups: DataFrame, n_shards: int) -> DataFrame:
    """``key, bytes`` (a key once, a table on disk) to ``key, shard``.

    The capacity is the mean size, or the largest group where that is larger: groups are
    never cut. No groups give no rows.
    """
    found = groups.agg(
        F.sum("bytes").alias("total"), F.max("bytes").alias("most"), F.count("*").alias("n")
    ).first()
    total, most = found.total or 0, found.most or 0
    capacity = max(math.ceil(total / n_shards), most)
    line = capacity / LARGE_PART
    spark = groups.sparkSession
    # At most total / line, which is 1000 a shard.
    large = groups.where(F.col("bytes") > line).orderBy(F.desc("bytes"), "key").collect()
    bins, room = best_fit([g.bytes for g in large], [float(total) / n_shards] * n_shards)
    placed = spark.createDataFrame(
        [(g.key, b) for g, b in zip(large, bins)], "key string, shard int"
    )
    small = total - sum(g.bytes for g in large)
    open_room = [max(0.0, r) for r in room]
    share = [r / max(1.0, sum(open_room)) for r in open_room]

    def fill(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(["bytes", "key"], ascending=[False, True])
        whole = float(cell["bytes"].sum())
        chosen, _ = best_fit(cell["bytes"].tolist(), [whole * s for s in share])
        return pd.DataFrame({"key": cell["key"], "shard": chosen})

    if not small:
        return placed
    cell = F.pmod(F.xxhash64("key"), F.lit(cells_for(found.n)))
    rest = groups.where(F.col("bytes") <= line).withColumn("cell", cell)
    return placed.unionByName(rest.groupBy("cell").applyInPandas(fill, "key string, shard int"))


def shards_for_capacity(groups: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """The fewest shards, tried upwards from the lower bound, of at most ``capacity``
    bytes each. A group above the capacity is refused."""
    found = groups.agg(F.sum("bytes").alias("total"), F.max("bytes").alias("most")).first()
    if (found.most or 0) > capacity:
        raise ValueError(f"a group of {found.most} bytes does not fit {capacity}")
    n_shards = max(1, math.ceil((found.total or 0) / capacity))
    while True:
        placed = stash(place_groups(groups, n_shards), "shards")
        fullest = (
            groups.join(placed, "key").groupBy("shard").agg(F.sum("bytes").alias("b"))
            .agg(F.max("b")).first()[0]
        )
        if (fullest or 0) <= capacity:
            return placed, n_shards
        n_shards += 1


def shard_documents(docs: DataFrame, n_shards: int) -> DataFrame:
    """Documents with a shard (sizes near equal) and a gapless slot in it.

    Equal texts are one group and share a shard. ``size`` is the UTF-8 bytes of the text
    plus 8. A null text has size 8 and checksum 0 and groups with other nulls, not with
    empty texts. Repeated rows get a slot each; a null ``doc_id`` sorts first. Columns
    other than ``doc_id`` and ``text`` are not read. An empty table gives no rows.
    """
    bytes_of = F.encode("text", "UTF-8")
    rows = stash(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
            F.coalesce(F.crc32(bytes_of), F.lit(0)).cast("long").alias("text_crc32"),
            F.coalesce(F.sha2(bytes_of, 256), F.lit("null")).alias("key"),
        ),
        "shard-rows",
    )
    groups = stash(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "shard-groups")
    placed = stash(place_groups(groups, n_shards), "shard-places")
    sharded = rows.join(placed, "key")
    numbered = with_offsets(
        sharded, ["shard"], ["doc_id", "key"], F.lit(1), cells_for(rows.count()), "slot"
    )
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
