"""Repair of conversations by cheapest edits, with block tables.

A conversation is a string of symbols, one a row: what the row's role begins with and
whether the row has a fault. The least cost of repairing a suffix of it, from each of the
four states a repaired conversation can be in, is a vector; once its least entry is taken
off, only a handful of vectors occur. So all transitions are worked out beforehand, for
every such vector and every block of ``BLOCK`` symbols, and a conversation is read block
by block, from its end to its beginning, by lookup alone. Then blocks are expanded one by
one against that direction, which runs forward through the conversation: at each step the
first edit in ASCII order among those of least cost is taken, so ties need no comparing
of whole edit strings.

Long conversations are cut into segments of a sorted table. A segment is summed up by
what it does to every vector and every state, so segments are worked on side by side and
only their summaries are gone through in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from textloom.llm.common import WORD
from textloom.session import stash

#: Symbols of a block.
BLOCK = 4
#: Rows and characters of a segment.
SEGMENT_ROWS, SEGMENT_CHARS = 4_096, 1 << 20
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# States: nothing yet, after s, after u, after a. Nothing and after a may end.
_START, _AFTER_S, _AFTER_U, _AFTER_A = range(4)
#: State after the role that must or may come next, other than a first s.
_NEXT = (_AFTER_U, _AFTER_U, _AFTER_A, _AFTER_U)
_ROLES = ("user", "user", "assistant", "user")
_FAR = 1 << 20

# Symbols: 0 fills a block up; 1 must be deleted; others are 2 + 2 * role + truncated,
# with role s, u, a, other.
FILL, MUST_GO = 0, 1
_INITIALS = "sua"
SYMBOLS = 10


def _kept(state: int, role: int) -> int | None:
    """The state after keeping a row of this role, if it may be kept."""
    if role == 0:
        return _AFTER_S if state == _START else None
    allowed = {1: (_START, _AFTER_S, _AFTER_A), 2: (_AFTER_U,)}.get(role, ())
    return _NEXT[state] if state in allowed else None


def _before(vector: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs to go from before a row, given those from after it."""
    if symbol == FILL:
        return vector
    least = []
    for state in range(4):
        costs = [DELETE + vector[state]]
        if symbol != MUST_GO:
            role, truncated = divmod(symbol - 2, 2)
            costs.append(REROLE + truncated * TRUNCATED + vector[_NEXT[state]])
            to = _kept(state, role)
            if to is not None:
                costs.append(truncated * TRUNCATED + vector[to])
        least.append(min(costs))
    return _closed(least)


def _closed(least: list[int]) -> tuple[int, ...]:
    """With inserts before the row: any number, each to the state that comes next."""
    for _ in range(4):
        least = [min(c, INSERT + least[_NEXT[s]]) for s, c in enumerate(least)]
    return tuple(least)


def _normal(vector: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    low = min(vector)
    return tuple(c - low for c in vector), low


class Tables(NamedTuple):
    """``vectors``: all normal vectors, the one at a conversation's end first. ``to`` and
    ``cost``, by vector and block: the vector before the block, and what was taken off."""

    vectors: list[tuple[int, ...]]
    to: np.ndarray
    cost: np.ndarray


@cache
def tables() -> Tables:
    end, low = _normal(_closed([0, _FAR, _FAR, 0]))
    assert low == 0
    vectors, number, step = [end], {end: 0}, {}
    for vector in vectors:  # Grows while it is gone through.
        for symbol in range(SYMBOLS):
            found, cost = _normal(_before(vector, symbol))
            if found not in number:
                number[found] = len(vectors)
                vectors.append(found)
            step[number[vector], symbol] = number[found], cost
    single = np.array([[step[v, s] for s in range(SYMBOLS)] for v in range(len(vectors))])
    to = np.tile(np.arange(len(vectors))[:, None], (1, 1))
    cost = np.zeros((len(vectors), 1), int)
    # A block is the number of its symbols in base SYMBOLS, the first one highest. It is
    # read from its last symbol, so each turn puts a symbol in front.
    for _ in range(BLOCK):
        steps = single[to]
        to = steps[:, :, :, 0].transpose(0, 2, 1).reshape(len(vectors), -1)
        cost = (steps[:, :, :, 1] + cost[:, :, None]).transpose(0, 2, 1).reshape(len(vectors), -1)
    return Tables(vectors, to, cost)


def blocks_of(symbols: list[int]) -> np.ndarray:
    """Numbers of the blocks of a symbol string, filled up at the end."""
    filled = np.zeros(-(-len(symbols) // BLOCK) * BLOCK, int)
    filled[: len(symbols)] = symbols
    return filled.reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))


def read_backward(blocks: np.ndarray, after: int) -> tuple[list[int], int]:
    """The vector after each block, then the one before all, and the costs taken off."""
    known, cost, vectors = tables(), 0, [after]
    for block in blocks[::-1].tolist():
        cost += int(known.cost[vectors[-1], block])
        vectors.append(int(known.to[vectors[-1], block]))
    # From the first block on: what follows each, with the vector before all put last.
    return vectors[-2::-1] + vectors[-1:], cost


def expand(symbols: list[int], after: int, state: int, ends: bool) -> tuple[str, int]:
    """The ASCII-least of the cheapest edits of these rows from ``state`` on, with
    ``after`` the vector behind them, and the state they leave. If nothing follows
    (``ends``), inserts at the very end are made too."""
    known = tables()
    vectors, _ = read_backward(blocks_of(symbols), after)
    edits = []
    for at in range(0, len(symbols), BLOCK):
        inside = symbols[at : at + BLOCK]
        # Costs to go at every place of the block, from its end.
        to_go = [known.vectors[vectors[at // BLOCK]]]
        for symbol in reversed(inside):
            to_go.append(_before(to_go[-1], symbol))
        to_go.reverse()
        for place, symbol in enumerate(inside):
            state = _edit_row(symbol, to_go[place], to_go[place + 1], state, edits)
    while ends and state not in (_START, _AFTER_A):
        edits.append("I")
        state = _NEXT[state]
    return "".join(edits), state


def _edit_row(symbol: int, here: tuple, there: tuple, state: int, edits: list[str]) -> int:
    """Edits up to and with this row; D comes before I, K and R."""
    while True:
        left = here[state]
        if DELETE + there[state] == left:
            edits.append("D")
            return state
        if INSERT + here[_NEXT[state]] == left:
            edits.append("I")
            state = _NEXT[state]
            continue
        role, truncated = divmod(symbol - 2, 2)
        to = _kept(state, role)
        if to is not None and truncated * TRUNCATED + there[to] == left:
            edits.append("K")
            return to
        edits.append("R")
        return _NEXT[state]


def repaired(audit: str, state: int, roles: list[str], texts: list[str]) -> list[tuple[str, str]]:
    """Role and text of the rows that the edits leave."""
    found, at = [], 0
    for edit in audit:
        if edit == "I":
            found.append((_ROLES[state], ""))
            state = _NEXT[state]
            continue
        role, text = roles[at], texts[at]
        at += 1
        if edit == "K":
            found.append((role, text))
            state = _AFTER_S if role[:1] == "s" else _NEXT[state]
        elif edit == "R":
            found.append((_ROLES[state], text))
            state = _NEXT[state]
    return found


_CONV = "conv"


def flagged(turns: DataFrame) -> DataFrame:
    """Rows of ``conv_id, turn, role, text`` with their symbol: ``conv`` (a struct of the
    id, which nulls may be in), ``turn, role, text, nth`` (of rows alike), ``symbol`` and
    ``fault`` (blank, duplicate, truncated or null).

    Null roles and texts are empty. A row is a duplicate of an earlier one of its
    conversation with its role and text; rows alike are counted before they are shuffled.
    """
    rows = turns.select(
        F.struct("conv_id").alias(_CONV), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    alike = rows.groupBy(_CONV, "turn", "role", "text").agg(F.count("*").alias("n"))
    alike = alike.withColumns({"said": F.md5("text"), "place": F.struct("turn")})
    first = alike.groupBy(_CONV, "role", "said").agg(F.min("place").alias("first"))
    each = alike.join(first, [_CONV, "role", "said"]).select(
        _CONV, "turn", "role", "text", (F.col("place") == F.col("first")).alias("leads"),
        F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("nth"),
    )
    last = F.regexp_extract("text", f"(?s).*({WORD[:-1]})", 1)
    fault = (
        F.when(last == "", "blank")
        .when(~F.col("leads") | (F.col("nth") > 1), "duplicate")
        .when(~last.isin(".", "!", "?"), "truncated")
    )
    role = F.call_function("instr", F.lit(_INITIALS), F.substring("role", 1, 1))
    role = F.when((F.col("role") == "") | (role == 0), len(_INITIALS)).otherwise(role - 1)
    return each.select(
        _CONV, "turn", "role", "text", "nth", fault.alias("fault"),
        F.when(fault.isin("blank", "duplicate"), MUST_GO)
        .otherwise(2 + 2 * role + F.coalesce(fault == "truncated", F.lit(False)).cast("int"))
        .cast("int").alias("symbol"),
    )


_CONV_TYPE = T.StructType([T.StructField("conv_id", T.LongType())])


def _schema(text: str) -> T.StructType:
    """``conv, part, at`` and the columns named."""
    keys = [T.StructField(_CONV, _CONV_TYPE), T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType())]
    return T.StructType([*keys, *T._parse_datatype_string(text).fields])


_COUNTED = ["blank", "duplicate", "truncated", "illegal", "turns"]
_SEGMENT = (
    "symbols array<int>, roles array<string>, texts array<string>, first_turn long, last_turn long, "
    "first_role string, last_role string, blank long, duplicate long, truncated long, illegal long, turns long"
)


def _mapped(df: DataFrame, step: Callable[[Iterator[dict]], Iterator[dict]], schema: T.StructType) -> DataFrame:
    """``step`` over the rows of each task, in order, as dictionaries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        done, size = [], 0
        for row in step(row for batch in batches for row in batch.to_pylist()):
            done.append(row)
            size += sum(len(v) for v in row.get("texts") or ())
            if len(done) == 1_000 or size > SEGMENT_CHARS:
                yield pa.RecordBatch.from_pylist(done, arrow)
                done, size = [], 0
        yield pa.RecordBatch.from_pylist(done, arrow)

    return df.mapInArrow(run, schema)


def _legal(one: str, two: str) -> bool:
    return one[:1] + two[:1] in ("su", "ua", "au")


def _segment(held: list[dict], at: int) -> dict:
    turns = [r["turn"] for r in held if r["turn"] is not None]
    roles = [r["role"] for r in held]
    faults = [r["fault"] for r in held]
    return {
        _CONV: held[0][_CONV], "part": held[0]["part"], "at": at,
        "symbols": [r["symbol"] for r in held], "roles": roles, "texts": [r["text"] for r in held],
        "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
        "first_role": roles[0][:1], "last_role": roles[-1][:1],
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(not _legal(a, b) for a, b in zip(roles, roles[1:])), "turns": len(set(turns)),
    }


def segments(rows: DataFrame, most: int = SEGMENT_ROWS) -> DataFrame:
    """Flagged rows in order, cut into segments of at most ``most`` rows and about
    ``SEGMENT_CHARS`` characters; ``(part, at)`` names a segment and is their order.

    Rows are dealt over tasks by ranges of (conversation, turn, ...), so a large
    conversation is several tasks' work. Null turns come first; rows of one turn run by
    role and text.
    """
    order = [_CONV, "turn", "role", "text", "nth"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(rows: Iterator[dict]) -> Iterator[dict]:
        held, chars, at = [], 0, 0
        for row in rows:
            full = len(held) == most or chars > SEGMENT_CHARS
            if held and (full or row[_CONV] != held[0][_CONV]):
                yield _segment(held, at)
                held, chars, at = [], 0, at + 1
            held.append(row)
            chars += len(row["text"])
        if held:
            yield _segment(held, at)

    return _mapped(ranged.withColumn("part", F.spark_partition_id()), cut, _schema(_SEGMENT))


def _summed_up(rows: Iterator[dict]) -> Iterator[dict]:
    """What a segment makes of every vector."""
    known = tables()
    for row in rows:
        vector = np.arange(len(known.vectors))
        for block in blocks_of(row["symbols"])[::-1]:
            vector = known.to[vector, block]
        yield {c: row[c] for c in (_CONV, "part", "at")} | {"to": vector.tolist()}


def _vectors_behind(rows: Iterator[dict]) -> Iterator[dict]:
    """Summaries of each conversation from its end: the vector behind every segment."""
    conv, vector = None, 0
    for row in rows:
        ends = conv is None or row[_CONV] != conv
        conv, vector = row[_CONV], 0 if ends else vector
        yield {c: row[c] for c in (_CONV, "part", "at")} | {"after": vector, "ends": ends}
        vector = row["to"][vector]


def _expanded(rows: Iterator[dict]) -> Iterator[dict]:
    """The edits of a segment from each state it can be entered in."""
    for row in rows:
        found = [expand(row["symbols"], row["after"], s, row["ends"]) for s in range(4)]
        yield {c: row[c] for c in _BESIDE} | {
            "audits": [audit for audit, _ in found], "leaves": [left for _, left in found],
            "costs": [cost_of(audit, row["symbols"]) for audit, _ in found],
        }


_BESIDE = [_CONV, "part", "at", "first_turn", "last_turn", "first_role", "last_role", *_COUNTED]


def _entered(rows: Iterator[dict]) -> Iterator[dict]:
    """Segments of each conversation from its beginning: the state each is entered in, and
    counts that do not count twice what two segments share."""
    before, state = None, _START
    for row in rows:
        if before is None or row[_CONV] != before[_CONV]:
            state = _START
        else:
            row["illegal"] += not _legal(before["last_role"], row["first_role"])
            row["turns"] -= row["first_turn"] is not None and row["first_turn"] == before["last_turn"]
        yield {c: row[c] for c in _BESIDE} | {
            "state": state, "audit": row["audits"][state], "cost": row["costs"][state]
        }
        before, state = row, row["leaves"][state]


def _written(rows: Iterator[dict]) -> Iterator[dict]:
    for row in rows:
        said = repaired(row["audit"], row["state"], row["roles"], row["texts"])
        yield {c: row[c] for c in (_CONV, "part", "at")} | {
            "roles": [role for role, _ in said], "texts": [text for _, text in said]
        }


def cost_of(audit: str, symbols: list[int]) -> int:
    cost, at = 0, 0
    for edit in audit:
        cost += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
        if edit in "KR":
            cost += TRUNCATED * (symbols[at] % 2)
        at += edit != "I"
    return cost


class Repaired(NamedTuple):
    """``faults``: a row per segment, with its edits, cost and counts; ``turns``: a row per
    segment, with the roles and texts left. Both by ``conv, part, at``."""

    faults: DataFrame
    turns: DataFrame


def repair(turns: DataFrame, segment_rows: int = SEGMENT_ROWS) -> Repaired:
    """The cheapest repair of every conversation of ``conv_id, turn, role, text``.

    Repaired conversations are empty, or have an s role if they like, then u and a roles in
    turn, ending with an a role (by the roles' first letters). Keeping a row is free, a
    new role (user or assistant) costs 2, deleting 3, a new empty row 2; blank rows and
    duplicates must go, and a truncated row that stays costs 1. Of the cheapest edits the
    ASCII-least are made.

    Nulls: a null id is a conversation of its own, null turns come first, null roles and
    texts are empty. Rows alike are duplicates but for one. Other columns are left out. An
    empty table gives no rows.
    """
    rows = stash(flagged(turns), "repair-flagged")
    segs = stash(segments(rows, segment_rows), "repair-segments")
    key, place = ["part", "at"], [F.col("part"), F.col("at")]
    sums = _mapped(segs.select(_CONV, *key, "symbols"), _summed_up, _schema("to array<int>"))
    sums = sums.repartition(_CONV).sortWithinPartitions(_CONV, *[c.desc() for c in place])
    behind = stash(_mapped(sums, _vectors_behind, _schema("after int, ends boolean")), "repair-behind")
    entered = segs.select(*_BESIDE, "symbols").join(behind.drop(_CONV), key)
    beside = "first_turn long, last_turn long, first_role string, last_role string, "
    beside += ", ".join(f"{c} long" for c in _COUNTED)
    ways = _mapped(entered, _expanded, _schema(f"{beside}, audits array<string>, leaves array<int>, costs array<long>"))
    ways = ways.repartition(_CONV).sortWithinPartitions(_CONV, *place)
    faults = stash(_mapped(ways, _entered, _schema(f"{beside}, state int, audit string, cost long")), "repair-faults")
    whole = segs.select(_CONV, *key, "roles", "texts")
    left = whole.join(faults.select(*key, "state", "audit"), key)
    return Repaired(faults, _mapped(left, _written, _schema("roles array<string>, texts array<string>")))


def repaired_turns(found: Repaired) -> DataFrame:
    """``conv_id, part, at, place, role, text``: the rows of repaired conversations; each
    conversation in order of ``part, at, place``."""
    rows = found.turns.select(_CONV, "part", "at", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "said"))
    return rows.select(
        "conv.conv_id", "part", "at", "place", F.col("said.roles").alias("role"), F.col("said.texts").alias("text")
    )


def reports(found: Repaired) -> DataFrame:
    """A row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit``. ``gaps``: turns that the numbers leave out."""
    per = found.faults.groupBy(_CONV).agg(
        *[F.sum(c).alias(c) for c in (*_COUNTED, "cost")],
        F.min("first_turn").alias("first"), F.max("last_turn").alias("last"),
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("part", "at", "audit"))), lambda x: x["audit"]), ""
        ).alias("audit"),
    )
    gaps = F.coalesce(F.col("last") - F.col("first") + 1 - F.col("turns"), F.lit(0))
    return per.select(
        "conv.conv_id", gaps.cast("long").alias("gaps"), *_COUNTED[:4], "cost", "audit"
    )


def digests(found: Repaired) -> DataFrame:
    """``conv_id, repaired_sha256`` of ``role:text`` of the rows left, joined by line feeds.
    A conversation is hashed as it streams by: no task holds one."""

    def step(rows: Iterator[dict]) -> Iterator[dict]:
        conv, hashed, some = None, None, False
        for row in rows:
            if conv is None or row[_CONV] != conv:
                if conv is not None:
                    yield {"conv_id": conv["conv_id"], "repaired_sha256": hashed.hexdigest()}
                conv, hashed, some = row[_CONV], hashlib.sha256(), False
            for role, text in zip(row["roles"], row["texts"]):
                hashed.update((("\n" if some else "") + f"{role}:{text}").encode())
                some = True
        if conv is not None:
            yield {"conv_id": conv["conv_id"], "repaired_sha256": hashed.hexdigest()}

    ordered = found.turns.repartition(_CONV).sortWithinPartitions(_CONV, "part", "at")
    return _mapped(ordered, step, T._parse_datatype_string("conv_id long, repaired_sha256 string"))
