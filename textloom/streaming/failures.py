"""Fetch outcomes as a stream: failures at once, and failures after retries.

What the attempts of a URL amount to is a summary of a stretch of them that can be merged
with that of the next stretch. So a micro-batch is summed up by URL and slice of the log
where its rows are, and a URL's state meets a row per slice, not a row per attempt.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from textloom.functions import fixed
from textloom.operators.failures import SLICE_ROWS, with_outcome

_BETWEEN, _FIELD = "\n", "\t"


def _first_in_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.drop_duplicates()


def failed_stream(log: DataFrame) -> DataFrame:
    """Distinct immediate failures ``failed_url, error_code``. Repeats inside a batch of
    rows of a task are dropped before the shuffle."""
    at_once = with_outcome(log).where(F.col("outcome") == "fail")
    failures = at_once.select(F.col("url").alias("failed_url"), "error_code")
    few = failures.mapInPandas(_first_in_batch, failures.schema)
    return few.dropDuplicates(["failed_url", "error_code"])


class Runs(NamedTuple):
    """A stretch of a URL's attempts.

    ``lead``: codes of the retryable outcomes it begins with, at most a budget of them.
    ``closed``: whether any other outcome is in it. ``trail``: how many retryable outcomes
    it ends with, at most a budget. ``spent``: the code at which a row of them that began
    inside, after another outcome, first reached the budget. ``codes``: the codes of
    failures at once.
    """

    lead: tuple[str, ...] = ()
    closed: bool = False
    trail: int = 0
    spent: str | None = None
    codes: frozenset[str] = frozenset()


def merged(left: Runs, right: Runs, budget: int) -> Runs:
    """The stretch ``left`` and, right after it, ``right``. Any grouping of a row of
    merges gives the same."""
    if not left.closed:
        lead, spent = (left.lead + right.lead)[:budget], right.spent
    else:
        # What is missing to the budget may be at the beginning of the right stretch.
        missing = budget - left.trail
        crossing = right.lead[missing - 1] if 0 < missing <= len(right.lead) else None
        lead, spent = left.lead, left.spent or crossing or right.spent
    trail = right.trail if right.closed else min(budget, left.trail + right.trail)
    return Runs(lead, left.closed or right.closed, trail, spent, left.codes | right.codes)


def spent_code(runs: Runs, budget: int) -> str | None:
    """The code at which a budget was first spent, if nothing came before the stretch."""
    return runs.lead[budget - 1] if len(runs.lead) >= budget else runs.spent


_SUMMARY = (
    "url string, slice long, lead array<string>, closed boolean, trail int, spent string, "
    "codes array<string>"
)


def _lists(owner: np.ndarray, values: np.ndarray, groups: int, names: pa.Array) -> pa.Array:
    """A list for each group of the values that are its own, in their order."""
    ends = np.append(0, np.cumsum(np.bincount(owner, minlength=groups)))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), names.take(pa.array(values)))


def _summaries(rows: pa.Table, budget: int) -> pa.RecordBatch:
    """A ``Runs`` for each URL and slice of a task's rows, by sorting and counting."""
    url = rows.column("url").combine_chunks().dictionary_encode(null_encoding="encode")
    code = rows.column("error_code").combine_chunks().dictionary_encode()
    u = url.indices.to_numpy()
    c = code.indices.fill_null(0).to_numpy(zero_copy_only=False)
    at, part = (rows.column(n).to_numpy() for n in ("fetch_id", "slice"))
    kind = rows.column("kind").to_numpy()
    order = np.lexsort((at, part, u))
    u, c, part, kind = (x[order] for x in (u, c, part, kind))
    first = np.append(True, (np.diff(u) != 0) | (np.diff(part) != 0))
    group, n = np.cumsum(first) - 1, int(first.sum())
    retry, place = kind == 1, np.arange(len(u))
    # The last other outcome up to each row, if it is in the row's group.
    start = place[first][group]
    end = np.maximum.accumulate(np.where(retry, -1, place))
    inside = end >= start
    nth = place - np.where(inside, end, start - 1)
    lead = retry & ~inside & (nth <= budget)
    last = np.append(place[first][1:], len(u)) - 1
    trail = np.where(retry[last], np.minimum(nth[last], budget), 0)
    reached = np.flatnonzero(retry & inside & (nth == budget))
    where, earliest = np.unique(group[reached], return_index=True)
    spent = np.full(n, -1)
    spent[where] = c[reached[earliest]]
    codes = code.dictionary.cast(pa.string())
    # Each code of a group once.
    wide = np.int64(max(1, len(codes)))
    failed = np.unique(group[kind == 2].astype(np.int64) * wide + c[kind == 2])
    return pa.RecordBatch.from_arrays(
        [
            url.dictionary.cast(pa.string()).take(pa.array(u[first])),
            pa.array(part[first], pa.int64()),
            _lists(group[lead], c[lead], n, codes),
            pa.array(inside[last]),
            pa.array(trail, pa.int32()),
            codes.take(pa.array(spent, pa.int64(), mask=spent < 0)),
            _lists(failed // wide, failed % wide, n, codes),
        ],
        ["url", "slice", "lead", "closed", "trail", "spent", "codes"],
    )


def run_summaries(log: DataFrame, budget: int, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``url, slice`` and the fields of ``Runs`` for every URL and slice of ``slice_rows``
    ids of a log, or of a micro-batch of it. Rows are dealt over tasks by (URL, slice), so
    the attempts of one URL are many tasks' work, and at most ``slice_rows`` of them one
    task's. Rows without an id come first.

    Only an id, a kind and the number of a code are held of a row, and sorted in its task.
    """
    kind = F.when(F.col("outcome") == "retry", 1).when(F.col("outcome") == "fail", 2).otherwise(0)
    fetch_id = F.coalesce(F.col("fetch_id").cast("long"), F.lit(-(1 << 63)))
    rows = with_outcome(log).select(
        "url", fetch_id.alias("fetch_id"), F.floor(fetch_id / slice_rows).cast("long").alias("slice"),
        kind.cast("byte").alias("kind"), F.when(kind > 0, F.col("error_code")).alias("error_code"),
    )

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            yield _summaries(pa.Table.from_batches(held), budget)

    return rows.repartition("url", "slice").mapInArrow(sum_up, _SUMMARY)


def _packed_summaries(log: DataFrame, budget: int, slice_rows: int) -> DataFrame:
    """``url, runs``: a summary as one text, which a URL's step reads at a tenth of the
    cost of six columns; ordered by slice."""
    codes = lambda c: F.array_join(c, _BETWEEN)
    part = F.lpad(F.hex(F.col("slice").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    fields = [
        part, codes("lead"), F.col("closed").cast("int").cast("string"), F.col("trail").cast("string"),
        F.coalesce("spent", F.lit("")), codes("codes"),
    ]
    return run_summaries(log, budget, slice_rows).select("url", F.concat_ws(_FIELD, *fields).alias("runs"))


def _read(packed: str) -> Runs:
    _, lead, closed, trail, spent, codes = packed.split(_FIELD)
    return Runs(tuple(_unpacked(lead)), closed == "1", int(trail), spent or None, frozenset(_unpacked(codes)))


_FAILED = "failed_url string, error_code string, cause string"
#: ``Runs`` of all attempts so far, its codes as text.
_STATE = "lead string, closed boolean, trail int, spent string, codes string"


def _packed(texts) -> str:
    return _BETWEEN.join(sorted(texts))


def _unpacked(text: str) -> list[str]:
    return text.split(_BETWEEN) if text else []


def _follow(budget: int):
    def step(
        key: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        runs = Runs()
        if state.exists:
            lead, closed, trail, spent, codes = state.get
            runs = Runs(tuple(_unpacked(lead)), closed, trail, spent or None, frozenset(_unpacked(codes)))
        before = runs
        for packed in sorted(text for batch in batches for text in batch["runs"].tolist()):
            runs = merged(runs, _read(packed), budget)
        out = [(key[0], code, "status") for code in sorted(runs.codes - before.codes)]
        spent = spent_code(runs, budget)
        if spent is not None and spent_code(before, budget) is None:
            out.append((key[0], spent, "retries"))
        state.update((_BETWEEN.join(runs.lead), runs.closed, runs.trail, runs.spent or "", _packed(runs.codes)))
        if out:
            yield pd.DataFrame(out, columns=["failed_url", "error_code", "cause"])

    return step


def _followed(log: DataFrame, max_retries: int, slice_rows: int) -> DataFrame:
    """Failures with their cause. Micro-batches follow each other in the order of
    ``fetch_id``; a URL's state is a ``Runs``: a few codes, a counter and flags."""
    budget = max_retries + 1
    return _packed_summaries(log, budget, slice_rows).groupBy("url").applyInPandasWithState(
        _follow(budget), _FAILED, _STATE, "append", GroupStateTimeout.NoTimeout
    )


def retry_budget_stream(
    log: DataFrame, max_retries: int = fixed.MAX_RETRIES, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """``failed_url, error_code`` when a URL's retryable outcomes in a row exceed the
    budget; once a URL. A null URL is one URL of its own."""
    spent = _followed(log, max_retries, slice_rows).where("cause = 'retries'")
    return spent.select("failed_url", "error_code")


def all_failures_stream(
    log: DataFrame, max_retries: int = fixed.MAX_RETRIES, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """``failed_url, error_code``: failures at once, each code of a URL once, and the
    first spent budget of a URL, as one stream. A null URL is one URL of its own."""
    return _followed(log, max_retries, slice_rows).select("failed_url", "error_code")
