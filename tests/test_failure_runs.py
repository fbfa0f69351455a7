"""Mergeable summaries of a URL's attempts, in batch and as a stream."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textloom.operators import failures as O
from textloom.streaming import failures as S
from textloom.streaming import pages as P

LOG = "fetch_id long, url string, status int, exception string"
BUDGET = 3


def naive(rows, budget):
    """Failures at once and first spent budgets, row by row."""
    run, spent, out = Counter(), set(), set()
    for _, url, status, exception in sorted(rows, key=lambda r: r[0]):
        code = exception or str(status)
        retry = exception == "TimeoutError" or (exception is None and status in (503, 429))
        run[url] = run[url] + 1 if retry else 0
        if exception is None and status == 404:
            out.add((url, code))
        if run[url] == budget and url not in spent:
            spent.add(url)
            out.add((url, code))
    return out


def runs_of(attempts):
    """One attempt after the other, each a summary of its own."""
    found = []
    for outcome, code in attempts:
        if outcome == "retry":
            found.append(S.Runs((code,), False, 1))
        else:
            found.append(S.Runs(closed=True, codes=frozenset([code] if outcome == "fail" else [])))
    return found


def test_merging_is_associative():
    rng = random.Random(1)
    for _ in range(3_000):
        attempts = [(rng.choice(["retry", "retry", "retry", "fail", "ok"]), str(n)) for n in range(rng.randrange(1, 14))]
        parts, whole = runs_of(attempts), S.Runs()
        for part in parts:
            whole = S.merged(whole, part, BUDGET)
        while len(parts) > 1:  # Neighbours in any order of merging.
            at = rng.randrange(len(parts) - 1)
            parts[at : at + 2] = [S.merged(parts[at], parts[at + 1], BUDGET)]
        assert parts[0] == whole
        run, first = 0, None
        for outcome, code in attempts:
            run = run + 1 if outcome == "retry" else 0
            if run == BUDGET and first is None:
                first = code
        assert S.spent_code(whole, BUDGET) == first
        assert whole.codes == {c for o, c in attempts if o == "fail"}


def log_rows(n=900):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        url = rng.choice(["hot"] * 8 + [f"u{k}" for k in range(20)] + [None])
        status, exception = rng.choice([(503, None)] * 5 + [(429, None), (404, None), (200, None), (None, "TimeoutError"), (None, "TypeError")])
        rows.append((i, url, status, exception))
    return rows


@pytest.mark.parametrize("slice_rows", [1, 4, 50, 10_000])
def test_summaries_of_slices(spark, slice_rows):
    rows = log_rows(400)
    found = S.run_summaries(spark.createDataFrame(rows, LOG).repartition(5), BUDGET, slice_rows).collect()
    by_url = {}
    for r in sorted(found, key=lambda r: r.slice):
        by_url.setdefault(r.url, []).append(S.Runs(tuple(r.lead), r.closed, r.trail, r.spent, frozenset(r.codes)))
    got = set()
    for url, parts in by_url.items():
        assert len(parts) <= -(-400 // slice_rows)
        whole = S.Runs()
        for part in parts:
            whole = S.merged(whole, part, BUDGET)
        got |= {(url, code) for code in whole.codes}
        if S.spent_code(whole, BUDGET) is not None:
            got.add((url, S.spent_code(whole, BUDGET)))
    assert got == naive(rows, BUDGET)


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_micro_batches_make_no_difference(spark, tmp_path, batches):
    rows = log_rows()
    source, out = str(tmp_path / "log"), str(tmp_path / "out")
    size = -(-len(rows) // batches)
    for at in range(0, len(rows), size):
        spark.createDataFrame(rows[at : at + size], LOG).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(source)
        failed = S.all_failures_stream(stream, BUDGET - 1, slice_rows=64)
        P.write_stream(failed, out, str(tmp_path / "ckpt"), ["failed_url", "error_code"], "parquet").awaitTermination()
    got = [tuple(r) for r in spark.read.parquet(out).select("failed_url", "error_code").collect()]
    assert len(got) == len(set(got)) and set(got) == naive(rows, BUDGET)
    log = spark.createDataFrame(rows, LOG)
    assert {tuple(r) for r in O.failed_urls(log, BUDGET - 1).collect()} == set(got)


def test_a_hot_url_gives_few_rows(spark):
    """A third of the log is one URL's: its state meets one row a slice."""
    log = spark.range(90_000).select(
        F.col("id").alias("fetch_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id"))).alias("url"),
        F.lit(503).alias("status"), F.lit(None).cast("string").alias("exception"),
    )
    hot = S.run_summaries(log, 6, slice_rows=30_000).where("url = 'hot'").collect()
    assert sorted((r.slice, len(r.lead), r.trail) for r in hot) == [(n, 6, 6) for n in range(3)]


def test_null_urls_are_counted(spark):
    rows = [(n, None, 503, None) for n in range(6)] + [(9, None, 404, None), (None, "a", 404, None)]
    log = spark.createDataFrame(rows, LOG)
    assert {tuple(r) for r in O.failed_urls(log).collect()} == {(None, "503"), (None, "404"), ("a", "404")}
    assert [tuple(r) for r in O.retry_exhausted(log).collect()] == [(None, "503")]
    assert O.failed_urls(log.limit(0)).count() == 0
