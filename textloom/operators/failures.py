"""Fetch outcomes: classification, retry budget, statistics.

A fetch log row is ``fetch_id, url, status, exception, ts``: one attempt, which has
a status or an exception.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import fixed


def classify_status(status: Column) -> Column:
    """fail, retry or ok. Any other error status is ok: its page is parsed."""
    return (
        F.when(status.isin(*fixed.FAIL_STATUS), "fail")
        .when(status.isin(*fixed.RETRY_STATUS), "retry")
        .otherwise("ok")
    )


def classify_exception(exception: Column) -> Column:
    """retry for network errors, ignore for anything else."""
    return F.when(exception.isin(*fixed.RETRY_EXCEPTIONS), "retry").otherwise("ignore")


def outcome(status: Column, exception: Column) -> Column:
    by_exception = F.when(exception.isNotNull(), classify_exception(exception))
    return by_exception.otherwise(classify_status(status))


def error_code(status: Column, exception: Column) -> Column:
    return F.coalesce(exception, status.cast("string"))


def with_outcome(log: DataFrame) -> DataFrame:
    status, exception = F.col("status"), F.col("exception")
    return log.withColumns(
        {"outcome": outcome(status, exception), "error_code": error_code(status, exception)}
    )


#: Log rows (by ``fetch_id``) of one slice, inside which attempts are counted first.
SLICE_ROWS = 1_000_000


def with_turns(log: DataFrame, slice_of: Column | None = None) -> DataFrame:
    """``log`` with ``turn``: the how-manieth retryable outcome in a row of its URL.

    Any other outcome ends a row of retries: the counter belongs to one request, and the
    next attempt of the URL is a new one. Attempts are in the order of ``fetch_id``.

    A URL may have very many attempts, so they are counted in slices of the log, and
    slices are put together: a slice without any other outcome hands on what came
    before plus its own attempts, any other one what follows its last such outcome.
    A null URL is one URL of its own, and a row without a number comes first.
    """
    if slice_of is None:
        slice_of = F.floor(F.col("fetch_id") / SLICE_ROWS)
    rows = with_outcome(log).withColumn("__slice", slice_of)
    rows = rows.withColumn("__ends", (F.col("outcome") != "retry").cast("int"))
    inside = Window.partitionBy("url", "__slice").orderBy("fetch_id")
    rows = rows.withColumn("__run", F.sum("__ends").over(inside))
    run = Window.partitionBy("url", "__slice", "__run").orderBy("fetch_id")
    rows = rows.withColumn("__nth", F.sum(1 - F.col("__ends")).over(run))
    slices = rows.groupBy("url", "__slice").agg(
        F.max("__run").alias("runs"), F.max_by("__nth", "fetch_id").alias("tail")
    )
    by_url = Window.partitionBy("url").orderBy("__slice")
    before = by_url.rowsBetween(Window.unboundedPreceding, -1)
    # Slices since the last one with another outcome, that one included, come before.
    block = F.sum((F.col("runs") > 0).cast("int")).over(by_url)
    slices = slices.withColumn("__block", block)
    upto = Window.partitionBy("url", "__block").orderBy("__slice")
    slices = slices.withColumn("__upto", F.sum("tail").over(upto))
    carried = slices.select(
        "url", "__slice", F.coalesce(F.last("__upto").over(before), F.lit(0)).alias("__carried")
    )
    # Null URLs and slices meet too, which plain keys would not let them.
    same = (rows["url"].eqNullSafe(carried["url"])) & (rows["__slice"].eqNullSafe(carried["__slice"]))
    turned = rows.join(carried, same).drop(carried["url"], carried["__slice"])
    turn = F.col("__nth") + F.when(F.col("__run") == 0, F.col("__carried")).otherwise(0)
    return turned.withColumn("turn", turn).drop(
        "__slice", "__ends", "__run", "__nth", "__carried"
    )


def _spent(limit: int) -> Column:
    return (F.col("outcome") == "retry") & (F.col("turn") == limit + 1)


def _failed_by_url(log: DataFrame, limit: int) -> DataFrame:
    """``url, codes, spent`` of URLs that failed: the codes of failures at once, of which
    there are few, and the code of the first spent budget. One pass, combined in tasks."""
    turned = with_turns(log).where((F.col("outcome") == "fail") | _spent(limit))
    first = F.min(F.when(_spent(limit), F.struct("fetch_id", "error_code")))
    return turned.groupBy("url").agg(
        F.collect_set(F.when(F.col("outcome") == "fail", F.col("error_code"))).alias("codes"),
        first["error_code"].alias("spent"),
    )


def retry_exhausted(log: DataFrame, limit: int = fixed.MAX_RETRIES) -> DataFrame:
    """``failed_url, error_code`` of URLs that used up a retry budget: the retryable
    outcome after ``limit`` retries in a row fails. The first one of a URL counts."""
    found = with_turns(log).where(_spent(limit)).groupBy("url").agg(
        F.min(F.struct("fetch_id", "error_code"))["error_code"].alias("error_code")
    )
    return found.select(F.col("url").alias("failed_url"), "error_code")


def distinct_failures(failures: DataFrame) -> DataFrame:
    return failures.select("failed_url", "error_code").dropDuplicates()


def failed_urls(log: DataFrame, limit: int = fixed.MAX_RETRIES) -> DataFrame:
    """Distinct failures of a log: failed at once, or out of retries."""
    spent = F.when(F.col("spent").isNotNull(), F.array("spent")).otherwise(F.array().cast("array<string>"))
    codes = F.array_union("codes", spent)
    return _failed_by_url(log, limit).select(
        F.col("url").alias("failed_url"), F.explode(codes).alias("error_code")
    )


def fetch_stats(log: DataFrame) -> DataFrame:
    """Attempts per status and exception."""
    return log.groupBy("status", "exception").agg(F.count(F.lit(1)).alias("n"))
