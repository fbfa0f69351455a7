"""One step of a crawl: from fetched pages to the URLs to fetch next."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.urls import admitted, in_domains
from textloom.operators.links import (
    extract_links,
    first_seen,
    robots_admission,
    seen_urls,
    unseen,
    within_domains,
)
from textloom.session import stash


def crawl_step(
    pages: DataFrame,
    rules: DataFrame,
    processed: DataFrame,
    failed: DataFrame,
    depth: int = 0,
    domains: Iterable[str] | DataFrame = (),
) -> DataFrame:
    """``url, canonical, depth`` of the links of ``pages`` that are still to be fetched.

    Links are admitted by pattern, type, length and domain, taken once per canonical form
    (the first by page and place), left out if they were processed or failed, and held
    against their host's robots rules last, which is the dearest test. ``depth`` is that
    of the pages; their links lie one deeper. A long list of ``domains`` is a table with a
    column ``domain``.
    """
    url = F.col("dst_url")
    links = extract_links(pages).where(admitted(url))
    if isinstance(domains, DataFrame):
        links = within_domains(links, domains, "dst_url")
    else:
        links = links.where(in_domains(url, domains))
    once = first_seen(
        links.select("page_id", "pos", url.alias("url"), F.col("dst_canonical").alias("canonical")),
        "canonical", F.col("page_id"), F.col("pos"),
    )
    new = unseen(once, seen_urls(processed, failed))
    # The rules read the candidates twice.
    candidates = stash(new.select("url", "canonical"), "crawl-candidates")
    allowed = robots_admission(candidates, rules, "canonical")
    return allowed.withColumn("depth", F.lit(depth + 1))
