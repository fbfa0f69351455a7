"""Links of pages, URL admission, and what is still to be fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.analysis import explode_structs
from textloom.functions.html import links_of
from textloom.functions.urls import canonical_url, host, path_and_query
from textloom.session import bound_batches, small_or_shuffled

#: Hosts whose rule lengths may be broadcast; more are joined by a shuffle.
BROADCAST_HOSTS = 200_000
#: Repeated URLs that may be broadcast.
BROADCAST_URLS = 500_000


def extract_links(pages: DataFrame) -> DataFrame:
    """``page_id, src_url, pos, href, dst_url, dst_canonical``, once per target and page."""
    bound_batches(pages.sparkSession)
    found = pages.select(
        "page_id", F.col("url").alias("src_url"), links_of(F.col("url"), F.col("html")).alias("l")
    )
    numbered = found.withColumn(
        "links",
        F.transform("l", lambda x, i: F.struct(i.alias("pos"), x["href"], x["dst_url"])),
    )
    links = explode_structs(numbered, "links", ["page_id", "src_url"])
    return links.withColumn("dst_canonical", canonical_url(F.col("dst_url")))


def unseen(candidates: DataFrame, seen: DataFrame, key: str = "url", seen_key: str = "url"):
    """Candidates whose URL is not among the seen ones; other columns are kept.

    An anti join: it is broadcast when the seen set is small at run time, and
    shuffled on the URL otherwise. Repeats of a seen URL meet once: the build side of
    an anti join is never split.
    """
    once = seen.select(F.col(seen_key).alias(key))
    if not once.isStreaming:
        once = once.distinct()
    return candidates.join(once, key, "left_anti")


def seen_urls(processed: DataFrame, failed: DataFrame) -> DataFrame:
    """Distinct URLs that were processed or failed."""
    return (
        processed.select("url").union(failed.select(F.col("failed_url").alias("url"))).distinct()
    )


def first_seen(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first row of each key. The limit also runs before the shuffle, so a key
    with very many rows sends at most one row per task."""
    first = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("__rank", F.row_number().over(first)).where("__rank = 1").drop("__rank")


def without_repeats(pages: DataFrame) -> DataFrame:
    """One row of each URL: that with the smallest ``page_id`` (null first), and of rows
    alike in both that with the smallest ``html``.

    Only ids and URLs are read to find the repeats. What they are is joined to the pages by
    URL, which leaves pages where they are while few URLs repeat; only rows alike in id and
    URL are shuffled, if there are any. Null URLs are no repeats of each other.
    """
    kinds = pages.select("page_id", "url").groupBy("url", "page_id").agg(F.count("*").alias("n"))
    first = kinds.groupBy("url").agg(
        F.min(F.struct("page_id", "n")).alias("first"), F.count("*").alias("ids")
    )
    repeated = first.where((F.col("ids") > 1) | (F.col("first.n") > 1)).select(
        "url", F.col("first.page_id").alias("__id"), (F.col("first.n") > 1).alias("__alike")
    )
    repeated = small_or_shuffled(repeated, "repeats", BROADCAST_URLS)
    told = pages.join(repeated, "url", "left")
    kept = told.where(F.col("__alike").isNull() | F.col("page_id").eqNullSafe(F.col("__id")))
    columns = [F.col(c) for c in pages.columns]
    if repeated.where("__alike").isEmpty():
        return kept.select(*columns)
    once = first_seen(kept.where("__alike"), "url", F.col("html"))
    rest = kept.where(F.coalesce(~F.col("__alike"), F.lit(True)))
    return rest.select(*columns).unionByName(once.select(*columns))


def within_domains(rows: DataFrame, domains: DataFrame, url: str = "url") -> DataFrame:
    """Rows whose host is one of ``domains`` (a column ``domain``) or below one, for lists
    of any length; as in ``in_domains``, no domains are no limit.

    Hosts meet domains on their own suffixes, of which each has as many as labels, so the
    plan does not grow with the list. Only distinct hosts are cut into suffixes; rows are
    joined to the hosts that are inside, and stay where they are while these are few.
    """
    listed = domains.select(F.lower("domain").alias("suffix")).where("suffix <> ''").distinct()
    listed = small_or_shuffled(listed, "domains", BROADCAST_HOSTS)
    if listed.isEmpty():
        return rows
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.array_join(F.slice(labels, n, F.size(labels)), "."),
    )
    hosts = rows.select(host(F.col(url)).alias("host")).where("host IS NOT NULL").distinct()
    inside = hosts.select("host", F.explode(suffixes).alias("suffix"))
    inside = inside.join(listed, "suffix", "left_semi").select(F.col("host").alias("__host")).distinct()
    inside = small_or_shuffled(inside, "hosts-in-domains", BROADCAST_HOSTS)
    return rows.join(inside, host(F.col(url)) == F.col("__host"), "left_semi")


# Robots rules -----------------------------------------------------------------


def _rule_parts(pattern: Column) -> tuple[Column, Column]:
    """The literal parts between the stars of a rule, and whether a final ``$`` ends it."""
    anchored = pattern.endswith("$")
    body = F.when(anchored, F.regexp_replace(pattern, r"\$$", "")).otherwise(pattern)
    return F.split(body, r"\*", -1), anchored


def _rule_matches(path: Column, parts: Column, anchored: Column) -> Column:
    """True when the parts occur in the path one after the other, the first at its start
    and the last, if the rule is anchored, at its end.

    Each part is taken at its first place behind the one before, which leaves most room for
    the rest, so nothing is tried twice: one pass over the path, however many stars.
    """
    first, last, alone = parts[0], F.element_at(parts, -1), F.size(parts) == 1
    between = F.slice(parts, 2, F.greatest(F.size(parts) - 1 - anchored.cast("int"), F.lit(0)))

    def behind(start: Column, part: Column) -> Column:
        at = F.position(part, path, start)
        return F.when((start > 0) & (at > 0), at + F.length(part)).otherwise(0)

    # Places count from 1; 0 stands for a part that was not found.
    end = F.aggregate(F.filter(between, lambda part: part != ""), F.length(first) + 1, behind)
    closed = path.endswith(last) & (F.length(path) - F.length(last) + 1 >= end)
    tail = F.when(~anchored, True).when(alone, path == first).otherwise(closed)
    return path.startswith(first) & (end > 0) & tail


def robots_admission(candidates: DataFrame, rules: DataFrame, id_column: str) -> DataFrame:
    """Candidates their host's rules allow; the longest matching rule decides, and
    an allowing one wins a tie. ``rules`` is ``host, allow, pattern``.

    A rule can match only a path that starts with its literal part, so candidates
    meet rules on (host, literal part): a candidate is repeated once per distinct
    literal length of its host, not once per rule, and a host with very many
    candidates or rules is spread over its literal parts.
    """
    parts, anchored = _rule_parts(F.col("pattern"))
    ruled = rules.where(F.col("pattern") != "").select(
        "host",
        "allow",
        "pattern",
        F.regexp_extract("pattern", r"^([^*$]*)", 1).alias("literal"),
        F.length("pattern").alias("size"),
        parts.alias("parts"),
        anchored.alias("anchored"),
    ).distinct()
    # Distinct literal lengths of a host: far fewer than its rules.
    lengths = ruled.groupBy("host").agg(F.collect_set(F.length("literal")).alias("lengths"))
    lengths = small_or_shuffled(lengths, "robots-lengths", BROADCAST_HOSTS)
    paths = candidates.select(
        id_column, host(F.col("url")).alias("host"), path_and_query(F.col("url")).alias("path")
    )
    probes = (
        paths.join(lengths, "host")
        .select(id_column, "host", "path", F.explode_outer("lengths").alias("length"))
        .where(F.col("length") <= F.length("path"))
        .withColumn("literal", F.expr("substring(path, 1, length)"))
    )
    # A rule that is all literal is decided by the join: only wildcards look at the path.
    met = probes.join(ruled, ["host", "literal"])
    matches = met.where(
        (F.col("pattern") == F.col("literal"))
        | _rule_matches(F.col("path"), F.col("parts"), F.col("anchored"))
    )
    # Longest first, allowing before refusing, as one number: an odd best allows.
    best = F.max(F.col("size") * 2 + F.col("allow").cast("int")).alias("best")
    refused = matches.groupBy(id_column).agg(best).where("best % 2 = 0").select(id_column)
    return candidates.join(refused, id_column, "left_anti")
