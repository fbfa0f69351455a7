"""Inputs the given tables do not hold, derived from them by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.urls import host
from textloom.plans.index import Index, create_index, open_index, refresh_index
from textloom.plans.items import pages_to_items
from textloom.plans.keywords import enrich_documents
from textloom.session import stash, work_path
from textloom.sources.tables import read_pages, read_table, spread, stream_source

_built: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, folder: str, name: str, build):
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def forget() -> None:
    """Build items and index again at the next use."""
    _built.clear()


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Valid items of all pages, ``doc_id, title, url, content``, written once."""

    def build() -> DataFrame:
        found = pages_to_items(read_pages(spark, folder))
        return stash(found.withColumnRenamed("page_id", "doc_id"), "items")

    return spread(_once(spark, folder, "items", build))


def index(spark: SparkSession, folder: str) -> Index:
    """Search index over the items of all pages, built once and then queried."""

    def build() -> Index:
        root = work_path(spark, "index")
        create_index(spark, root)
        refresh_index(enrich_documents(items(spark, folder)), root)
        return open_index(spark, root)

    return _once(spark, folder, "index", build)


def _log_columns(events: DataFrame) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    site = F.pmod(F.get_json_object("props", "$.k").cast("int"), F.lit(10))
    status = (
        F.when(kind == "view", 200)
        .when(kind == "click", 503)
        .when(kind == "purchase", F.when(value < 10, 404).when(value < 30, 403).otherwise(410))
        .when(
            kind == "error",
            F.when(value < 10, 500).when(value < 20, 429).when(value < 40, 408).otherwise(401),
        )
    )
    exception = F.when(
        kind == "signup", F.when(value < 5, "TypeError").otherwise("TimeoutError")
    )
    return events.select(
        F.col("event_id").alias("fetch_id"),
        F.concat(
            F.lit("https://u"), F.col("user_id").cast("string"), F.lit(".example.com/p"), site
        ).alias("url"),
        status.alias("status"),
        exception.alias("exception"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def fetch_log(spark: SparkSession, folder: str) -> DataFrame:
    """One fetch attempt per event: the URL from user and payload, the outcome from
    type and value."""
    return _log_columns(spread(read_table(spark, folder, "events")))


def fetch_log_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = read_table(spark, folder, "events").schema
    path, files = stream_source(spark, folder, "events")
    return _log_columns(spark.readStream.schema(schema).option("pathGlobFilter", files).parquet(path))


def _visited(spark: SparkSession, folder: str, kind: str, above: float) -> DataFrame:
    events = read_table(spark, folder, "events")
    hits = events.where((F.col("event_type") == kind) & (F.col("value") > above))
    pages = read_table(spark, folder, "pages").select("page_id", "url")
    return pages.join(hits, F.col("user_id") == F.col("page_id")).select("url", "event_type")


def processed_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Page URLs that some view event stands for; repeated, like lines of a file."""
    return _visited(spark, folder, "view", 40.0).select("url")


def failed_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Failures ``failed_url, error_code`` that some error event stands for."""
    return _visited(spark, folder, "error", 60.0).select(
        F.col("url").alias("failed_url"), F.lit("503").alias("error_code")
    )


def edges(spark: SparkSession, folder: str) -> DataFrame:
    """Links ``src, dst`` among all pages: three targets computed from each id."""
    pages = read_table(spark, folder, "pages").select("page_id")
    n = F.lit(pages.count())
    page = F.col("page_id")
    targets = F.array((page * 7 + 3) % n, (page * 3 + 1) % n, F.floor(page / 2).cast("long"))
    return pages.select(page.alias("src"), F.explode(targets).alias("dst"))


def robots_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules ``host, allow, pattern`` for every host of the pages."""
    patterns = [
        (False, "/de/"), (True, "/de/1"), (False, "/en/2"), (True, "/en/2"),
        (False, "/*?page="), (False, "/fr/*.html$"), (True, "/fr/9"),
    ]
    rules = F.array(
        *[
            F.struct(F.lit(allow).alias("allow"), F.lit(pattern).alias("pattern"))
            for allow, pattern in patterns
        ]
    )
    hosts = read_table(spark, folder, "pages").select(host(F.col("url")).alias("host")).distinct()
    return hosts.select("host", F.inline(rules))


def candidate_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links to judge, several per page: its own URL and others on its host."""
    root = F.regexp_extract("url", r"^[a-z]+://[^/]+", 0)
    others = [
        "/robots.txt", "/robots.txt?x=1", "/sitemap.xml", "/sfuser/me", "/connexion",
        "/inscription", "/mentions-legales", "/aide", "/faq", "/faq/more", "/infolettres",
        "/report.PDF", "/photo.jpg", "/a.zip?b=c", "/notes.txt#top",
    ]
    links = F.array(F.col("url"), *[F.concat(root, F.lit(other)) for other in others])
    pages = read_table(spark, folder, "pages")
    return pages.select("page_id", F.explode(links).alias("link"))
