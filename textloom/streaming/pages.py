"""Pages as a stream: extract, clean, validate, append, each URL once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from textloom.operators.extract import decoded_pages
from textloom.operators.links import unseen
from textloom.plans.items import items_of
from textloom.schemas import ITEM, PAGE
from textloom.session import path_exists, state_on_disk


def stream_pages(
    spark: SparkSession,
    folder: str,
    glob: str = "*.parquet",
    max_files: int = 100,
    spread_to: int | None = None,
) -> DataFrame:
    """Page stream over a folder new parquet files arrive in.

    ``glob`` is held against the names of files, not of folders. ``spread_to`` shares each
    micro-batch out to that many tasks; it is for batches of fewer files than the cluster
    has slots.
    """
    reader = spark.readStream.schema(PAGE).option("pathGlobFilter", glob)
    pages = reader.option("maxFilesPerTrigger", max_files).parquet(folder)
    return pages.repartition(spread_to) if spread_to else pages


def items_stream(pages: DataFrame, processed: DataFrame | None = None) -> DataFrame:
    """The batch page job on a stream, each URL once; URLs of an earlier run are left out.

    As in the batch job a URL's first row counts, blank or not: of the micro-batch it
    arrives in, the row with the smallest ``page_id``. What is read from a page is far
    smaller than its source, so repeats are dropped after reading, where only texts go to
    the URL state, and before blank pages are.
    """
    if processed is not None:
        pages = unseen(pages, processed)
    return items_of(first_rows_stream(decoded_pages(pages), "url", "page_id"))


#: Stands for a null in an order column, and comes first like one.
_LEAST = -(1 << 63)


def first_rows_stream(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key over the whole life of the stream: of the micro-batch the
    key first arrives in, the row with the smallest ``order`` (a whole number, null
    first). Rows without a key are left out. A task holds its share of a micro-batch."""
    keyed = rows.where(F.col(key).isNotNull()).withColumn(
        order, F.coalesce(F.col(order).cast("long"), F.lit(_LEAST))
    )

    schema = keyed.schema

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        found = rows.select([key, order]).append_column("__row", pa.array(range(rows.num_rows)))
        found = found.sort_by([(key, "ascending"), (order, "ascending"), ("__row", "ascending")])
        names = found.column(key).combine_chunks()
        first = pa.concat_arrays([pa.array([True]), pc.not_equal(names[1:], names[:-1])])
        yield from rows.take(found.column("__row").filter(first)).to_batches()

    # All rows a micro-batch has of a key meet in one task, and one of them goes on.
    found = keyed.repartition(key).mapInArrow(least, schema).dropDuplicates([key])
    return found.withColumn(order, F.nullif(F.col(order), F.lit(_LEAST)))


def _first_in_batch(key: str):
    def keep_first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.drop_duplicates(key)

    return keep_first


def dedup_stream(
    rows: DataFrame,
    key: str = "url",
    keep_for: str | None = None,
    combine: bool = True,
) -> DataFrame:
    """The first row of each key over the whole life of the stream.

    Keys are remembered for good, like the set they stand for. ``keep_for`` bounds that
    memory: a key is forgotten that long after it arrived, and may then pass again. It
    counts from arrival, so no row is ever too late. ``combine`` drops repeats inside a
    task before the shuffle, so that one very common key does not go to one task row by
    row; leave it out for rows with a large payload and few repeats.
    """
    if combine:
        rows = rows.mapInPandas(_first_in_batch(key), rows.schema)
    if keep_for:
        arrived = rows.withColumn("__arrived", F.current_timestamp())
        kept = arrived.withWatermark("__arrived", keep_for).dropDuplicatesWithinWatermark([key])
        return kept.drop("__arrived")
    return rows.dropDuplicates([key])


def new_urls_stream(urls: DataFrame, processed: DataFrame) -> DataFrame:
    """A stream of URLs, each once, without those already processed."""
    return dedup_stream(unseen(urls, processed))


def read_back(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What ``write_stream`` left under ``path`` in parquet. A stream that had no rows may
    have written no micro-batch."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def write_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    columns: list[str] | None = None,
    format: str = "json",
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Append a stream to ``path``, one sub-folder per query and micro-batch.

    A batch replayed after a failure replaces its own folder, so nothing is lost
    or written twice; the checkpoint is where a restart goes on. A new checkpoint
    makes a new query, whose batches count from zero in a folder of their own.
    ``trigger`` is that of the writer; unless one is named, all there is now is processed
    and the query ends. ``{"processingTime": "10 seconds"}`` keeps it running. A query that
    ends keeps no state store open between micro-batches.
    """
    columns = columns or ITEM.names
    trigger = trigger or {"availableNow": True}

    def append(batch: DataFrame, batch_id: int) -> None:
        context = batch.sparkSession.sparkContext
        query = context.getLocalProperty("sql.streaming.queryId")
        batch.select(*columns).write.mode("overwrite").format(format).save(
            f"{path}/query={query}/batch={batch_id}"
        )

    writer = rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    state_on_disk(rows.sparkSession, ends=not {"availableNow", "once"}.isdisjoint(trigger))
    return writer.trigger(**trigger).start()
