"""JSON-lines sinks, local or on an object store, chosen by configuration.

A sink is a folder of part files: tasks append in parallel and nothing already
written is read back.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from textloom.functions import fixed
from textloom.schemas import ENRICHED, FAILURE, ITEM

ITEMS_FILE = "final_data.jsonl"
FAILURES_FILE = "failed.jsonl"


def sink_path(config: Mapping[str, object], default_name: str = ITEMS_FILE) -> str:
    """URI a configuration stands for; ``ValueError`` for an unknown type."""
    kind = config["type"]
    name = config.get("filename", default_name)
    if kind == "s3":
        return f"s3a://{config.get('s3_bucket')}/{name}"
    if kind == "local":
        return f"{str(config.get('directory_path', './')).rstrip('/')}/{name}"
    raise ValueError(fixed.UNKNOWN_SINK)


def _append(df: DataFrame, columns: list[str], path: str) -> str:
    df.select(*columns).write.mode("append").json(path)
    return path


def write_items(df: DataFrame, config: Mapping[str, object]) -> str:
    return _append(df, ITEM.names, sink_path(config, ITEMS_FILE))


def write_failures(df: DataFrame, config: Mapping[str, object]) -> str:
    return _append(df, FAILURE.names, sink_path(config, FAILURES_FILE))


def write_enriched(df: DataFrame, path: str) -> str:
    """Replace the enriched documents: title, url, keywords, content."""
    df.select(*ENRICHED.names).write.mode("overwrite").json(path)
    return path
