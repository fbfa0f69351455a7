"""JSON-lines scans that tolerate bad lines in the ways each stage needs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.schemas import ENRICHED, FAILURE
from textloom.session import paths_matching


#: No line is refused for the length of a string in it.
_ANY_LENGTH = {"maxStringLen": str(2**31 - 1)}


#: A file, a folder, a pattern of names, or several of them.
Paths = str | Sequence[str]


def _lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """Lines ``value``, with the ``file`` of each. A file that is not there yet, as on a
    first run, has none, nor has a pattern that nothing matches; that the folder they
    should be in is missing too is an error."""
    found = []
    for path in [paths] if isinstance(paths, str) else paths:
        if paths_matching(spark, path):
            found.append(path)
        elif not paths_matching(spark, path.rstrip("/").rpartition("/")[0] or "."):
            raise FileNotFoundError(f"No folder for '{path}'.")
        else:
            print(f"No file at '{path}': nothing is read.")
    if not found:
        return spark.createDataFrame([], "value string, file string")
    return spark.read.text(found).select("value", F.input_file_name().alias("file"))


def _parsed_lines(lines: DataFrame, parse: Column) -> DataFrame:
    """Lines ``value`` with their parsed form ``v``, where there is one.

    The one-element outer explode keeps the filter above the parser. Directly on a
    projection it would be pushed below, and every line would be parsed twice.
    """
    parsed = lines.select("value", F.explode_outer(F.array(parse)).alias("v"))
    return parsed.where(F.col("v").isNotNull())


def _fields(schema: T.StructType) -> Column:
    """The fields of a line as text, and ``bad`` where it is no JSON object."""
    marked = T.StructType(
        [T.StructField(name, T.StringType()) for name in schema.names]
        + [T.StructField("bad", T.StringType())]
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad", **_ANY_LENGTH}
    return F.from_json("value", marked, options)


def _both_ways(schema: T.StructType) -> Column:
    """A line as a typed value ``typed``, or, where the typed parser refuses it (a repeated
    key, a very long text), as fields of text ``plain``. Null if neither reads it."""
    typed = F.try_parse_json(F.col("value"))
    plain = F.when(typed.isNull(), _fields(schema))
    readable = typed.isNotNull() | plain["bad"].isNull()
    return F.when(readable & (F.trim("value") != ""), F.struct(typed.alias("typed"), plain.alias("plain")))


def _text(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def _texts(value: Column, path: str) -> Column:
    """A list of texts; a single one is a list of one."""
    many = F.try_variant_get(value, path, "array<string>")
    one = _text(value, path)
    return F.coalesce(many, F.when(one.isNotNull(), F.array(one)))


def _plain_texts(raw: Column) -> Column:
    """The same from a field that was read as text."""
    many = F.when(raw.startswith("["), F.from_json(raw, "array<string>", _ANY_LENGTH))
    return F.coalesce(many, F.when(raw.isNotNull(), F.array(raw)))


def scan_items(spark: SparkSession, path: Paths) -> DataFrame:
    """Items ``title, url, content, keywords`` of a JSON-lines folder or file.

    A line that is no JSON is dropped. JSON that is no usable item (not an object,
    or with a content that is not text) stays as a blank row, because it still
    counts in the size of the corpus. A missing content is just empty. Lines of any
    length are read; of a repeated key the last counts.
    """
    parsed = _parsed_lines(_lines(spark, path), _both_ways(ENRICHED))
    typed, plain = F.col("v.typed"), F.col("v.plain")
    content = F.try_variant_get(typed, "$.content", "variant")
    usable = F.col("value").rlike(r"^\s*\{") & (
        content.isNull() | (F.schema_of_variant(content) == "STRING")
    )

    def field(name: str) -> Column:
        said = F.coalesce(_text(typed, f"$.{name}"), plain[name], F.lit(""))
        return F.when(usable, said).otherwise("")

    keywords = F.coalesce(_texts(typed, "$.keywords"), _plain_texts(plain["keywords"]))
    empty = F.array().cast("array<string>")
    return parsed.select(
        field("title").alias("title"),
        field("url").alias("url"),
        field("content").alias("content"),
        F.when(usable, F.coalesce(keywords, empty)).otherwise(empty).alias("keywords"),
    )


def malformed_lines(spark: SparkSession, path: Paths) -> DataFrame:
    """The lines ``scan_items`` drops, with the file each came from."""
    return _lines(spark, path).where(_both_ways(ENRICHED).isNull()).select("file", "value")


def _well_formed(spark: SparkSession, path: Paths, schema: T.StructType) -> DataFrame:
    """Fields of the lines that are JSON objects, all as text."""
    parsed = _parsed_lines(_lines(spark, path), _fields(schema))
    fine = parsed.where(F.col("v.bad").isNull())
    return fine.select(*[f"v.{name}" for name in schema.names])


def scan_processed_urls(spark: SparkSession, path: Paths) -> DataFrame:
    """Distinct ``url`` of well-formed lines that have one."""
    schema = T.StructType([T.StructField("url", T.StringType())])
    return _well_formed(spark, path, schema).where(F.col("url").isNotNull()).distinct()


def scan_failed_urls(spark: SparkSession, path: Paths) -> DataFrame:
    """Distinct ``failed_url, error_code`` of well-formed lines; no code is ''."""
    rows = _well_formed(spark, path, FAILURE).where(F.col("failed_url").isNotNull())
    code = F.coalesce("error_code", F.lit(""))
    return rows.withColumn("error_code", code).dropDuplicates(["failed_url", "error_code"])


def scan_documents(spark: SparkSession, path: Paths) -> DataFrame:
    """Enriched documents to index; lines that are no JSON objects are skipped. A single
    keyword counts as a list of one."""
    rows = _well_formed(spark, path, ENRICHED)
    return rows.withColumn("keywords", _plain_texts(F.col("keywords")))
