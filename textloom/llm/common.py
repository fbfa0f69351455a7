"""What the operators share: the word rule, exact offsets and safe defaults."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The six separators of words; everything else is part of a word.
SEPARATORS = " \\t\\n\\x0B\\f\\r"
WORD = f"[^{SEPARATORS}]+"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def words_of(text: Column | str) -> Column:
    """Words of a text in order; none for null. Only the first piece can be empty."""
    text = F.col(text) if isinstance(text, str) else text
    found = F.split(F.rtrim(text, F.lit(" \t\n\x0b\f\r")), f"[{SEPARATORS}]+")
    start = F.when(found[0] == "", 2).otherwise(1)
    return F.coalesce(F.slice(found, start, F.size(found)), F.array().cast("array<string>"))


def plain_words(text: Column | str) -> Column:
    """``words_of`` for hot paths: cut at single blanks, which needs no pattern, so empty
    words may be among them."""
    text = F.col(text) if isinstance(text, str) else text
    for separator in "\t\n\x0b\f\r":
        text = F.replace(text, F.lit(separator), F.lit(" "))
    return F.split(text, " ")


def only_blanks(text: Column | str) -> Column:
    """A text in which blanks stand for the other separators but line feeds. Seldom one has
    others: texts are searched once, and few are written anew."""
    text = F.col(text) if isinstance(text, str) else text
    plain = text
    for separator in "\t\x0b\f\r":
        plain = F.replace(plain, F.lit(separator), F.lit(" "))
    return F.when(text.rlike("[\t\x0b\f\r]"), plain).otherwise(text)


def cells_for(rows: int, per_cell: int = 20_000) -> int:
    """Cells that hold about ``per_cell`` rows each, so they grow in number, not size."""
    return max(8, math.ceil(rows / per_cell))


def with_offsets(
    df: DataFrame, group: list[str], order: list[str], amount: Column, cells: int, name: str
) -> DataFrame:
    """``df`` with ``name``: the sum of ``amount`` over the rows before it in its group.

    A group is dealt over ``cells`` by a hash of its order columns, so no task has to hold
    one: cells are summed first, and each row counts only the rows before it in its cell.
    Rows run by (cell, order); rows alike in every order column may swap places.
    """
    keys = ["_group", "_cell"]
    rows = df.withColumns(
        {
            # Structs with null fields compare as equal, which plain null keys do not.
            "_group": F.struct(*group),
            "_cell": F.pmod(F.xxhash64(*order), F.lit(cells)),
            "_amount": amount,
        }
    )
    per_cell = rows.groupBy(*keys).agg(F.sum("_amount").alias("_in_cell"))
    before = Window.partitionBy("_group").orderBy("_cell")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    base = per_cell.select(
        *keys, F.coalesce(F.sum("_in_cell").over(before), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
    return rows.join(base, keys).select(
        *df.columns, (F.col("_base") + F.col("_inside")).cast("long").alias(name)
    )
