"""Chat formatting with Spark expressions: sorted turns, merged by role, concatenated.

A block is ``[INST]role`` line feed, the texts of adjacent turns of that role, each ended by
``[/INST]`` (more follow) or ``</s>`` (the block's last). Control strings inside roles and
texts get a backslash after their first character, one more than they have already, so
they can never be read as control strings and are restored exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The control strings of the template, and others that are kept apart.
OPEN, MORE, END = "[INST]", "[/INST]", "</s>"
CONTROL = r"(s>|/s>|INST\]|/INST\]|\|\w+\|>|<SYS>>|</SYS>>)"
#: The role whose texts are under the loss mask.
TRAINED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, r"$1$2$3")


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` to ``conv_id, formatted, loss_spans``, a row for each
    ``conv_id``.

    Turns run by ``turn`` (null first), ties by role, then text; repeated rows are turns
    of their own. A null text or role is an empty one; null ``conv_id`` is a conversation
    too. ``loss_spans`` holds ``start, length`` in characters of the escaped text of each
    assistant turn. Other columns are not read. An empty table gives no rows.
    """
    said = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(said)).alias("turns"))
    last = F.size("turns") - 1
    starts = F.filter(
        F.sequence(F.lit(0), last),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]),
    )
    rows = rows.withColumn("starts", starts)
    # Adjacent turns of one role become one block: its role and its texts.
    blocks = F.transform(
        "starts",
        lambda at, k: F.struct(
            F.get("turns", at)["role"].alias("role"),
            F.transform(
                F.slice(
                    "turns", at + 1, F.coalesce(F.get("starts", k + 1), F.size("turns")) - at
                ),
                lambda t: escape(t["text"]),
            ).alias("texts"),
        ),
    )
    rows = rows.withColumn("blocks", blocks)
    # Pieces alternate between marks and texts, so that offsets are sums of lengths.
    piece = lambda text, trained: F.struct(
        text.alias("text"), F.length(text).alias("length"), trained.alias("trained")
    )
    pieces = F.flatten(
        F.transform(
            "blocks",
            lambda b: F.concat(
                F.array(piece(F.concat(F.lit(OPEN), escape(b["role"]), F.lit("\n")), F.lit(False))),
                F.flatten(
                    F.transform(
                        b["texts"],
                        lambda text, i: F.array(
                            piece(text, b["role"] == TRAINED),
                            piece(
                                F.when(i == F.size(b["texts"]) - 1, END).otherwise(MORE),
                                F.lit(False),
                            ),
                        ),
                    )
                ),
            ),
        )
    )
    rows = rows.withColumn("pieces", pieces)
    zero = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:long,length:int>>").alias("spans"),
    )
    spans = F.aggregate(
        "pieces", zero,
        lambda acc, p: F.struct(
            (acc["at"] + p["length"]).alias("at"),
            F.when(
                p["trained"],
                F.concat(
                    acc["spans"],
                    F.array(F.struct(acc["at"].alias("start"), p["length"].alias("length"))),
                ),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return rows.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        spans.alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """``role, text`` of every turn, read from the formatted text alone. Unescaped
    brackets occur in control strings only."""
    blocks = F.slice(F.split(formatted, r"\[INST\]"), 2, 1 << 30)
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.regexp_replace(_body(b), r"</s>$", ""), r"\[/INST\]"),
                lambda text: F.struct(
                    unescape(_role(b)).alias("role"), unescape(text).alias("text")
                ),
            ),
        )
    )


def _role(block: Column) -> Column:
    return F.substring_index(block, "\n", 1)


def _body(block: Column) -> Column:
    return F.substr(block, F.length(_role(block)) + 2)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(
            spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"]))
        ),
        "",
    )
