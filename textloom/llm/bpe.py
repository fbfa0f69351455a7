"""Byte-level BPE encoding and decoding by a table of distinct words.

Texts are cut into words (a run of other characters with the blank before it, or white
space). The cuts are places where the tokenizer's own pattern always cuts, so words can be
encoded on their own. Tasks count the words of their texts and Spark sums the counts, every distinct word of the
table is encoded once, and tasks look up the ids of each word of a text in the table.
Decoding looks up the pieces of ids in the vocabulary. Neither is a join.

The table travels to every task, so it is bounded: the ``TABLE_WORDS`` most frequent words
that occur at least twice. A word seen once is encoded where it stands, which is once as
well. So are words beyond the bound, which a task remembers for a while.
"""

from __future__ import annotations

import functools
import json
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, StringType, StructField, StructType
from tokenizers import Tokenizer

from textloom.session import bound_batches, stash

#: Unicode white space, as the tokenizer's pattern has it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: A word with the blank before it; white space up to that blank; other white space.
WORD = f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
TABLE_WORDS = 200_000
#: Bytes of text that a task cuts into words at a time, and ids that it decodes at a time;
#: a longer text is taken alone.
BYTES_AT_ONCE = 1 << 20
IDS_AT_ONCE = 1 << 18
#: Other words a task remembers before it begins anew.
REMEMBERED_WORDS = 100_000
#: Longer words are rare and stay out of the table.
TABLE_WORD_CHARS = 64
#: Distinct words whose counts a task holds before it passes them on.
COUNTED_WORDS = 400_000


def special_tokens(path: str) -> list[str]:
    with open(path, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file)["added_tokens"]]


@functools.cache
def _pieces_of(path: str) -> list[bytes]:
    """Bytes of every id. The vocabulary writes a byte as one printable character: itself
    where it is one in Latin-1, else the next free character from 256 on."""
    tokenizer = _tokenizer(path)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}
    pieces = []
    for number in range(tokenizer.get_vocab_size()):
        token = tokenizer.id_to_token(number) or ""
        known = all(c in byte_of for c in token)
        pieces.append(bytes(byte_of[c] for c in token) if known else token.encode())
    return pieces


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: how often each word of ``TABLE_WORD_CHARS`` characters or fewer occurs in
    ``text``. A task sums up ``COUNTED_WORDS`` distinct words at a time; Spark adds its sums."""
    bound_batches(docs.sparkSession)
    most = COUNTED_WORDS

    def rows(held: Counter) -> pa.RecordBatch:
        kept = {word: n for word, n in held.items() if len(word) <= TABLE_WORD_CHARS}
        columns = [pa.array(kept.keys(), pa.string()), pa.array(kept.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, held = re.compile(WORD).findall, Counter()
        for batch in batches:
            for text in batch.column(0):
                held.update(find(text.as_py() or ""))
                if len(held) >= most:
                    yield rows(held)
                    held.clear()
        yield rows(held)

    counted = docs.select("text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def word_table(docs: DataFrame, path: str) -> DataFrame:
    """``word, ids``: the frequent words of the corpus with their token ids. Special tokens
    hold no place here: texts are cut at them first."""
    frequent = word_counts(docs).where("n > 1")
    table = frequent.orderBy(F.desc("n"), "word").limit(TABLE_WORDS).select("word")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in batches:
            found = batch.column(0)
            ids = pa.array(_encode_words(tokenizer, found.to_pylist()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([found, ids], names=["word", "ids"])

    slots = docs.sparkSession.sparkContext.defaultParallelism
    # limit() leaves one partition.
    return table.repartition(max(2, slots)).mapInArrow(encode, "word string, ids array<int>")


@functools.cache
def _tokenizer(path: str) -> Tokenizer:
    """Read once by a Python worker, whatever the number of its tasks."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _encode_words(tokenizer: Tokenizer, words: list[str]) -> list[list[int]]:
    """Ids of every word; the fast form gives no places, which nothing here needs."""
    return [c.ids for c in tokenizer.encode_batch_fast(words, add_special_tokens=False)]


def _parts(batch: pa.RecordBatch, sizes: np.ndarray, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most about ``limit`` by ``sizes``: lists of words take many times their text."""
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // limit)) + 1
    bounds = [0, *cuts.tolist(), batch.num_rows]
    for first, end in zip(bounds, bounds[1:]):
        if end > first:
            yield batch.slice(first, end - first)


def _lengths(column: pa.Array, length) -> np.ndarray:
    return pc.fill_null(length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _serialized(table: pa.Table) -> bytes:
    """Arrow bytes, which take a fraction of what rows take on the driver."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _with(df: DataFrame, name: str, kind: DataType) -> StructType:
    return StructType([*df.schema.fields, StructField(name, kind)])


class _Lookup:
    """Ids of words: those of the table, and others a task has met, numbered behind them."""

    def __init__(self, table: bytes, tokenizer: Tokenizer, specials: list[str]):
        held = pa.ipc.open_stream(table).read_all().combine_chunks()
        words, ids = held.column("word").to_pylist(), held.column("ids").combine_chunks()
        self.tokenizer, self.specials = tokenizer, specials
        self.number = dict(zip(words, range(len(words)))).get
        self.n, self.flat = len(words), ids.flatten().to_numpy()
        self.sizes = _lengths(ids, pc.list_value_length)
        self.forget()

    def forget(self) -> None:
        self.others = {s: self.n + k for k, s in enumerate(self.specials)}
        self.other_flat = array("i", [self.tokenizer.token_to_id(s) for s in self.specials])
        self.other_sizes = array("i", [1] * len(self.specials))

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``words`` on end, and how many each has."""
        at = np.fromiter(map(self.number, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            if len(self.others) > REMEMBERED_WORDS:
                self.forget()
            missed = [words[i] for i in unknown.tolist()]
            new = [w for w in dict.fromkeys(missed) if w not in self.others]
            for word, ids in zip(new, _encode_words(self.tokenizer, new)):
                self.others[word] = self.n + len(self.other_sizes)
                self.other_flat.extend(ids)
                self.other_sizes.append(len(ids))
            at[unknown] = [self.others[w] for w in missed]
        flat = np.concatenate((self.flat, np.array(self.other_flat, np.int32)))
        sizes = np.concatenate((self.sizes, np.array(self.other_sizes, np.int64)))
        begins, n = np.cumsum(sizes) - sizes, sizes[at]
        places = np.repeat(begins[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return flat[places], n


def encode_documents(docs: DataFrame, path: str, with_text: bool = True) -> DataFrame:
    """``docs`` with ``ids``: the token ids of ``text``, an array.

    Whole texts, as the tokenizer gives them without adding special tokens; special
    tokens written in a text become their ids. A null text is an empty one, which has no
    ids. Other columns pass through (``ids`` is replaced), ``text`` only if asked for; repeated
    rows are encoded alike; an empty table gives no rows. Rows stay in their tasks: no text is
    shuffled. A task holds the words of ``BYTES_AT_ONCE`` of text, or of one longer text.
    """
    return _encoded(docs.drop("ids"), path, with_text, decode=False)


def round_trip(docs: DataFrame, path: str, with_text: bool = True) -> DataFrame:
    """``decode_documents`` of ``encode_documents``: ``ids``, and ``decoded`` from them, by one
    Python worker a task instead of two, and without sending the ids in between."""
    return _encoded(docs.drop("ids", "decoded"), path, with_text, decode=True)


def _encoded(docs: DataFrame, path: str, with_text: bool, decode: bool) -> DataFrame:
    spark = docs.sparkSession
    bound_batches(spark)
    known = stash(word_table(docs, path), "bpe-words")
    # At most TABLE_WORDS words of TABLE_WORD_CHARS characters.
    table = spark.sparkContext.broadcast(_serialized(known.toArrow()))
    specials = special_tokens(path)
    at = docs.columns.index("text")
    rest = docs if with_text else docs.drop("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(table.value, _tokenizer(path), specials)
        pieces = pa.array(_pieces_of(path), pa.large_binary()) if decode else None
        find = re.compile(WORD).findall
        cut = re.compile("(" + "|".join(map(re.escape, specials)) + ")").split if specials else None

        def words_of(text: str) -> list[str]:
            if not any(s in text for s in specials):
                return find(text)
            words = []
            for n, part in enumerate(cut(text)):
                words.extend([part] if n % 2 else find(part))
            return words

        for batch in batches:
            for part in _parts(batch, _lengths(batch.column(at), pc.binary_length), BYTES_AT_ONCE):
                rows = [words_of(t) if t else [] for t in part.column(at).to_pylist()]
                ids, sizes = lookup.ids(list(chain.from_iterable(rows)))
                ends = np.concatenate(([0], np.cumsum(sizes)))
                bounds = ends[np.cumsum([0, *map(len, rows)])].astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids, pa.int32()))
                kept = part if with_text else part.drop_columns("text")
                made = {"ids": found} | ({"decoded": _joined(found, pieces)} if decode else {})
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, *made.values()], names=[*kept.schema.names, *made]
                )

    schema = _with(rest, "ids", ArrayType(IntegerType()))
    return docs.mapInArrow(run, schema.add("decoded", StringType()) if decode else schema)


def decode_documents(coded: DataFrame, path: str) -> DataFrame:
    """``coded`` with ``decoded``: the bytes of ``ids``, looked up in the vocabulary's pieces.

    Special tokens are written out; a column ``decoded`` is replaced. Bytes that are no UTF-8
    become U+FFFD. No ids, or null, give an empty text.
    """
    coded = coded.drop("decoded")
    bound_batches(coded.sparkSession)
    at = coded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(_pieces_of(path), pa.large_binary())
        for batch in batches:
            for part in _parts(batch, _lengths(batch.column(at), pc.list_value_length), IDS_AT_ONCE):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, _joined(part.column(at), pieces)],
                    names=[*part.schema.names, "decoded"],
                )

    return coded.mapInArrow(run, _with(coded, "decoded", StringType()))


def _joined(ids: pa.Array, pieces: pa.Array) -> pa.Array:
    """The pieces of every list of ``ids`` on end. Taken pieces lie behind one another, so the
    texts are stretches of their bytes."""
    taken = pieces.take(ids.flatten())
    ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
    bounds = ends[np.cumsum([0, *_lengths(ids, pc.list_value_length)])]
    data = taken.buffers()[2] if len(taken) else pa.py_buffer(b"")
    texts = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(bounds.tobytes()), data])
    try:
        return texts.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:
        said = [text.decode("utf-8", errors="replace") for text in texts.to_pylist()]
        return pa.array(said, pa.string())
