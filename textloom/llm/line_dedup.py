"""Line dedup: an exact set-similarity join of all lines, in SQL functions only.

A line is the set of its words. Words are ordered by rarity; two sets with Jaccard
similarity of at least ``t`` share a word among the first ``n - ceil(t n) + 1`` of the larger
and the first ``n - ceil(2 t n / (1 + t)) + 1`` of the smaller, so only those are joined.
Rarity comes from a table of word counts by hash bucket, whose size is fixed; it only has to
put all lines in one order, so buckets lose no pair. Pairs that share such a word are held to
length and position limits and to a limit on a parity sketch (which can differ in no more
bits than the sets differ in words), then verified on the sets. A line similar to an earlier
one, by (doc_id, line number), is removed; every line with a word takes part.

A word that many prefixes share would join each of its sets to all others. Sets meet by such a
word and their class of lengths, and by a very common one and the word that follows it among
those they share. Where many sets are near copies of each other, a line needs one earlier match,
not all of them: lines are first held against a few of the earliest lines that share a pair
of rare words, and those settled so enter the join as the earlier side only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import only_blanks
from textloom.session import bytes_of, stash

#: Similarity as a fraction, so that limits are whole-number arithmetic.
SIMILAR = (4, 5)
#: Buckets of the word counts.
BUCKETS = 1 << 18
#: A list of documents up to this many bytes on disk is broadcast, a larger one shuffled.
BROADCAST_BYTES = 32 << 20
#: Pairs of rare words by which a line meets leaders, and leaders of each pair.
RUNS, LEADERS = 3, 8
#: Near copies in a group above which lines are held against leaders first.
CROWD = 64
#: Prefixes that share a word: above the first number sets meet by class of lengths too,
#: above the second by the next word.
COMMON = (512, 4096)
#: Words of a set above which its sketch has twice the bits.
_MANY = 96
#: Stands for a null document id, and sorts first like one.
NO_ID = -(1 << 63)


def _ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b).cast("int")


def rarity(docs: DataFrame) -> DataFrame:
    """One row: the occurrences of words by hash bucket, as an array of classes, four
    to a doubling."""
    lines = docs.select(F.explode(F.split(only_blanks("text"), "\n")).alias("said"))
    words = lines.select(F.explode(F.split("said", " ")).alias("w"))
    counts = words.groupBy(F.xxhash64("w").bitwiseAND(F.lit(BUCKETS - 1)).cast("int").alias("b")).agg(
        F.count("*").alias("n")
    )
    classed = counts.select("b", F.floor(F.log2(F.col("n") + 1) * 4).cast("byte").alias("c"))
    filled = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("b")).join(
        classed, "b", "left"
    )
    return filled.agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("b", F.coalesce("c", F.lit(0)).cast("byte").alias("c")))),
            lambda x: x["c"],
        ).alias("classes")
    )


#: 56 bits of a word's hash.
_HASH = (1 << 56) - 1


def _packed(hashed: Column, classes: Column) -> Column:
    """A word's hash as a number in order of rarity: seven bits of its count class before 56
    bits of its hash."""
    rank = F.get(classes, hashed.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")).cast("long")
    packed = F.shiftleft(rank, 56).bitwiseOR(hashed.bitwiseAND(F.lit(_HASH)))
    # Never null, and known to be so: arrays without nulls are sorted as plain numbers.
    return F.coalesce(packed, F.lit(0).cast("long"))


def _parity(words: Column, of_bit: bool) -> Column:
    """64 bits: bit b is set if an odd number of words fall there; with ``of_bit`` only
    words whose next bit is set count."""

    def bit(w: Column) -> Column:
        one = F.shiftright(w, 6).bitwiseAND(F.lit(1).cast("long")) if of_bit else F.lit(1).cast("long")
        return F.call_function("shiftleft", one, w.bitwiseAND(F.lit(63)).cast("int"))

    return F.aggregate(words, F.lit(0).cast("long"), lambda acc, w: acc.bitwiseXOR(bit(w)))


def _with_words(lines: DataFrame, classes: DataFrame) -> DataFrame:
    """``lines`` with ``words`` in place of ``said``, of which blanks alone part the words:
    its distinct words as numbers in order of rarity.

    ``classes`` is a bounded array of BUCKETS bytes, read in place of a join. It is a scalar
    of the projection that packs the words: a column below a generator would be copied for
    every line. The generator keeps later filters above it: below, all lines would be
    packed and sorted twice.
    """
    others = [c for c in lines.columns if c != "said"]
    hashed = F.array_distinct(F.transform(F.split("said", " "), lambda w: F.xxhash64(w)))
    real = F.array_remove(hashed, F.xxhash64(F.lit("")))
    packed = lines.select(*others, real.alias("real"), classes.scalar().alias("c")).select(
        *others, F.transform("real", lambda h: _packed(h, F.col("c"))).alias("words")
    )
    return packed.select(*others, F.explode(F.array(F.sort_array("words"))).alias("words"))


def _later_length(n: Column) -> Column:
    """Words of a set of ``n`` of which it shares one with any similar set."""
    up, down = SIMILAR
    return n - _ceil_div(n * up, down) + 1


def line_sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """A row for each line of ``docs`` that has a word: where it is (``doc_id, text_hash,
    line``), its set (``s1, s2``, hashes of all words; ``n`` words; ``prefix``, its rarest
    words in order and the one after them; ``parity``, and ``parity_of`` those with a bit set
    where there are many)."""
    # Nulls come first, as the smallest id.
    keyed = docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )
    cut = F.posexplode(F.split(only_blanks("text"), "\n")).alias("line", "said")
    lines = keyed.select("doc_id", "text_hash", cut)
    lines = _with_words(lines, classes).withColumn("n", F.size("words")).where("n > 0")
    # 31 bits of a prefix word are enough to meet by: what meets by chance is not similar.
    short = lambda w: w.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
    return lines.select(
        "doc_id", "text_hash", "line", F.xxhash64("words").alias("s1"), F.hash("words").alias("s2"), "n",
        F.transform(F.slice("words", 1, _later_length(F.col("n")) + 1), short).alias("prefix"),
        _parity(F.col("words"), False).alias("parity"),
        F.when(F.col("n") > _MANY, _parity(F.col("words"), True)).otherwise(F.lit(0).cast("long")).alias("parity_of"),
    )


def repeated_sets(sets: DataFrame) -> DataFrame:
    """``s1, s2`` of the sets of several lines."""
    return sets.groupBy("s1", "s2").agg(F.count("*").alias("lines")).where("lines > 1").select("s1", "s2")


def first_lines(sets: DataFrame, repeated: DataFrame) -> DataFrame:
    """The repeated sets, each with its earliest line."""
    first = F.min(F.struct("doc_id", "line", "n", "parity", "parity_of", "prefix")).alias("lead")
    led = sets.join(_sized(repeated), ["s1", "s2"], "left_semi").groupBy("s1", "s2").agg(first)
    return led.select("s1", "s2", "lead.*")


def lead_sets(
    sets: DataFrame, repeated: DataFrame | None = None, first: DataFrame | None = None
) -> DataFrame:
    """Each set once, with its earliest line. Sets that begin at the same place of documents
    with one id are told apart by ``s1``."""
    repeated = stash(repeated_sets(sets), "line-repeated") if repeated is None else repeated
    first = stash(first_lines(sets, repeated), "line-first") if first is None else first
    once = sets.join(_sized(repeated), ["s1", "s2"], "left_anti")
    leads = once.select(*first.columns).unionByName(first)
    return leads if bytes_of(repeated) <= BROADCAST_BYTES else stash(leads, "line-leads")


def _earlier(a: str, b: str) -> Column:
    place = lambda x: F.struct(f"{x}.doc_id", f"{x}.line", f"{x}.s1")
    return place(a) < place(b)


def _may_be_similar(n: Column, m: Column) -> Column:
    """Length and parity limits of sets of ``n`` and ``m`` words, n the smaller: they share
    ``t (n + m) / (1 + t)`` words at least, so they differ in the rest."""
    up, down = SIMILAR
    odd = [F.col(f"{x}.parity").bitwiseXOR(F.col(f"{x}.parity_of")) for x in "ab"]
    bits = F.bit_count(F.col("a.parity").bitwiseXOR(F.col("b.parity")))
    more = F.bit_count(odd[0].bitwiseXOR(odd[1])) + F.bit_count(
        F.col("a.parity_of").bitwiseXOR(F.col("b.parity_of"))
    )
    differ = F.when((n > _MANY) & (m > _MANY), more).otherwise(bits)
    return (n * down >= m * up) & (m * down >= n * up) & (differ * (up + down) <= (n + m) * (down - up))


_PAIR = ["first_doc", "first_line", "first_s1", "later_doc", "later_line", "later_s1"]


def _pair(a: str, b: str) -> list[Column]:
    return [
        F.col(f"{x}.{c}").alias(name)
        for name, (x, c) in zip(_PAIR, [(x, c) for x in (a, b) for c in ("doc_id", "line", "s1")])
    ]


def _of_some_words(leads: DataFrame) -> DataFrame:
    """Without sets so small, of three words or fewer, that no other one is similar."""
    up, down = SIMILAR
    return leads.where(F.col("n") * (down - up) >= up)


def near_copies(leads: DataFrame) -> DataFrame:
    """``ends, size``: large groups of sets that are likely to be near copies, whose prefixes
    have the same least and greatest word, by hash."""
    prefix = F.slice("prefix", 1, _later_length(F.col("n")))
    ends = _of_some_words(leads).select(F.xxhash64(F.array_min(prefix), F.array_max(prefix)).alias("ends"))
    return ends.groupBy("ends").agg(F.count("*").alias("size")).where(F.col("size") > CROWD)


def _pairs_of_words(prefix: str) -> Column:
    """``RUNS`` pairs of neighbours in a run of words, chosen by hash: a word put in or taken
    out changes at most two pairs, and near copies choose the same of the others."""
    ends = [F.expr(f"slice({prefix}, {k}, size({prefix}) - 1)") for k in (1, 2)]
    each = F.zip_with(*ends, lambda x, y: F.xxhash64(x, y))
    return F.slice(F.sort_array(F.array_distinct(each)), 1, RUNS)


def pairs_with_leaders(leads: DataFrame) -> DataFrame:
    """Pairs of sets with the earliest ones that share two rare words in a row, where such
    sets are many.

    The sets of a pair of words are dealt by hash into ``LEADERS`` parts, and each meets the
    earliest set of every part: at most ``RUNS * LEADERS`` pairs a set, however many sets are
    alike. In a group of near copies the earliest one may itself be far from the others, but
    hardly all the leaders, so nearly every line is settled here and never meets all others.
    """
    # What one copy has of its own is rarer than what many share: the later half holds these.
    length = _later_length(F.col("n"))
    half = F.floor(length / 2).cast("int")
    rows = leads.withColumn("prefix", F.slice("prefix", F.greatest(half, F.lit(1)), length - half + 1)).select(
        "doc_id", "line", "s1", "n", "parity", "parity_of", F.explode(_pairs_of_words("prefix")).alias("run")
    )
    often = rows.groupBy("run").agg(F.count("*").alias("size")).where(F.col("size") > LEADERS)
    often = _small_or_shuffled(often.select("run"), "line-crowds")
    shared = stash(rows.join(often, "run"), "line-runs")
    part = F.pmod(F.xxhash64("s1"), F.lit(LEADERS))
    first = shared.groupBy("run", part.alias("part")).agg(
        F.min(F.struct("doc_id", "line", "s1", "n", "parity", "parity_of")).alias("b")
    ).select("run", "b.*")
    met = shared.alias("a").join(first.hint("merge").alias("b"), F.col("a.run") == F.col("b.run"))
    near = _may_be_similar(F.col("a.n"), F.col("b.n"))
    return met.where(_earlier("b", "a") & near).select(*_pair("b", "a")).distinct()


def common_words(leads: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """``word, sets``: words that more than ``COMMON[0]`` prefixes share. With ``classes``
    only words whose bucket occurs as often are counted."""
    words = leads.select(F.explode(F.slice("prefix", 1, _later_length(F.col("n")))).alias("word"))
    if classes is not None:
        # The class of a count above the limit is not below the limit's.
        words = words.select("word", classes.scalar().alias("c")).where(
            F.get("c", F.col("word").bitwiseAND(F.lit(BUCKETS - 1))) >= int(math.log2(COMMON[0] + 1) * 4)
        )
    return words.groupBy("word").agg(F.count("*").alias("sets")).where(F.col("sets") > COMMON[0])


def _class(n: Column) -> Column:
    """Lengths of sets that may be similar, five to four at most, are of one class or of two
    neighbours."""
    return F.floor(F.log(n) / F.log(F.lit(1.3)))


def _met_rows(leads: DataFrame, gone: DataFrame | None, classes: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """``key, at, s1, parity, parity_of, open`` of the sets as the smaller and as the larger
    side of a pair; two similar sets share a key. ``at``: length of the set before the place
    in it from which a pair shares all but one of its words at most.

    The key is a word of the prefix, or what ``COMMON`` adds to it. If the first word that two
    sets share is common, they share another after it, at most one place beyond the prefix.
    Two settled sets share no key with a common word.
    """
    common = stash(common_words(leads, classes), "line-common")
    some = common.count() > 0
    common = _sized(common)
    known = _of_some_words(leads).select("s1", "n", "prefix", "parity", "parity_of")
    if gone is None:
        known = known.withColumn("open", F.lit(1))
    else:
        known = known.join(_sized(gone).select("s1", F.lit(0).alias("open")), "s1", "left")
        known = known.withColumn("open", F.coalesce("open", F.lit(1)))
    carried = ["s1", "n", "parity", "parity_of", "open"]

    def side(smaller: bool) -> DataFrame:
        up, down = SIMILAR
        n, i = F.col("n"), F.col("i")
        length = n - _ceil_div(n * 2 * up, up + down) + 1 if smaller else _later_length(n)
        cut = F.slice("prefix", 1, length)
        rows = known.select(*carried, F.posexplode(cut).alias("i", "word"))
        if some:
            rows = rows.join(common.select("word"), "word", "left_anti")
        rows = rows.select(*carried, "i", F.col("word").cast("long").alias("key"))
        if some:
            hot = known.select(*carried, "prefix", F.posexplode(cut).alias("i", "word")).join(common, "word")
            own = F.xxhash64("word", _class(n))
            by_class = F.array(own) if smaller else F.array(own, F.xxhash64("word", _class(n) - 1))
            rest = F.slice("prefix", i + 2, F.greatest(length - i, F.lit(0)))
            by_next = F.transform(rest, lambda w: F.xxhash64(F.col("word"), w))
            many = F.col("sets") > COMMON[1]
            keys = F.posexplode(F.when(many, by_next).otherwise(by_class)).alias("k", "key")
            hot = hot.select(*carried, "i", many.alias("many"), keys)
            hot = hot.withColumn("i", F.when(F.col("many"), i + F.col("k")).otherwise(i)).select(*rows.columns)
            if gone is not None:
                # Open with open, open as the smaller with settled, open as the larger with settled.
                tags = ([0, 1], [2]) if smaller else ([0, 2], [1])
                tags = [F.array(*[F.lit(t) for t in x]) for x in tags]
                tagged = F.explode(F.when(F.col("open") == 1, tags[0]).otherwise(tags[1])).alias("tag")
                hot = hot.select("*", tagged).withColumn("key", F.xxhash64("key", "tag")).drop("tag")
            rows = rows.unionByName(hot)
        at = F.shiftleft(n.cast("long"), 32).bitwiseOR(i.cast("long") * 2 + F.col("open"))
        return rows.select("key", at.alias("at"), "s1", "parity", "parity_of")

    return side(True), side(False)


def candidates(
    leads: DataFrame, gone: DataFrame | None = None, classes: DataFrame | None = None
) -> DataFrame:
    """All pairs whose later set is not ``gone`` yet, that share a prefix word and pass
    all limits.

    With i and j the places of a shared word, at most ``min(n - i, m - j)`` words are
    shared from there on; similarity asks for ``ceil(t (n + m) / (1 + t))``.
    """
    up, down = SIMILAR
    smaller, larger = _met_rows(leads, gone, classes)
    n, m = (F.shiftright(f"{x}.at", 32).cast("int") for x in "ab")
    low = [F.col(f"{x}.at").bitwiseAND(F.lit((1 << 32) - 1)) for x in "ab"]
    i, j = (F.shiftright(x, 1).cast("int") for x in low)
    left = F.least(n - i, m - j)
    ordered = (n < m) | ((n == m) & (F.col("a.s1") < F.col("b.s1")))
    condition = (F.col("a.key") == F.col("b.key")) & ordered & _may_be_similar(n, m)
    condition &= left * (up + down) >= (n + m) * up
    if gone is not None:
        condition &= low[0].bitwiseOR(low[1]).bitwiseAND(F.lit(1)) == 1
    met = smaller.hint("merge").alias("a").join(larger.alias("b"), condition)
    met = stash(met.select(F.col("a.s1").alias("x"), F.col("b.s1").alias("y")).distinct(), "line-met")
    wanted = met.select(F.explode(F.array("x", "y")).alias("s1")).distinct()
    places = leads.select("doc_id", "line", "s1").join(_small_or_shuffled(wanted, "line-met-sets"), "s1", "left_semi")
    places = _small_or_shuffled(places, "line-met-places")
    both = met.join(places.select(F.col("s1").alias("x"), F.struct("doc_id", "line", "s1").alias("a")), "x")
    both = both.join(places.select(F.col("s1").alias("y"), F.struct("doc_id", "line", "s1").alias("b")), "y")
    both = both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = both.select(*_pair("a", "b"))
    if gone is None:
        return pairs
    settled = _sized(gone).select(F.col("s1").alias("later_s1"))
    return pairs.join(settled, "later_s1", "left_anti").select(*_PAIR)


def _sized(written: DataFrame) -> DataFrame:
    return F.broadcast(written) if bytes_of(written) <= BROADCAST_BYTES else written


def _small_or_shuffled(df: DataFrame, label: str) -> DataFrame:
    """Broadcast when its written size is known to be small, else left to a shuffle."""
    return _sized(stash(df, label))


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``s1``: later sets of the pairs that are similar, by all words of the lines."""
    up, down = SIMILAR
    ends = F.array(
        *[F.struct(*[F.col(f"{e}_{c}").alias(c) for c in ("doc", "line", "s1")]) for e in ("first", "later")]
    )
    wanted = stash(pairs.select(F.inline(ends)).distinct(), "line-wanted")
    in_docs = wanted.select("doc").distinct()
    keyed = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text")
    held = keyed.join(_small_or_shuffled(in_docs, "line-docs"), "doc", "left_semi")
    said = held.select("doc", F.posexplode(F.split(only_blanks("text"), "\n")).alias("line", "said"))
    said = said.join(_small_or_shuffled(wanted, "line-places"), ["doc", "line"])
    said = _with_words(said, classes)
    # Documents that share an id hold several lines of one number: the set tells which.
    said = said.where(F.xxhash64("words") == F.col("s1")).select("s1", "words").dropDuplicates(["s1"])
    said = stash(said, "line-words")

    def similar(pairs: DataFrame) -> DataFrame:
        a, b = (said.select(F.col("s1").alias(c), F.col("words").alias(w)) for c, w in (("x", "a"), ("s1", "b")))
        both = pairs.join(a, "x").join(b, "s1")
        shared = F.size(F.array_intersect("a", "b"))
        union = F.size("a") + F.size("b") - shared
        return both.where(shared * down >= union * up).select("s1").distinct()

    # One match is enough: of many pairs of a set two are tried first, and the others of
    # those only that have not been similar.
    pairs = pairs.select(F.col("first_s1").alias("x"), F.col("later_s1").alias("s1"))
    ends = pairs.groupBy("s1").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("pairs"))
    ends = stash(ends, "line-tries")
    tries = ends.select("s1", F.explode(F.array_distinct(F.array("low", "high"))).alias("x"))
    settled = stash(similar(tries), "line-tried")
    more = ends.where("pairs > 2").select("s1").join(_sized(settled), "s1", "left_anti")
    more = _small_or_shuffled(more, "line-untried")
    return settled.unionByName(similar(pairs.join(more, "s1", "left_semi"))).distinct()


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the text that is left, and ``n_lines, n_removed, removed``.

    A line is removed if an earlier line has the same set of words or a similar one; lines
    without a word stay. Lines are ordered by ``doc_id`` (null first), then by place. ``n_lines``: lines of the text (none of null); ``removed``:
    places of the removed lines, from 0. Rows alike in id and text share their lines and
    are treated alike. A null text stays null; a text that loses every line becomes empty.
    Other columns pass through; those of these names, and ``_d`` and ``_key``, are
    replaced. An empty table gives no rows.
    """
    docs = docs.drop("n_lines", "n_removed", "removed", "_d", "_key")
    classes = stash(rarity(docs), "line-rarity")
    sets = stash(line_sets(docs, classes), "line-sets")
    repeated = stash(repeated_sets(sets), "line-repeated")
    first = stash(first_lines(sets, repeated), "line-first")
    leads = lead_sets(sets, repeated, first)
    gone = None
    # Small groups of near copies make few pairs: those are verified at once.
    if not near_copies(leads).isEmpty():
        near = stash(pairs_with_leaders(leads), "line-leaders")
        gone = stash(verified(docs, classes, near), "line-settled")
    pairs = stash(candidates(leads, gone, classes), "line-candidates")
    later = verified(docs, classes, pairs)
    similar = later if gone is None else gone.unionByName(later).distinct()
    lines = sets.select("s1", "s2", "doc_id", "text_hash", "line")
    alike = lines.join(_small_or_shuffled(similar, "line-similar"), "s1", "left_semi")
    again = lines.join(_sized(repeated), ["s1", "s2"], "left_semi")
    at = _small_or_shuffled(first.select("s1", "s2", F.struct("doc_id", "line").alias("at")), "line-at")
    again = again.join(at, ["s1", "s2"]).where(F.struct("doc_id", "line") != F.col("at"))
    out = alike.unionByName(again.select(*lines.columns))
    gone_lines = out.groupBy(F.struct("doc_id", "text_hash").alias("_d")).agg(
        F.sort_array(F.collect_set("line")).alias("removed")
    )
    known = _small_or_shuffled(gone_lines, "line-removed")
    key = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    joined = docs.withColumn("_key", key).join(known, F.col("_key") == F.col("_d"), "left")
    joined = joined.drop("_key", "_d")
    said = F.split("text", "\n")
    joined = joined.withColumns(
        {
            "n_lines": F.coalesce(F.size(said), F.lit(0)).cast("long"),
            "removed": F.coalesce("removed", F.array().cast("array<int>")),
        }
    ).withColumn("n_removed", F.size("removed").cast("long"))
    stay = F.array_except(F.sequence(F.lit(0), F.col("n_lines").cast("int") - 1), F.col("removed"))
    # The lines are bound to a variable: a text is cut once, not once a line.
    left = F.transform(F.array(said), lambda cut: F.array_join(F.transform(stay, lambda i: F.get(cut, i)), "\n"))
    return joined.withColumn("text", F.when(F.col("n_removed") > 0, F.get(left, F.lit(0))).otherwise(F.col("text")))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``dedup_lines`` with the columns of ``docs``: ``n_chars`` is counted anew and
    documents that lose every line are left out."""
    done = dedup_lines(docs).where("n_removed < n_lines or n_lines = 0")
    counted = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", counted.cast(docs.schema["n_chars"].dataType)).select(
        *docs.columns
    )
