"""Quality rules: plain limits, then robust multivariate outliers, all in SQL functions.

Every document becomes a vector of transformed statistics. For each language and source a
minimum-covariance-determinant estimate is made by concentration steps: start from medians
and absolute deviations, then repeatedly take mean and covariance of the share of documents
with the smallest distances. Documents far from that estimate in Mahalanobis distance are
rejected. Vectors are whole numbers (1/1024 steps), so sums are exact in any order and
reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import SEPARATORS, words_of
from textloom.session import stash

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Share of documents a concentration step keeps.
CORE = 0.75
STEPS = 3
#: Steps of a unit in the vectors.
UNIT = 1024
#: Squared distance per dimension above which a vector is an outlier. In five dimensions normal
#: data go beyond it once in some 700 million documents.
CUT = 10.0
#: Spread (in units) that every dimension has at least: constant statistics reject nothing
#: that differs by less.
FLOOR = 0.05
#: Groups with fewer documents than this reject nothing.
LEAST_GROUP = 10
#: Histogram steps per doubling of a squared distance.
FINE = 64
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


# --- statistics of one text ----------------------------------------------------------


def text_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``.

    Words that three-word windows repeat are found by sorting: a window's hash and its
    place share one number, so equal windows are neighbours. The top bits only sort;
    whether neighbours are equal is decided by all 64.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SEPARATORS}]"))
    rows = docs.withColumns({"_words": words_of("text"), "_lines": lines})
    rows = rows.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.regexp_replace(text, f"[{SEPARATORS}]+", "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
        }
    ).drop("_words", "_lines")
    places = F.sequence(F.lit(0), F.size("_hashes") - 3)
    grams = F.when(
        F.size("_hashes") >= 3,
        F.transform(
            places,
            lambda i: F.xxhash64(
                F.get("_hashes", i), F.get("_hashes", i + 1), F.get("_hashes", i + 2)
            ),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("_grams", grams).drop("_hashes")
    # Bits for the place: enough for the longest text of this row.
    rows = rows.withColumn("_low", F.ceil(F.log2(F.size("_grams") + 1)).cast("int"))
    packed = F.transform(
        "_grams",
        lambda g, i: F.call_function("shiftleft", F.call_function(
            "shiftright", g, F.col("_low")), F.col("_low")) + i.cast("long"),
    )
    rows = rows.withColumn("_sorted", F.sort_array(packed))
    place = lambda p: p.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_low")) - 1)
    gram = lambda p: F.get("_grams", place(p).cast("int"))
    twice = F.filter(
        "_sorted",
        lambda p, i: (gram(p) == gram(F.get("_sorted", i + 1)))
        | ((i > 0) & (gram(p) == gram(F.get("_sorted", i - 1)))),
    )
    rows = rows.withColumn("_twice", F.sort_array(F.transform(twice, lambda p: place(p))))
    covered = F.aggregate(
        F.transform(
            "_twice",
            lambda p, i: F.least(
                F.lit(3).cast("long"), F.coalesce(F.get("_twice", i + 1) - p, F.lit(3).cast("long"))
            ),
        ),
        F.lit(0).cast("long"), lambda total, n: total + n,
    )
    rows = rows.withColumn("n_repeat_words", covered)
    return rows.drop("_grams", "_low", "_sorted", "_twice")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def vector() -> list[Column]:
    """Transformed statistics in steps of 1 / ``UNIT``; counts per word are square roots,
    which makes their spread even."""
    n = F.greatest("n_words", F.lit(1))
    values = [
        F.log(n),
        4 * F.log((F.col("word_chars") + 1) / n),
        4 * F.sqrt(F.col("n_symbols") / n),
        2 * F.sqrt(F.col("n_dup_lines") / n),
        2 * F.sqrt(F.col("n_repeat_words") / n),
    ]
    return [F.round(v * UNIT).cast("long") for v in values]


# --- minimum covariance determinant ---------------------------------------------------


def _cholesky(cov: dict[tuple[int, int], Column], p: int) -> dict[str, Column]:
    """Columns ``lij`` of the Cholesky factor of ``cov``, in the order they build on."""
    names = {}
    for i in range(p):
        for j in range(i + 1):
            inner = cov[i, j]
            for k in range(j):
                inner = inner - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            # The floor on the diagonal keeps every pivot above zero.
            names[f"l{i}{j}"] = (
                F.sqrt(F.greatest(inner, F.lit(FLOOR * FLOOR / 4))) if i == j
                else inner / F.col(f"l{j}{j}")
            )
    return names


def _estimate(core: DataFrame, keys: list[str], p: int) -> DataFrame:
    """Mean ``m*`` and Cholesky factor ``l**`` (in units) of every group's ``core``."""
    sums = {f"s{i}": F.sum(f"x{i}") for i in range(p)}
    sums |= {
        f"q{i}{j}": F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i in range(p) for j in range(i + 1)
    }
    found = core.groupBy(*keys).agg(
        F.count("*").alias("n"), *[column.alias(name) for name, column in sums.items()]
    )
    cov = {}
    for i in range(p):
        for j in range(i + 1):
            c = (
                F.col(f"q{i}{j}") / F.col("n")
                - (F.col(f"s{i}") / F.col("n")) * (F.col(f"s{j}") / F.col("n"))
            ) / (UNIT * UNIT)
            cov[i, j] = c + FLOOR * FLOOR if i == j else c
    found = found.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") / UNIT for i in range(p)})
    factor = _cholesky(cov, p)
    for name, column in factor.items():
        found = found.withColumn(name, column)
    return found.select(*keys, *[f"m{i}" for i in range(p)], *factor)


def _with_distance(rows: DataFrame, estimate: DataFrame, keys: list[str], p: int) -> DataFrame:
    """``rows`` with ``d2``, the squared Mahalanobis distance, by forward substitution."""
    met = rows.join(estimate, keys)
    for i in range(p):
        y = F.col(f"x{i}") / UNIT - F.col(f"m{i}")
        for k in range(i):
            y = y - F.col(f"l{i}{k}") * F.col(f"y{k}")
        met = met.withColumn(f"y{i}", y / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(p)), F.lit(0.0))
    return met.withColumn("d2", d2).select(*rows.columns, "d2")


def _level(d2: Column) -> Column:
    return F.floor(F.log2(d2 + 1e-6) * FINE).cast("int")


def _quantile(counts: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """``keys, limit, t``: of a histogram ``keys, value, n``, the least value up to which
    ``share`` of a group's rows lie, and the number of rows."""
    group = Window.partitionBy(*keys)
    upto = group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    found = counts.select(
        *keys, value, F.sum("n").over(upto).alias("c"), F.sum("n").over(group).alias("t")
    )
    return found.where(F.col("c") >= share * F.col("t")).groupBy(*keys).agg(
        F.min(value).alias("limit"), F.first("t").alias("t")
    )


def _histogram(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    return rows.groupBy(*keys, value).agg(F.count("*").alias("n"))


def _start(rows: DataFrame, keys: list[str], p: int) -> DataFrame:
    """First estimate: medians, and mean absolute deviations from them, without
    covariances. All dimensions go through one histogram."""
    each = F.explode(
        F.array(*[F.struct(F.lit(i).alias("dim"), F.col(f"x{i}").alias("x")) for i in range(p)])
    )
    long = rows.select(*keys, each.alias("e")).select(*keys, "e.dim", "e.x")
    middle = _quantile(_histogram(long, [*keys, "dim"], "x"), [*keys, "dim"], "x", 0.5)
    of = lambda i: F.max(F.when(F.col("dim") == i, F.col("limit"))).alias(f"m{i}")
    medians = stash(middle.groupBy(*keys).agg(*[of(i) for i in range(p)]), "mcd-medians")
    spread = rows.join(medians, keys).groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.sum(F.abs(F.col(f"x{i}") - F.col(f"m{i}"))).alias(f"a{i}") for i in range(p)],
    )
    return medians.join(spread, keys).select(
        *keys,
        *[(F.col(f"m{i}") / UNIT).alias(f"m{i}") for i in range(p)],
        *[
            (F.col(f"a{i}") / F.col("n") / UNIT + FLOOR if i == j else F.lit(0.0)).alias(f"l{i}{j}")
            for i in range(p) for j in range(i + 1)
        ],
    )


def mcd_distances(rows: DataFrame, keys: list[str], p: int) -> DataFrame:
    """``rows`` (a table on disk: whole-number ``x0 .. x{p-1}``, ``keys`` without nulls)
    with ``d2``, the squared robust distance from the group's estimate.

    It is scaled so that its median is at least the one normal data have, and null in
    groups of fewer than ``LEAST_GROUP`` rows.
    """
    estimate = stash(_start(rows, keys, p), "mcd-start")
    for step in range(STEPS):
        measured = _with_distance(rows, estimate, keys, p).withColumn("level", _level(F.col("d2")))
        limits = _quantile(_histogram(measured, keys, "level"), keys, "level", CORE)
        core = measured.join(limits.drop("t"), keys).where("level <= limit")
        estimate = stash(_estimate(core, keys, p), f"mcd-step-{step}")
    measured = _with_distance(rows, estimate, keys, p)
    levels = _histogram(measured.withColumn("level", _level(F.col("d2"))), keys, "level")
    middle = _quantile(levels, keys, "level", 0.5)
    # Median of a chi-squared variable of p degrees, by Wilson and Hilferty.
    normal = p * (1 - 2 / (9 * p)) ** 3
    factor = normal / F.greatest(F.pow(F.lit(2.0), F.col("limit") / FINE), F.lit(normal))
    scaled = F.when(F.col("t") >= LEAST_GROUP, F.col("d2") * factor)
    return measured.join(middle, keys).withColumn("d2", scaled).select(*rows.columns, "d2")


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id``, the statistics, ``base_failed``, ``distance2`` and ``kept``, a row for
    each row of ``docs``, with ``row_key``, which is alike only in rows alike.

    Documents that fail a base rule take no part in the estimates and have no distance.
    Null languages and sources are groups of their own. A null text has no words, so it
    fails. Repeated rows count once each; a null ``doc_id`` stays. Other columns are not
    read. An empty table gives no rows.
    """
    keys = ["lang_key", "source_key"]
    x = vector()
    said = text_statistics(docs.select("doc_id", "text", "lang", "source"))
    named = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit(""))
    rows = stash(
        said.select(
            "doc_id", *STATISTICS, base_failed().alias("base_failed"), row_key(),
            named("lang").alias("lang_key"), named("source").alias("source_key"),
            *[c.alias(f"x{i}") for i, c in enumerate(x)],
        ),
        "text-statistics",
    )
    out = ["doc_id", *STATISTICS, "base_failed", "distance2", "kept", "row_key"]
    failed = rows.where("base_failed").withColumns(
        {"distance2": F.lit(None).cast("double"), "kept": F.lit(False)}
    )
    measured = mcd_distances(rows.where("not base_failed"), keys, len(x))
    judged = measured.withColumn("distance2", F.col("d2")).withColumn(
        "kept", F.coalesce(F.col("d2") <= CUT * len(x), F.lit(True))
    )
    return judged.select(*out).unionByName(failed.select(*out))


def row_key() -> Column:
    """128 bits of what the verdict depends on, and the id."""
    columns = ["doc_id", "text", "lang", "source"]
    nulls = F.concat(*[F.col(c).isNull().cast("string") for c in columns])
    first, second = (F.xxhash64(F.lit(salt), nulls, *columns) for salt in (1, 2))
    return F.struct(first.alias("a"), second.alias("b")).alias("row_key")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns."""
    good = judge(docs).where("kept").select(F.col("row_key").alias("_good")).distinct()
    return docs.join(good, row_key() == F.col("_good"), "left_semi")
