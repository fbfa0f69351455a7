"""Keyword cleaning, tokens, language, analysis, titles."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.functions.analysis import analyze, explode_structs, with_term_counts
from textloom.functions.language import detect_language, drop_stop_words


def many(spark, values, fn):
    """``fn`` of every value, in one job."""
    rows = spark.createDataFrame(list(enumerate(values)), "i long, t string").coalesce(1)
    return [row[1] for row in sorted(rows.select("i", fn(F.col("t"))).collect())]


def one(spark, value, fn):
    return many(spark, [value], fn)[0]


KEYWORD_CLEAN = [
    ("L'homme", "lhomme"),
    ("example.com", "examplecom"),
    ("see http://a.b/c?d=1 now", "see  now"),
    ("xhttps://a y", "x y"),
    ("ÇA ŒUVRE Æ ñ ß ä", "ça œuvre æ ñ  "),
    ("a_1-b", "ab"),
    ("a b", "a b"),
    ("don't", "dont"),
]


def test_keyword_clean(spark):
    got = many(spark, [t for t, _ in KEYWORD_CLEAN], T.keyword_clean)
    assert got == [want for _, want in KEYWORD_CLEAN]


TOKENIZE = [
    ("cannot gimme gonna gotta lemme wanna",
     "can not gim me gon na got ta lem me wan na"),
    ("cannots acannot wannabe écannot", "cannots acannot wannabe écannot"),
    ("cannot cannot", "can not can not"),
    (" a b c\x1fd ", "a b c d"),
    ("", ""),
    ("   ", ""),
]


def test_tokenize(spark):
    got = [" ".join(words) for words in many(spark, [t for t, _ in TOKENIZE], T.tokenize)]
    assert got == [want for _, want in TOKENIZE]


LANGUAGE = [
    ("The cat is on the table and it was there", "english"),
    ("Le chat est sur la table et il y a une souris dans la maison", "french"),
    ("Der Hund ist nicht auf dem Tisch und das ist gut", "unknown"),
    ("El perro y los gatos por una casa con muchos", "unknown"),
    ("xyzzy", "unknown"),
    ("", "unknown"),
]


def test_language(spark):
    got = many(spark, [t for t, _ in LANGUAGE], detect_language)
    assert got == [want for _, want in LANGUAGE]


def test_stop_words_depend_on_language(spark):
    def kept(lang):
        return one(
            spark, "the une cat x dont", lambda c: drop_stop_words(F.split(c, " "), F.lit(lang))
        )

    assert kept("english") == ["une", "cat", "dont"]
    assert kept("french") == ["the", "cat", "dont"]
    assert kept("unknown") == ["the", "une", "cat", "dont"]


ANALYZE = [
    ("L'homme qui rit", ["l'homme", "qui", "rit"]),
    ("3,14 or 1.000,5", ["3,14", "or", "1.000,5"]),
    ("example.com, foo@bar.org", ["example.com", "foo", "bar.org"]),
    ("snake_case _x_ __", ["snake_case", "_x_"]),
    ("a1b2 1a a,b 1.a", ["a1b2", "1a", "a", "b", "1", "a"]),
    ("'quoted' end.", ["quoted", "end"]),
    ("Été ÉCOLE", ["été", "école"]),
    ("日本", ["日", "本"]),
    ("", []),
    (None, []),
    ("!!!", []),
]


def test_analyze(spark):
    got = many(spark, [t for t, _ in ANALYZE], analyze)
    assert got == [want for _, want in ANALYZE]


def test_long_tokens_are_cut(spark):
    assert [len(t) for t in one(spark, "x" * 600 + " y", analyze)] == [255, 255, 90, 1]
    assert len(one(spark, "a1" * 50_000, analyze)) == 393


NORMALIZE_TITLE = [
    ("Foo - Page 12", "Foo"),
    ("Foo - Page 12 - page 3", "Foo"),
    ("Foo-PAGE7 bar", "Foo bar"),
    ("Page 3", "Page 3"),
    ("X - Page - Page 1 2", "X - Page 2"),
]


def test_normalize_title(spark):
    got = many(spark, [t for t, _ in NORMALIZE_TITLE], T.normalize_title)
    assert got == [want for _, want in NORMALIZE_TITLE]


def test_snippet(spark):
    assert one(spark, "x" * 300, T.snippet) == "x" * 200 + "..."
    assert one(spark, "short", T.snippet) == "short..."


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "é", "zz"]), max_size=12), min_size=1,
                max_size=8))
def test_term_counts_equal_a_count(spark, docs):
    rows = list(enumerate(docs))
    df = spark.createDataFrame(rows, "doc_id long, w array<string>")
    counted = explode_structs(with_term_counts(df, "w", "counts"), "counts", ["doc_id"])
    got = {(r.doc_id, r.term): r.tf for r in counted.collect()}
    want = {(i, t): words.count(t) for i, words in rows for t in set(words)}
    assert got == want
