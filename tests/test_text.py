import re

import pytest
from pyspark.sql import functions as F

from claimstream.functions.text import (
    STAND_IN,
    choose_text,
    find_entities,
    redact,
    redact_by_rule,
    tokens,
    word_ngrams,
)
from claimstream.operators.patterns import pattern_counts, pattern_record, top_patterns
from claimstream.operators.prepare import dictionary_entities, prepare_claims, text_sizes

TEXTS = [
    "Été à l'école, n°5!",
    "<ENTITY> was born",
    "",
    "a b",
    "  The  quick\tbrown fox_2   jumps!  ",
    "Straße ÇA ñandú १२३ 数据 x²",
    None,
]


def python_tokens(text):
    return re.sub(r"[^\w\s<>]", "", text.lower()).split()


def test_tokens_equal_the_python_rule(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    for row in df.select("text", tokens(F.col("text")).alias("t")).collect():
        assert row.t == (None if row.text is None else python_tokens(row.text))
    assert python_tokens(TEXTS[0]) == ["été", "à", "lécole", "n5"]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_ngrams(spark, n):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    got = sorted((r.id, r.pattern) for r in word_ngrams(df, ["id"], F.col("text"), n).collect())
    expected = []
    for i, text in enumerate(TEXTS):
        words = python_tokens(text or "")
        expected += [(i, " ".join(words[j : j + n])) for j in range(len(words) - n + 1)]
    assert got == sorted(expected)


def test_text_sizes(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a b c d"), (3, None)], "id int, text string")
    got = [tuple(r) for r in text_sizes(df, "id", "text").orderBy("id").collect()]
    assert got == [(1, 2, 0), (2, 4, 2), (3, 0, 0)]


def test_choose_text(spark):
    rows = [("r", "c", "r"), ("", "c", "c"), (None, "c", "c"), (None, None, None)]
    df = spark.createDataFrame(rows, "r string, c string, e string")
    got = df.select("e", choose_text(F.col("r"), F.col("c")).alias("t")).collect()
    assert all(row.t == row.e for row in got)


REDACTIONS = [
    (
        "New York City is in New York.",
        ["E", "New York", "New York City"],
        "<ENTITY> is in <ENTITY>.",
    ),
    ("abcde", ["abc", "bcde"], "a<ENTITY>"),
    ("Paris, Parisian, C++ (x)", ["Paris", "C++", "(x)"], "<ENTITY>, <ENTITY>ian, <ENTITY> <ENTITY>"),
    ("nothing here", [], "nothing here"),
    ("EEE", ["E", "EN"], "<ENTITY><ENTITY><ENTITY>"),
    ("a\ue000b", [], "a\ue000b"),
    (r"a\E.b \Q", [r"\E.", r"\Q", None, ""], "a<ENTITY>b <ENTITY>"),
    ("no array", None, "no array"),
    (None, ["E"], None),
]


def test_redact(spark):
    df = spark.createDataFrame(REDACTIONS, "text string, entities array<string>, expected string")
    got = df.select("expected", redact(F.col("text"), F.col("entities")).alias("r"))
    assert [(r.r, r.expected) for r in got.collect() if r.r != r.expected] == []


RULED = [
    *[t for t in TEXTS if t is not None],
    "New York Times and York in New Yorkshire 12 123 A1 1A a12b McDonald eBay USA US",
    "The The Theatre THEN Th 7 77 777",
]


def test_the_rule_in_one_pass_equals_entity_by_entity(spark):
    df = spark.createDataFrame([(t,) for t in RULED], "text string")
    text = F.col("text")
    both = df.select(redact(text, find_entities(text)).alias("a"), redact_by_rule(text).alias("b"))
    for row in both.collect():
        assert row.a == row.b


def test_find_entities(spark):
    df = spark.createDataFrame([("Marie Curie met Marie Curie in 1903 near Été",)], "text string")
    assert df.select(find_entities(F.col("text"))).first()[0] == ["Marie Curie", "1903", "Été"]


def test_dictionary_entities(spark):
    rows = [
        (1, "She moved to New York City, then Rome."),
        (2, "no match"),
        (3, "Rome Rome"),
        (4, "O'Neill ran the First National Bank of New  York, in U.S. terms"),
        (5, None),
    ]
    docs = spark.createDataFrame(rows, "id int, text string")
    listed = ["New York City", "Rome", "York", "O'Neill", "First National Bank of New York", "U S", "...", None]
    names = spark.createDataFrame([(n,) for n in listed], "entity string")
    found = dictionary_entities(docs, names, "id", "text")
    got = {r.id: sorted(r.entities) for r in found.collect()}
    assert got == {
        1: ["New York City", "Rome", "York"],
        3: ["Rome"],
        4: ["First National Bank of New  York", "O'Neill", "U.S", "York"],
    }
    assert dictionary_entities(docs, names.where("false"), "id", "text").collect() == []
    marked = docs.join(found, "id").select("id", redact(F.col("text"), F.col("entities")).alias("r"))
    assert dict(marked.collect())[4] == "<ENTITY> ran the <ENTITY>, in <ENTITY>. terms"


def test_prepare_drops_and_maps(spark):
    rows = [
        ("Ann ran", "SUPPORTS"),
        ("x", "REFUTES"),
        ("y", "NOT ENOUGH INFO"),
        ("z", "OTHER"),
        (None, "SUPPORTS"),
        ("w", None),
    ]
    raw = spark.createDataFrame(rows, "claim string, label string")
    got = sorted(tuple(r) for r in prepare_claims(raw).collect())
    assert got == [("Ann ran", "<ENTITY> ran", 0), ("x", "x", 1), ("y", "y", 1)]


def test_patterns_count_repeats_and_break_ties(spark):
    rows = [("s", "b c d b c d"), ("s", "a c d"), ("t", "a c d")]
    df = spark.createDataFrame(rows, "source string, text string")
    counts = {r.pattern: r["count"] for r in pattern_counts(df, F.col("text")).collect()}
    assert counts == {"b c d": 2, "c d b": 1, "d b c": 1, "a c d": 2}
    top = [(r.pattern, r["count"]) for r in top_patterns(df, F.col("text"), 3).collect()]
    assert top == [("a c d", 2), ("b c d", 2), ("c d b", 1)]
    record = {r.source: r.patterns for r in pattern_record(df, F.col("text"), ["source"], 2).collect()}
    assert [tuple(p) for p in record["s"]] == [("b c d", 2), ("a c d", 1)]
    assert [tuple(p) for p in record["t"]] == [("a c d", 1)]


def test_redact_a_text_that_has_the_stand_in(spark):
    own = STAND_IN
    rows = [
        (f"a{own}b ab", ["b", "a"]),
        ("axb", [f"a{own}b", "x"]),
        (f"a{own}b axb", [f"a{own}b", "x"]),
        ("no entity", []),
    ]
    found = spark.createDataFrame(rows, "t string, e array<string>").select(redact(F.col("t"), F.col("e")))
    assert [r[0] for r in found.collect()] == [
        f"<ENTITY>{own}<ENTITY> <ENTITY><ENTITY>",
        "a<ENTITY>b",
        "<ENTITY> a<ENTITY>b",
        "no entity",
    ]


def test_only_listed_ngrams_are_shuffled_as_text(spark):
    rows = [(g, f"the same words {i} {i + 1} {i + 2} and the same words") for g in "ab" for i in range(40)]
    docs = spark.createDataFrame([*rows, ("c", "x y z"), ("c", None)], "g string, t string")
    top = top_patterns(docs, F.col("t"), 2, ["g"])
    assert {(r.g, r["rank"], r.pattern, r["count"]) for r in top.collect()} == {
        *((g, 1, "the same words", 80) for g in "ab"),
        *((g, 2, "and the same", 40) for g in "ab"),
        ("c", 1, "x y z", 1),
    }
    assert "BroadcastHashJoin" in top._jdf.queryExecution().executedPlan().toString()
