"""Near copies, phrases and periodic runs against plain versions of them."""

import random

import cases
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimstream.llm import chosenpath, periodic, phrases
from claimstream.llm.queries import QUERIES
from claimstream.llm.wordhash import Words

ROWS = cases.documents()


def edited(seed, text, share):
    draw = random.Random(seed)
    return " ".join(w if draw.random() > share else f"z{draw.randrange(10**6)}" for w in text.split(" "))


def near_groups():
    """A group that no one text is near all others of, pairs about the limit, and single texts."""
    rows, text = [], cases.prose(70, 150, 3000)
    for i in range(60):
        rows.append((1000 + i, edited(i, text, 0.004 * (i % 12)), "en", "n"))
    chain = cases.prose(71, 120, 3000).split(" ")
    for i in range(30):
        rows.append((2000 + i, " ".join(chain[i * 3 :] + [f"c{k}" for k in range(i * 3)]), "en", "n"))
    rows += [(3000 + i, cases.prose(500 + i, 40 + i, 3000), "en", "n") for i in range(30)]
    return rows


def periodic_rows():
    rows = []
    for i in range(60):
        draw, words = random.Random(i), []
        while len(words) < 10 + 3 * i:
            part = [f"p{draw.randrange(draw.choice([1, 2, 40]))}" for _ in range(draw.randrange(1, 12))]
            words += part * draw.randrange(1, 8) + part[: draw.randrange(len(part))]
        rows.append((4000 + i, " \n".join(words), "en", "p"))
    rows.append((5000, "again " * 5000, "en", "p"))
    return rows


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rows = ROWS + near_groups()
    return rows, cases.write_tables(tmp_path_factory.mktemp("tables"), rows)


def test_near_copies_of_edge_cases(spark, folder):
    rows, path = folder
    got = QUERIES["op11_minhash"](spark, path).collect()
    plain = [(r.doc_id, r.n_shingles, r.component_id) for r in got]
    assert cases.counted(plain) == cases.counted(cases.alike_rows(rows))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("settings", [{"node": 2, "block": 3}, {"node": 8, "block": 1000}, {"depth": 1, "node": 4}])
def test_near_copies_with_crowded_nodes_and_clusters(spark, folder, settings):
    rows, path = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").repartition(5)
    got = chosenpath.near_copies(docs, "doc_id", "text", **settings).collect()
    assert cases.counted(got) == cases.counted(cases.alike_rows(rows))


def test_small_clusters_beside_a_large_one(spark):
    """Adaptive planning must not part the small clusters when the large ones are taken out."""
    rows, text = [], cases.prose(80, 150, 3000)
    for i in range(30):
        rows.append((i, edited(i, text, 0.005), "en", "n"))
    for i in range(40):
        text = cases.prose(600 + i, 150, 3000)
        rows += [(100 + 4 * i + k, f"{text} e{k}", "en", "n") for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(5)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        got = chosenpath.near_copies(docs, "doc_id", "text", block=3).collect()
    finally:
        spark.conf.unset(coalesce)
    assert cases.counted(got) == cases.counted(cases.alike_rows(rows))


def test_phrases_of_edge_cases(spark, folder):
    rows, path = folder
    got = QUERIES["op12_phrases"](spark, path).collect()
    assert cases.counted(got) == cases.counted(cases.phrase_rows(rows))


def test_phrases_that_become_frequent_late(spark, tmp_path):
    """Rare words, pieces, ties in score, a null language beside its stand-in, and upper case."""
    draw, rows = random.Random(3), []
    for i in range(300):
        words = [f"v{draw.randrange(30)}" for _ in range(draw.randrange(12))]
        if i % 23 == 0:
            words += ["Seldom", "Seen", "Here"]
        text = "".join(w + draw.choice([" ", "\t", ", ", "\n", " ", "  "]) for w in words)
        rows.append((i, text, draw.choice(["en", None, "und", ""]), "s"))
    path = cases.write_tables(tmp_path, rows)
    assert cases.counted(QUERIES["op12_phrases"](spark, path).collect()) == cases.counted(cases.phrase_rows(rows))
    docs = spark.read.parquet(f"{path}/documents.parquet")
    want = [(w[0], w[2], w[3], w[4], w[5], w[1]) for w in cases.phrase_rows(rows, 2, 50)]
    for slots in (1 << 16, 64):  # in a few slots almost every phrase shares one with another
        few = phrases.frequent(docs, "lang", "text", least=2, seed=5, fewest_slots=slots)
        found = phrases.best(phrases.collocations(few), 50).drop("score")
        assert cases.counted(found.collect()) == cases.counted(want)


def test_scores_beyond_64_bits(spark):
    counted = spark.createDataFrame(
        [("en", 1, 1, [1], ["a"], 10**13), ("en", 1, 2, [2], ["b"], 3 * 10**12), ("en", 2, 3, [1, 2], ["a", "b"], 2 * 10**12)],
        "lang string, size int, key bigint, parts array<bigint>, words array<string>, f bigint",
    )
    row = phrases.collocations(counted).first()
    assert row.score == 10**6 * (2 * 10**12) ** 2 // (3 * 10**25)


def test_runs_of_edge_cases(spark, tmp_path):
    rows = [r for r in ROWS if len(r[1] or "") < 10000] + periodic_rows()
    path = cases.write_tables(tmp_path, rows)
    got = QUERIES["op13_periodic_runs"](spark, path).collect()
    assert cases.counted(got) == cases.counted(cases.run_rows(rows))


def test_runs_and_texts_of_the_operator(spark):
    docs = spark.createDataFrame([("k", "x a b a b a b a b y"), (None, None)], "name string, runs string")
    first, second = periodic.collapsed(docs, "name", "runs").collect()
    assert [tuple(r) for r in first.runs] == [(1, 8, 2)] and bytes(first.collapsed) == b"x a b y"
    assert second.n_words == 0 and second.runs == [] and bytes(second.collapsed) == b""


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 7)), max_size=8))
def test_runs_of_any_words(parts):
    words = [w for part, times in parts for w in part * times]
    got = periodic.runs(np.array(words, np.uint64), max(1, len(words)) // 4)
    found = sorted(((a, b - a, q) for a, b, q in got.tolist()), key=lambda r: (r[0], r[2]))
    assert found == cases.plain_runs(words)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \t\n\x0b\x0c\rabé\x00\x1c"), max_size=30) | st.none(), max_size=6))
def test_words_and_their_hashes(texts):
    raw = [None if t is None else t.encode() for t in texts]
    words = Words(raw)
    split = [w for t in raw for w in (t or b"").split()]
    assert words.spelled(np.arange(len(words.starts))) == split
    assert words.counts.tolist() == [len((t or b"").split()) for t in raw]
    hashes = words.hashes().tolist()
    assert len(set(zip(split, hashes))) == len(set(split)) == len(set(hashes))
