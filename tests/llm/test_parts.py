"""The parts of the operators against plain versions of them."""

import random

import cases
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimstream.llm import automaton, bwt, exact, exchange, graph, language, mixing, quality, recompression, sharding
from claimstream.llm.common import attach, split_words

few = settings(max_examples=60, deadline=None)
words = st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), min_size=0, max_size=40)


@few
@given(st.lists(words, min_size=1, max_size=5), words)
def test_automaton_finds_the_longest_runs(items, text):
    window = 4
    machine = automaton.Automaton([(str(i), w) for i, w in enumerate(items)], window)
    spans, found = machine.match(text)
    hit, names = set(), set()
    for i, item in enumerate(items):
        n = min(window, len(item))
        grams = {tuple(item[k : k + n]) for k in range(len(item) - n + 1)} if n else set()
        for k in range(len(text) - n + 1):
            if n and tuple(text[k : k + n]) in grams:
                hit |= set(range(k, k + n))
                names.add(str(i))
    assert {p for a, b in spans for p in range(a, b)} == hit
    assert {machine.names[j] for j in found} == names
    merged = automaton.merged(spans)
    assert all(b < c for (_, b), (c, _) in zip(merged, merged[1:]))


@few
@given(st.lists(st.text("abcß ", min_size=1, max_size=30), min_size=1, max_size=6), st.integers(1, 3))
def test_merged_transforms_tell_equal_strings(texts, shards):
    depth = 6
    raw = [t.encode() for t in texts]
    parts = [p for p in (raw[i::shards] for i in range(shards)) if p]
    built = [bwt.transform(p) for p in parts]
    for part, (_, order) in zip(parts, built):
        joined = b"\0".join(part) + b"\0"
        suffixes = [joined[k:] for k in range(len(joined))]
        assert [joined[k:] for k in order] == sorted(suffixes)
    place, interval = bwt.merge([symbols for symbols, _ in built], depth)
    seen, at = {}, 0
    for part, (_, order) in zip(parts, built):
        joined = b"\0".join(part) + b"\0"
        for k in order:
            s = joined[k : k + depth]
            if len(s) == depth and b"\0" not in s:
                assert seen.setdefault(int(interval[place[at]]), s) == s
            at += 1
    assert len(set(seen.values())) == len(seen)


@few
@given(st.lists(st.lists(st.integers(0, 5), max_size=60), min_size=2, max_size=5), st.integers(2, 7))
def test_equal_windows_have_equal_anchors(docs, window):
    texts = [" ".join(f"w{x}" for x in d).encode() for d in docs]
    hashes, doc, first = recompression.word_hashes(texts)
    assert len(hashes) == sum(map(len, docs))
    starts = np.array([i for i in range(len(hashes) - window + 1) if doc[i] == doc[i + window - 1]], np.int64)
    if len(starts):
        anchor = recompression.anchors(hashes, doc, starts, window)
        value = recompression.window_hashes(hashes, starts, window)
        seen, named = {}, {}
        for s, a, v in zip(starts.tolist(), anchor.tolist(), value.tolist()):
            gram = tuple(hashes[s : s + window].tolist())
            assert seen.setdefault(gram, (a, v)) == (a, v)
            assert named.setdefault(v, gram) == gram


@few
@given(st.lists(st.integers(0, 3), max_size=40), st.lists(st.integers(0, 9), max_size=40))
def test_first_seen_and_runs(values, ranks):
    n = min(len(values), len(ranks))
    v, r = np.array(values[:n], np.uint64), np.array(ranks[:n], np.int64)
    lowest = exchange.first_seen(v, r)
    assert lowest.tolist() == [min(b for a, b in zip(values, ranks[:n]) if a == x) for x in values[:n]]
    doc, at = np.zeros(25, np.int64), np.array([*range(3, 20), *range(30, 38)])
    runs = exchange.cut_runs(*exchange.runs_of(doc, at), most=7)
    assert [r.tolist() for r in runs[1:]] == [[3, 10, 17, 30, 37], [7, 7, 3, 7, 1]]
    hit = exchange.covered([{"starts": np.array([1], np.uint32).tobytes(), "sizes": np.array([2], np.uint32).tobytes()}], 8, 3)
    assert hit.tolist() == [False, True, True, True, True, False, False, False]


def test_long_texts_are_cut_into_overlapping_pieces(monkeypatch):
    monkeypatch.setattr(bwt, "BLOCK_BYTES", 700)
    draw = random.Random(4)
    text = bytes(draw.randrange(97, 105) for _ in range(5000))
    whole, windows = bwt.segments([b"", text, b"short"]), set()
    for d, f, n in zip(*whole[:3]):
        assert d == 1
        windows |= set(range(f, f + n))
    assert windows == set(range(len(text) - bwt.WIDTH + 1))


@pytest.mark.parametrize("windows, size", [(3, 2), (700, 4)])
def test_a_transform_travels_with_places_as_wide_as_it_needs(windows, size):
    draw = random.Random(8)
    text = bytes(draw.randrange(97, 123) for _ in range(windows * bwt.WIDTH))
    starts = np.arange(0, len(text), bwt.WIDTH, dtype=np.uint32)
    part = {
        "starts": starts.tobytes(),
        "sizes": np.ones(windows, np.uint32).tobytes(),
        "anchors": np.full(windows, 6, np.uint32).tobytes(),
        "crowded": bytes(windows),
    }
    docs = pa.table({"id": [1, 2], "key": [10, 20], "text": [text, text], "parts": [[part], [part]]})
    sent = pa.Table.from_batches(bwt._send_shards(iter(docs.to_batches()), 1))
    (row,) = sent.to_pylist()
    assert len(row["rows"]) == size * len(row["symbols"]) // 2 == size * 2 * windows * (bwt.WIDTH + 1)
    (found,) = bwt._merge_shards(sent).to_pylist()
    assert (found["id"], found["text"]) == (2, 20)
    assert np.frombuffer(found["starts"], np.uint32).tolist() == starts.tolist()


def test_shards_are_written_in_slot_order(spark, tmp_path):
    rows = [(i, "x" * (i % 17)) for i in range(200)]
    placed = sharding.assign(spark.createDataFrame(rows, "id bigint, text string"), "id", "text", 5, ("text",))
    sharding.write_shards(placed, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(r.id for r in back.collect()) == list(range(200))
    totals = [r[1] for r in back.groupBy("shard").sum("size").collect()]
    assert len(totals) == 5 and max(totals) - min(totals) <= 2 * 24
    for shard in range(5):
        slots = sorted(r.slot for r in back.where(F.col("shard") == shard).collect())
        assert slots == list(range(len(slots)))


def test_components_of_chains_rings_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (102, 100), (5, 5)]
    edges += [(200, 201 + i) for i in range(300)] + [(500, 600)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    got = dict(graph.components(frame, "a", "b").collect())
    assert {k: v for k, v in got.items() if k <= 60} == dict.fromkeys(range(61), 0)
    assert [got[k] for k in (100, 101, 102)] == [100] * 3
    assert {got[k] for k in range(200, 501)} == {200} and got[600] == 200
    assert graph.components(frame.where("false"), "a", "b").count() == 0


def test_attach_keeps_every_row(spark):
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") < 1000, "hot").when(F.col("id") < 2000, F.col("id").cast("string")).alias("k")
    )
    summary = rows.where("k is not null").groupBy("k").agg(F.count("*").alias("n")).where("k != '1500'")
    got = attach(rows, summary, "k", "n").collect()
    assert len(got) == 3000 and len({r.id for r in got}) == 3000
    for r in got:
        assert r.n == (1000 if r.k == "hot" else None if r.k is None or r.k == "1500" else 1)


def test_words_are_cut_at_white_space_only(spark):
    rows = [("  a\tb\x0bc \r\n", ["a", "b", "c"]), ("\xa0x y z", ["\xa0x", "y z"]), ("", []), (None, None)]
    frame = spark.createDataFrame(rows, "t string, e array<string>")
    assert all(r.w == r.e for r in frame.select("e", split_words(F.col("t")).alias("w")).collect())


def test_exact_refinement_reads_the_full_hash_of_candidates_only(spark):
    rows = [(i, f"text number {i} " * 3) for i in range(10)] + [(20, "same"), (21, " sa me"), (22, "sane")]
    frame = spark.createDataFrame(rows, "id bigint, text string")
    got = {r.id: r.digest for r in exact.digests(frame, "id", "text").collect()}
    assert got[20] == got[21] == cases.sha("same") and got[22] is None
    assert all(got[i] is None for i in range(10))


def test_targets_reshare_what_full_sources_cannot_give():
    sizes = {"a": 10, "b": 1000, "c": 1000, None: 0}
    got = mixing.targets(sizes)
    assert got["a"] == 20 and got[None] == 0
    assert sum(got.values()) == pytest.approx(1.5 * 2010)
    assert all(got[s] <= 2 * sizes[s] for s in sizes)


def test_overlapping_sources_share_their_documents():
    supply = {("a",): 100, ("a", "b"): 100, ("b",): 10}
    given = mixing.route(supply, {"a": 100.0, "b": 150.0})
    assert sum(given.values()) == pytest.approx(250)
    # All 210 words are used once before 40 of them are used again.
    assert sum(max(0, given[p] - supply[p]) for p in supply) == pytest.approx(40)
    assert given[("b",)] + given[("a", "b")] >= 150 - 1e-6
    # Convex costs: nothing is used twice while a first use is open.
    once = mixing.route({("a",): 100, ("a", "b"): 100}, {"a": 100.0, "b": 100.0})
    assert once == {("a",): pytest.approx(100), ("a", "b"): pytest.approx(100)}


def test_a_mix_of_overlapping_sources(spark):
    rows = [(i, f"w " * (5 + i % 7), ["a", "b"] if i % 3 else ["a"]) for i in range(120)]
    docs = spark.createDataFrame(rows, "id bigint, text string, sources array<string>")
    mixed, sizes, quota = mixing.mix(docs, "id", mixing.word_count(F.col("text")), F.col("sources"), whole=True)
    got = mixed.collect()
    assert len(got) == 120 and all(0 <= r.copies <= 2 and r.document.text for r in got)
    total = sum(r.copies * r.size for r in got)
    assert abs(total - min(sum(quota.values()), 2 * sum(r.size for r in got))) <= 12


def test_pairwise_sum_of_the_machine_equals_the_double_loop():
    draw = np.random.default_rng(1)
    machine = quality.Machine(0.3, draw.normal(size=20), draw.normal(size=(20, 4)))
    index, values = np.array([1, 4, 9, 15]), np.array([0.5, 1.0, -2.0, 0.1])
    raw, _ = machine.raw(index, values, np.array([0, 4]), np.array([4, 4]))
    pairs = sum(
        machine.factors[index[i]] @ machine.factors[index[j]] * values[i] * values[j]
        for i in range(4)
        for j in range(i)
    )
    assert raw[0] == pytest.approx(0.3 + machine.weights[index] @ values + pairs)
    assert raw[1] == pytest.approx(0.3)


def test_ngrams_of_long_texts_do_not_depend_on_pieces(monkeypatch):
    text = cases.prose(9, 500).encode()
    whole = np.sort(np.concatenate(list(language.ngrams(text))))
    monkeypatch.setattr(language, "PIECE", 64)
    assert np.array_equal(np.sort(np.concatenate(list(language.ngrams(text)))), whole)
