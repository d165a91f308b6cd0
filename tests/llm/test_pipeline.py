"""The stages of the pipeline, each on what the one before kept, against plain versions."""

from collections import Counter, defaultdict

import cases
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from claimstream.llm import quality
from claimstream.llm.common import held_out

ROWS = cases.documents()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return cases.write_tables(tmp_path_factory.mktemp("tables"), ROWS)


def plain(docs):
    return [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]


def test_every_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]

    labels = spark.read.parquet(f"{folder}/labels.parquet").where(~held_out(F.col("doc_id")))
    machine = quality.train(docs, labels, "doc_id", "text", "quality")
    kept = stages["quality"](spark, docs, folder)
    assert kept.columns == columns
    texts = [t and t.encode() for _, t, *_ in ROWS]
    good = [r for r, t in zip(ROWS, texts) if machine.score([t])[0] >= quality.ACCEPT]
    assert cases.counted(plain(kept)) == cases.counted(good)

    near = stages["near_duplicates"](spark, docs, folder)
    assert near.columns == columns
    got = Counter(r[:2] for r in plain(near))
    groups = defaultdict(list)
    root = cases.component_ids([cases.fingerprint(t) for _, t, *_ in ROWS])
    for i, t, *_ in ROWS:
        groups[root[cases.fingerprint(t)]].append((i, t))
    assert sum(got.values()) == len(groups)
    for members in groups.values():
        lowest = min((i is None, i or 0) for i, _ in members)
        stays = [(i, t) for i, t in members if (i is None, i or 0) == lowest]
        assert sum(got[m] for m in set(stays)) == 1

    clean = stages["decontamination"](spark, docs, folder)
    assert clean.columns == columns
    bad = [r[5] for r in cases.hit_rows(ROWS, cases.ITEMS)]
    assert cases.counted(plain(clean)) == cases.counted(r for r, b in zip(ROWS, bad) if not b)

    mixed = stages["mixing"](spark, docs, folder)
    assert mixed.columns == columns
    sizes, target = cases.mixed_rows(ROWS)
    taken, largest = defaultdict(int), defaultdict(int)
    for _, t, _, s in plain(mixed):
        taken[s] += len(cases.WORD.findall(t))
        largest[s] = max(largest[s], len(cases.WORD.findall(t)))
    assert all(abs(taken[s] - target[s]) <= max(largest[s], 1) / 2 + 1e-3 for s in sizes)
    assert max(Counter(r[:2] for r in plain(mixed) if r[0] != 10).values()) == 2

    placed = stages["sharding"](spark, docs, folder).collect()
    want = [(i, size, s, slot) for i, size, _, _, s, slot, _ in cases.shards(ROWS)]
    assert cases.counted((r.doc_id, r.size, r.shard, r.slot) for r in placed) == cases.counted(want)


def test_the_whole_pipeline(spark):
    folder = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, folder).collect()
    again = corpus_pipeline.run(spark, folder).collect()
    assert out and cases.counted(out) == cases.counted(again)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_an_empty_table(spark, tmp_path):
    folder = cases.write_tables(tmp_path, [], items=[])
    assert corpus_pipeline.run(spark, folder).collect() == []
