"""Mixing more sources than a flow on the driver could hold."""

import random
from collections import defaultdict

import cases
import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

from checking import rows_of
from claimstream.llm import mixing
from claimstream.llm.queries import ORACLES, QUERIES

SITES = 5000


def site_rows():
    draw = random.Random(3)
    names = [f"site{i}" for i in range(SITES)] * 2 + ["hot"] * 4000 + [None] * 3
    return [(i, "w " * draw.randrange(1 + i % 9), "en", s) for i, s in enumerate(names)]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return cases.write_tables(tmp_path_factory.mktemp("sites"), site_rows(), items=[])


def test_many_sources_equal_the_sql(spark, folder):
    got = QUERIES["op5_mixing"](spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    expected = con.execute(ORACLES["op5_mixing"])
    names = [c[0] for c in expected.description]
    assert rows_of(got.columns, got.collect()) == rows_of(names, expected.fetchall())


def test_the_stage_mixes_many_sources(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sizes, target = cases.mixed_rows(site_rows())
    taken = defaultdict(int)
    for r in corpus_pipeline.mix_sources(spark, docs, folder).collect():
        taken[r.source] += len(r.text.split())
    assert all(abs(taken[s] - target[s]) <= 4.5 for s in sizes)


def test_quotas_equal_the_targets_of_the_driver(spark):
    sizes = {"a": 10, "b": 1000, "c": 1000, None: 0, **{f"s{i}": i % 97 for i in range(300)}}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.quotas(table).collect()}
    assert got == pytest.approx(mixing.targets(sizes))


def test_single_sources_beside_shared_documents(spark):
    rows = [(i, "w " * (1 + i % 5), [f"site{i % SITES}"]) for i in range(2 * SITES)]
    rows += [(10**6 + i, "w " * (5 + i % 7), ["x", "y"] if i % 3 else ["x"]) for i in range(120)]
    docs = spark.createDataFrame(rows, "id bigint, text string, sources array<string>")
    size = mixing.word_count(F.col("text"))
    mixed, quota = mixing.mixed(docs, "id", size, F.col("sources"))
    got, target = mixed.collect(), {r.source: r.target for r in quota.collect()}
    assert len(got) == len(rows) and all(0 <= r.copies <= 2 for r in got)
    both = [r for r in got if r.id >= 10**6]
    want = min(target["x"] + target["y"], 2 * sum(r.size for r in both))
    assert abs(sum(r.copies * r.size for r in both) - want) <= 12
