"""What the physical plans must and must not hold."""

import re

import pytest

from claimstream.plans import views
from claimstream.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Queries that run a stream, or that share their plan with feature_words, are left out.
PLANNED = [
    n
    for n in sorted(QUERIES)
    if not n.startswith("stream_")
    and n not in ("train_eval", "score_claims", "feature_importance", "importance_report")
]


@pytest.mark.parametrize("name", PLANNED)
def test_no_pairs_without_a_key(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize(
    "name,columns",
    [
        ("split", {"doc_id"}),
        ("shingle_counts", {"doc_id", "text"}),
        ("vocabulary", {"text"}),
        ("pattern_record", {"source", "text"}),
        ("batch_counts", {"ts", "event_type", "value", "props"}),
    ],
)
def test_scans_read_only_the_columns_used(spark, name, columns):
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES[name](spark, FOLDER)))
    assert [{c.split(":")[0] for c in r.split(",")} for r in read] == [columns]


def test_slice_bounds_reach_the_scan(spark):
    text = plan(views.scored_messages(spark, FOLDER, since=19730, until=19738))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_samples_and_top_k_are_cut_in_every_task(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["reservoir_sample"](spark, FOLDER))
    assert "TakeOrderedAndProject" in plan(QUERIES["ngram_topk"](spark, FOLDER))
    assert plan(QUERIES["pattern_record"](spark, FOLDER)).count("WindowGroupLimit") == 2
