"""Queries without SQL, on a fixture with a known answer: good texts have a word bad ones lack."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from claimstream.operators import classifier
from claimstream.plans.queries import QUERIES


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("tables")
    n = 200
    texts = [f"common word{i % 7} {'rotten' if i % 3 == 0 else 'sound'} end" for i in range(n)]
    documents = {"doc_id": list(range(n)), "text": texts, "lang": ["en"] * n, "source": ["s"] * n}
    pq.write_table(pa.table(documents), f"{out}/documents.parquet")
    ids = [i for i in range(n) if i % 2]  # every other document has no label
    labels = {"doc_id": ids, "quality": [int(i % 3 != 0) for i in ids], "toxic": [0] * len(ids)}
    pq.write_table(pa.table(labels), f"{out}/labels.parquet")
    return str(out)


def test_every_claim_is_published_and_scored(spark, folder):
    sent = QUERIES["publish_keyed"](spark, folder).collect()
    assert len(sent) == 200 and sum(r.label is None for r in sent) == 100
    scored = QUERIES["claim_predictions"](spark, folder).collect()
    assert {r.id: r.predicted_label for r in scored} == {i: float(i % 3 == 0) for i in range(200)}
    assert all((r.label is None) == (r.id % 2 == 0) for r in scored)


def test_accuracy_against_the_commoner_class(spark, folder):
    row = QUERIES["model_accuracy"](spark, folder).first()
    assert row.accuracy == 1.0 and 0.5 <= row.commoner_class < 1.0 and row.test_rows > 0
    assert QUERIES["train_eval"](spark, folder).first().at_least_guessing


def test_weights_words_and_report(spark, folder):
    weights = QUERIES["feature_weights"](spark, folder).collect()
    assert [abs(r.importance) for r in weights] == sorted((abs(r.importance) for r in weights), reverse=True)
    words = {r.possible_words: r for r in QUERIES["feature_word_lists"](spark, folder).collect()}
    assert words["rotten"].coefficient > 0 > words["sound"].coefficient
    assert words["rotten"].influence == classifier.RAISES and words["sound"].influence == classifier.LOWERS
    report = QUERIES["influence_report"](spark, folder).collect()
    assert {(r.influence, r.possible_words) for r in report if r.rank == 1} == {
        (classifier.RAISES, "rotten"),
        (classifier.LOWERS, "sound"),
    }
