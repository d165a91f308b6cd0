import json

from pyspark.sql import functions as F

from claimstream.functions import scored as S
from claimstream.operators import sampling
from claimstream.operators import scored as ops


def messages(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id int, value string")


def value(label, predicted, claim="c"):
    return json.dumps(
        {"claim": claim, "entity_redacted_claim": "r", "label": label, "predicted_label": predicted}
    )


EDGE = [
    (value(1, 0.5), "true_positive"),
    (value("true", 0.4999), "false_negative"),
    (value("TRUE", "0.7"), "true_positive"),
    (value(0, 1.0), "false_positive"),
    (value("false", 0), "true_negative"),
    (value(None, 0.9), None),
    (value(1, None), None),
    (value(1, "x"), None),
    ("garbage", None),
    (None, None),
]


def test_edge_rows_are_classified_or_rejected(spark):
    parsed = ops.parse_scored(messages(spark, [v for v, _ in EDGE]), ["id"])
    assert parsed.count() == len(EDGE)
    good = {r.id: r.prediction_category for r in ops.with_category(parsed).collect()}
    assert good == {i: c for i, (_, c) in enumerate(EDGE) if c}
    bad = {r.id for r in ops.rejects(parsed).collect()}
    assert bad == {i for i, (_, c) in enumerate(EDGE) if c is None}
    bits = parsed.select("id", S.positive_bit(F.col("predicted_label")).alias("b")).collect()
    assert {r.id for r in bits if r.b} == {0, 2, 3, 5}


def test_messages_are_parsed_once(spark):
    parsed = ops.with_category(ops.parse_scored(messages(spark, [v for v, _ in EDGE])))
    plan = parsed.select("prediction_category")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_quality_and_zero_denominators(spark):
    rows = [("a", c) for c in ["true_positive"] * 3 + ["false_positive"] + ["true_negative"] * 4 + ["false_negative"] * 2]
    rows += [("b", "true_negative")] * 2
    df = spark.createDataFrame(rows, "batch_id string, prediction_category string")
    got = {r.batch_id: r for r in ops.quality(ops.confusion(df, ["batch_id"])).collect()}
    a, b = got["a"], got["b"]
    assert (a.batch_size, a.true_positives, a.false_positives) == (10, 3, 1)
    assert (a.true_negatives, a.false_negatives) == (4, 2)
    assert a.accuracy == 0.7 and a.precision == 0.75 and a.recall == 0.6
    assert abs(a.f1_score - 2 * 0.75 * 0.6 / 1.35) < 1e-12
    assert (b.accuracy, b.precision, b.recall, b.f1_score) == (1.0, 0.0, 0.0, 0.0)


def test_head_sample_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("b"), "id")
    first = ops.head_sample(df, ["b"], ["id"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted((r.b, r.id) for r in first.collect()) == sorted((i % 3, i) for i in range(15))


def test_reservoir_merges_and_ignores_replays(spark):
    df = spark.range(5000).withColumn("prediction_category", F.lit("true_positive")).repartition(7)
    whole = {r.id for r in sampling.reservoir(df, "id", 100).collect()}
    left = sampling.reservoir(df.where("id < 1234"), "id", 100)
    right = sampling.reservoir(df.where("id >= 1234"), "id", 100)
    merged = sampling.merge_reservoirs(left, right, "id", 100)
    assert {r.id for r in merged.collect()} == whole and len(whole) == 100
    again = sampling.merge_reservoirs(merged, right, "id", 100)
    assert {r.id for r in again.collect()} == whole


def test_reservoir_is_uniform(spark):
    hits = [0] * 10
    df = spark.range(1000).withColumn("decile", F.floor(F.col("id") / 100))
    for seed in range(12):
        for r in sampling.reservoir(df, "id", 100, seed).select("decile").collect():
            hits[r.decile] += 1
    assert all(75 < h < 170 for h in hits)


def test_distribution_lists_all_outcomes(spark):
    df = spark.createDataFrame([("true_positive",)] * 3 + [("false_negative",)], "prediction_category string")
    got = {r.prediction_category: (r.sample_count, r.percent) for r in sampling.sample_distribution(df).collect()}
    assert got == {
        "true_positive": (3, 75.0),
        "false_positive": (0, 0.0),
        "true_negative": (0, 0.0),
        "false_negative": (1, 25.0),
    }
    empty = sampling.sample_distribution(df.where("false")).collect()
    assert {(r.sample_count, r.percent) for r in empty} == {(0, 0.0)}


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(4000)
    a = {r.id for r in sampling.split(df.repartition(3), "id").where("is_train").collect()}
    b = {r.id for r in sampling.split(df.coalesce(1), "id").where("is_train").collect()}
    assert a == b and 0.77 < len(a) / 4000 < 0.83
