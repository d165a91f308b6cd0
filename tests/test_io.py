import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from claimstream.session import cut, folder_numbers, fresh_path, scratch
from claimstream.sources import readers, sinks


def test_topic_options():
    assert readers.topic_options("host:9092", "fever-stream", "earliest", False) == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "fever-stream",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    limited = readers.topic_options("host:9092", "predicted-labels", max_per_trigger=1000)
    assert limited["startingOffsets"] == "latest" and limited["maxOffsetsPerTrigger"] == "1000"


def test_raw_lines_that_are_no_json_are_kept_apart(spark):
    path = fresh_path(spark, "lines")
    lines = ['{"claim": "a", "label": "SUPPORTS", "extra": 1}', "garbage", '{"claim": "b"}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    got = {(r.claim, r.label, r._corrupt_record) for r in readers.read_raw(spark, path).collect()}
    assert got == {("a", "SUPPORTS", None), (None, None, "garbage"), ("b", None, None)}


def test_the_key_is_not_part_of_the_value(spark):
    df = spark.createDataFrame([("a", 1)], "claim string, label int")
    assert sinks.as_messages(df, "fever").first().asDict() == {
        "key": "fever",
        "value": '{"claim":"a","label":1}',
    }
    assert sinks.as_messages(df).columns == ["value"]


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet"])
def test_tables_are_replaced(spark, fmt):
    path = fresh_path(spark, "table")
    sinks.write_table(spark.range(9), path, fmt)
    sinks.write_table(spark.range(5), path, fmt, partitions=2)
    back = spark.read.schema("id long").option("header", "true").format(fmt).load(path)
    assert sorted(r.id for r in back.collect()) == list(range(5))


def test_batches_are_keyed_and_states_looked_up_before_them(spark):
    path = fresh_path(spark, "batches")
    schema = spark.range(1).schema
    assert readers.snapshot_before(spark, path, 3, schema).count() == 0
    for batch, n in [(0, 2), (1, 3), (2, 4), (1, 5)]:
        sinks.write_batch(spark.range(n), path, batch)
    counts = {r.batch_id: r["count"] for r in spark.read.parquet(path).groupBy("batch_id").count().collect()}
    assert counts == {0: 2, 1: 5, 2: 4}
    assert readers.snapshot_before(spark, path, 0, schema).count() == 0
    assert readers.snapshot_before(spark, path, 2, schema).count() == 5
    assert readers.snapshot_before(spark, path, 9, schema).count() == 4


def test_latest_state(spark):
    df = spark.createDataFrame(
        [("a", 1, 10), ("a", 3, 30), ("b", 2, 20)], "key string, batch_id int, n int"
    )
    got = {tuple(r) for r in readers.latest_state(df, ["key"]).collect()}
    assert got == {("a", 3, 30), ("b", 2, 20)}


def test_tables_are_dealt_out_only_if_asked(spark):
    path = fresh_path(spark, "files")
    spark.range(100).coalesce(1).write.parquet(path)
    assert readers.read_table(spark, path).rdd.getNumPartitions() == 1
    dealt = readers.read_table(spark, path, 5)
    assert dealt.rdd.getNumPartitions() == 5
    assert dealt.agg(F.sum("id")).first()[0] == 4950


def test_options_reach_the_writer_of_a_batch(spark):
    path = fresh_path(spark, "options")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    for _ in range(2):
        sinks.write_batch(rows, path, 3, "csv", options={"sep": ";", "header": "true"})
    back = spark.read.text(path).where("value not like 'id%'")
    assert sorted((r.value, r.batch_id) for r in back.collect()) == [("1;a", 3), ("2;b", 3)]


def test_whole_states_are_pruned(spark):
    path = fresh_path(spark, "states")
    for batch in range(6):
        sinks.write_state(spark.range(batch), path, batch)
    assert folder_numbers(spark, path, "batch_id") == [3, 4, 5]
    assert readers.snapshot_before(spark, path, 5, spark.range(1).schema).count() == 4


def test_keyed_states_hold_the_newest_row_of_each_key(spark):
    path, schema = fresh_path(spark, "keyed"), "key string, n bigint"
    newest = {}
    for batch in range(11):
        rows = [(f"k{batch % 4}", batch), ("always", batch)]
        newest |= dict(rows)
        frame = spark.createDataFrame(rows, schema)
        sinks.write_keyed_state(frame, path, batch, ["key"], compact_every=3)
        got = readers.keyed_state(spark, path, ["key"], frame.schema)
        assert dict(got.collect()) == newest
    before = readers.keyed_state(spark, path, ["key"], frame.schema, before=10)
    assert dict(before.collect())["always"] == 9
    touched = spark.createDataFrame([("k1",), ("new",)], "key string")
    some = readers.keyed_state(spark, path, ["key"], frame.schema, None, touched)
    assert dict(some.collect()) == {"k1": 9}
    assert len(folder_numbers(spark, f"{path}/changes", "batch_id")) < 8


def test_tables_cut_in_a_scope_go_with_it(spark):
    with scratch(spark):
        kept = cut(spark.range(5))
        assert kept.count() == 5
        folder = kept.inputFiles()[0].rsplit("/", 2)[0]
        assert spark.read.parquet(f"{folder}/*").count() == 5
    with pytest.raises(AnalysisException):
        spark.read.parquet(f"{folder}/*").count()
    assert cut(spark.range(5)).count() == 5
