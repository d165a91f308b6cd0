import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from claimstream.functions import scored as S
from claimstream.functions.text import choose_text
from claimstream.operators import classifier, dgim, lsh, sampling
from claimstream.operators import scored as ops
from claimstream.plans import views
from claimstream.session import fresh_path
from claimstream.sources import readers, sinks
from claimstream.streaming import jobs

FOLDER = "/root/testdata/sf0.001"
SLICES = [(0, 300), (300, 320), (320, 700), (700, 1000)]


@pytest.fixture(scope="module")
def messages(spark):
    return views.scored_messages(spark, FOLDER).persist()


def send(messages, path, low, high):
    messages.where(F.col("id").between(low, high - 1)).coalesce(1).write.mode("append").parquet(path)


def stream(spark, messages, path):
    return readers.stream_files(spark, path, messages.schema, "parquet", 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def run_in_parts(spark, messages, start):
    """Send the slices in order, stopping and restarting the query half way."""
    path = fresh_path(spark, "sent")
    for low, high in SLICES[:2]:
        send(messages, path, low, high)
    start(stream(spark, messages, path)).awaitTermination()
    for low, high in SLICES[2:]:
        send(messages, path, low, high)
    start(stream(spark, messages, path)).awaitTermination()


def test_metrics_and_sample_equal_the_batch_operators(spark, messages):
    out = fresh_path(spark, "metrics")

    def start(source):
        return jobs.metrics_and_sample(source, "id", out, f"{out}-run", 50, trigger=jobs.ALL_THEN_STOP)

    run_in_parts(spark, messages, start)
    good = ops.with_category(ops.parse_scored(messages, ["id"]))
    stats = spark.read.parquet(f"{out}/stats").orderBy("batch_id").collect()
    assert [r.batch_size for r in stats] == [300, 20, 380, 300]
    assert [r.total_processed for r in stats] == [300, 320, 700, 1000]
    assert [r.reservoir_sample_count for r in stats] == [50] * 4
    total = ops.confusion(good).first()
    assert sum(r.true_positives for r in stats) == total.true_positives
    assert sum(r.false_negatives for r in stats) == total.false_negatives
    sample = spark.read.parquet(f"{out}/sample").where("batch_id = 3").select("id", "priority")
    assert rows(sample) == rows(sampling.reservoir(good, "id", 50).select("id", "priority"))


def test_window_count_equals_the_batch_operator(spark, messages):
    out = fresh_path(spark, "window")
    keys, order, window = ["key"], ["ts", "id"], 40

    def start(source):
        return jobs.positives_in_window(
            source, keys, order, out, f"{out}-run", window, jobs.ALL_THEN_STOP, chunk_rows=48
        )

    run_in_parts(spark, messages, start)
    bits = ops.parse_scored(messages, ["key", "ts", "id"]).select(
        "key", "ts", "id", S.positive_bit(F.col("predicted_label")).alias("is_positive")
    )
    whole = dgim.dgim(bits, keys, order, "is_positive", window)
    ends = whole.groupBy("key").agg(F.max("pos"), F.max_by("exact", "pos"), F.max_by("estimate", "pos"))
    newest = readers.latest_state(spark.read.parquet(f"{out}/stats"), keys)
    state = readers.keyed_state(
        spark, f"{out}/state", keys, jobs.window_state(messages.schema, keys, order)
    )
    assert {r.key: r.pos for r in state.collect()} == {r[0]: r[1] for r in ends.collect()}
    assert rows(
        newest.select("key", "stream_position", "exact_window_count", "approximate_count")
    ) == rows(ends)
    stats = spark.read.parquet(f"{out}/stats")
    assert stats.agg(F.sum("batch_size")).first()[0] == 1000
    sampled = spark.read.parquet(f"{out}/raw_sample").groupBy("batch_id").count()
    assert sampled.agg(F.min("count"), F.max("count")).first() == (5, 5)


def test_window_count_does_not_depend_on_files(spark, messages):
    """Slices in many small and uneven files, read in small splits, give the same counts."""
    keys, order, window = ["key"], ["ts", "id"], 40
    ends = []
    for files in (1, 7):
        path, out = fresh_path(spark, "sent"), fresh_path(spark, "window")
        for low, high in SLICES:
            part = messages.where(F.col("id").between(low, high - 1))
            for n in range(files):
                (
                    part.where(F.col("id") % files == n)
                    .coalesce(1)
                    .write.option("maxRecordsPerFile", 11 + 30 * n if files > 1 else 0)
                    .mode("append")
                    .parquet(path)
                )
            jobs.positives_in_window(
                readers.stream_files(spark, path, messages.schema, "parquet"),
                keys, order, out, f"{out}-run", window, jobs.ALL_THEN_STOP,
            ).awaitTermination()
        stats = spark.read.parquet(f"{out}/stats")
        ends.append(rows(stats.select("batch_id", "key", "stream_position", "approximate_count")))
    assert ends[0] == ends[1] and len(ends[0]) > 4


def test_rows_out_of_order_stop_the_window_count(spark, messages):
    path, out = fresh_path(spark, "sent"), fresh_path(spark, "window")

    def run():
        jobs.positives_in_window(
            stream(spark, messages, path), ["key"], ["ts", "id"], out, f"{out}-run",
            trigger=jobs.ALL_THEN_STOP,
        ).awaitTermination()

    send(messages, path, 300, 700)
    run()
    send(messages, path, 0, 300)
    with pytest.raises(StreamingQueryException, match="before the last one"):
        run()


def test_a_batch_touches_the_state_of_its_own_streams_only(spark, messages):
    path, out = fresh_path(spark, "sent"), fresh_path(spark, "window")
    one = messages.where("key = 'click'").limit(50)
    for part in (messages.where("id < 500"), messages.where("id >= 500 and key = 'click'")):
        part.write.mode("append").parquet(path)
        jobs.positives_in_window(
            readers.stream_files(spark, path, messages.schema, "parquet"),
            ["key"], ["ts", "id"], out, f"{out}-run", trigger=jobs.ALL_THEN_STOP,
        ).awaitTermination()
    changed = spark.read.parquet(f"{out}/state/changes").where("batch_id = 1")
    assert [r.key for r in changed.collect()] == ["click"] and one.count() == 50


def test_a_replayed_batch_changes_nothing(spark, messages):
    out = fresh_path(spark, "replayed")
    path = fresh_path(spark, "sent")
    send(messages, path, 0, 300)
    send(messages, path, 300, 1000)

    def tables():
        sample = spark.read.parquet(f"{out}/m/sample").select("batch_id", "id")
        stats = spark.read.parquet(f"{out}/m/stats").select("batch_id", "total_processed")
        state = spark.read.parquet(f"{out}/w/state/changes").drop("updated_at")
        return [rows(t) for t in (sample, stats, state)]

    def run(checkpoint):
        jobs.metrics_and_sample(
            stream(spark, messages, path), "id", f"{out}/m", f"{checkpoint}/m", trigger=jobs.ALL_THEN_STOP
        ).awaitTermination()
        jobs.positives_in_window(
            stream(spark, messages, path), ["key"], ["ts", "id"], f"{out}/w", f"{checkpoint}/w",
            trigger=jobs.ALL_THEN_STOP,
        ).awaitTermination()
        return tables()

    # A new checkpoint makes the query run batches 0 and 1 again over the same output.
    assert run(fresh_path(spark, "run")) == run(fresh_path(spark, "run"))


def test_similar_and_frequent(spark):
    messages = views.document_messages(spark, FOLDER).drop("source")
    path, out = fresh_path(spark, "documents"), fresh_path(spark, "similar")
    messages.coalesce(1).write.parquet(path)
    jobs.similar_and_frequent(
        stream(spark, messages, path), "id", out, f"{out}-run", trigger=jobs.ALL_THEN_STOP
    ).awaitTermination()
    positives = ops.parse_scored(messages, ["id"]).where("predicted_label >= 0.5")
    text = choose_text(F.col("entity_redacted_claim"), F.col("claim"))
    links = lsh.bucket_links(positives, "id", text)
    assert rows(spark.read.parquet(f"{out}/clusters").select("cluster_id", "id")) == rows(
        lsh.clusters(links, "id")
    )
    total = spark.read.parquet(f"{out}/summary").first()
    assert total.row_count == positives.count() and total.similar_count > 0
    record = spark.read.parquet(f"{out}/patterns").first()
    counts = [p["count"] for p in record.patterns]
    assert len(counts) == 50 and counts == sorted(counts, reverse=True)


def test_scores_are_published_as_messages(spark):
    claims = views.claims(spark, FOLDER).drop("id")
    model = classifier.fit(claims, 200)
    topic, out = fresh_path(spark, "topic"), fresh_path(spark, "scores")
    sinks.publish(claims, "parquet", {"path": topic}, key="fever")
    broken = spark.createDataFrame([("fever", "no json"), ("fever", None)], "key string, value string")
    broken.write.mode("append").parquet(topic)
    jobs.score_topic(
        readers.stream_files(spark, topic, "key string, value string", "parquet"),
        model, "parquet", {"path": out}, f"{out}-run", jobs.ALL_THEN_STOP,
    ).awaitTermination()
    published = spark.read.parquet(out)
    rejected = spark.read.parquet(f"{out}-run-rejects")
    assert rows(rejected.select("line")) == [("no json",), (None,)]
    assert set(json.loads(published.first().value)) == {
        "claim", "entity_redacted_claim", "label", "predicted_label"
    }
    expected = classifier.score(model, claims).select("claim", "predicted_label")
    assert rows(ops.parse_scored(published).select("claim", "predicted_label")) == rows(expected)


def test_table_sink_and_repeats(spark, messages):
    path, out = fresh_path(spark, "sent"), fresh_path(spark, "table")
    for low, high in SLICES:
        send(messages, path, low, high)
        send(messages, path, low, high)
    jobs.to_table(
        stream(spark, messages, path), out, f"{out}-run", ["id"], 2, trigger=jobs.ALL_THEN_STOP
    ).awaitTermination()
    table = spark.read.parquet(out)
    assert table.count() == 2000 and table.select("batch_id").distinct().count() == 8
    once = fresh_path(spark, "once")
    jobs.without_repeats(
        stream(spark, messages, path), "id", "ts", "31 days", once, f"{once}-run", jobs.ALL_THEN_STOP
    ).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(once).collect()) == list(range(1000))


def test_a_failing_batch_stops_the_query(spark, messages):
    path, out = fresh_path(spark, "sent"), fresh_path(spark, "never")
    send(messages, path, 0, 50)
    run = jobs.metrics_and_sample(
        stream(spark, messages, path), "no_such_column", out, f"{out}-run", trigger=jobs.ALL_THEN_STOP
    )
    with pytest.raises(StreamingQueryException):
        run.awaitTermination()


def test_the_window_count_estimates_no_single_rows(spark, messages, monkeypatch):
    """Only the ends of the streams are asked for: rows are put in order once and not numbered."""

    def never(*_, **__):
        raise AssertionError("all rows were estimated")

    monkeypatch.setattr(dgim, "dgim", never)
    path, out = fresh_path(spark, "sent"), fresh_path(spark, "window")
    send(messages, path, 0, 300)
    send(messages, path, 300, 1000)
    jobs.positives_in_window(
        stream(spark, messages, path), ["key"], ["ts", "id"], out, f"{out}-run", trigger=jobs.ALL_THEN_STOP
    ).awaitTermination()
    assert spark.read.parquet(f"{out}/stats").agg(F.sum("batch_size")).first()[0] == 1000
