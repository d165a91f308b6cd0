"""Streams cut by a manifest, and the index of near-duplicates that goes on from batch to batch."""

import pytest
from pyspark.sql import functions as F

from claimstream.operators import lsh
from claimstream.plans import views
from claimstream.session import fresh_path
from claimstream.sources import readers, sinks
from claimstream.streaming import jobs

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sliced(spark, messages, slice, limit=1, files=1):
    path = fresh_path(spark, "slices")
    dealt = messages.repartition(files).withColumn("slice", slice)
    sinks.write_slices(dealt, path, "slice")
    return readers.stream_slices(spark, path, messages.schema, slices_per_trigger=limit)


def claims(spark, texts):
    """Messages of (id, text)."""
    made = spark.createDataFrame(texts, "id bigint, claim string")
    return made.select("id", F.to_json(F.struct("claim")).alias("value"))


def links(spark, stream, out, checkpoint=None):
    jobs.similar_to_earlier(
        stream, "id", out, checkpoint or f"{out}/_run", F.col("claim"), trigger=jobs.ALL_THEN_STOP
    ).awaitTermination()
    return spark.read.parquet(f"{out}/links")


@pytest.mark.parametrize("limit, sizes", [(1, [100, 100, 800]), (2, [200, 800])])
def test_batches_are_slices_whatever_the_files(spark, limit, sizes):
    messages = views.scored_messages(spark, FOLDER)
    slice = F.when(F.col("id") < 100, 0).when(F.col("id") < 200, 1).otherwise(5)
    found = []
    for files in (1, 9):
        out = fresh_path(spark, "table")
        stream = sliced(spark, messages, slice, limit, files)
        jobs.to_table(stream, out, f"{out}-run", ["id"], trigger=jobs.ALL_THEN_STOP).awaitTermination()
        found.append(rows(spark.read.parquet(out).select("batch_id", "id")))
        assert [r[1] for r in rows(spark.read.parquet(out).groupBy("batch_id").count())] == sizes
    assert found[0] == found[1]


def test_a_timed_trigger_takes_slice_after_slice(spark):
    out = fresh_path(spark, "table")
    stream = sliced(spark, views.scored_messages(spark, FOLDER), F.col("id") % 3)
    running = jobs.to_table(stream, out, f"{out}-run", ["id"], trigger={"processingTime": "1 second"})
    try:
        running.processAllAvailable()
        started = [p["timestamp"] for p in running.recentProgress if p["numInputRows"] > 0]
    finally:
        running.stop()
    assert len(set(started)) == 3
    table = spark.read.parquet(out)
    assert table.where(F.col("id") % 3 != F.col("batch_id")).count() == 0 and table.count() == 1000


def test_slices_added_later_are_taken_after_a_restart(spark):
    path, out = fresh_path(spark, "slices"), fresh_path(spark, "table")
    messages = views.scored_messages(spark, FOLDER)
    sinks.write_slices(messages.where("id < 500").withColumn("slice", F.lit(0)), path, "slice")

    def run():
        stream = readers.stream_slices(spark, path, messages.schema)
        jobs.to_table(stream, out, f"{out}-run", ["id"], trigger=jobs.ALL_THEN_STOP).awaitTermination()
        return spark.read.parquet(out).count()

    assert run() == 500
    later = messages.where("id >= 500").withColumn("slice", F.lit(1))
    sinks.write_slices(later, path, "slice")
    assert run() == 1000
    with pytest.raises(Exception, match="already has the slices"):
        sinks.write_slices(later, path, "slice")


def test_a_row_without_a_slice_is_an_error(spark):
    rows = spark.createDataFrame([(1, None)], "id int, slice bigint")
    with pytest.raises(Exception, match="without a slice"):
        sinks.write_slices(rows, fresh_path(spark, "slices"), "slice")


def test_index_equals_the_links_of_the_whole_table(spark):
    docs = views.documents(spark, FOLDER)
    expected = rows(lsh.bucket_links(docs, "id", F.col("claim")))
    messages = docs.select("id", F.to_json(F.struct("claim")).alias("value"))
    slice = F.floor(F.col("id") / 45).cast("bigint")
    out = fresh_path(spark, "index")
    assert rows(links(spark, sliced(spark, messages, slice), out).drop("batch_id")) == expected


def test_index_goes_on_through_batches(spark):
    same = "the same nine words stand in this very claim"
    texts = [(5, same), (6, None), (7, ""), (8, "quite other words are in the eighth one"), (3, same), (9, same), (4, same)]
    messages, batch = claims(spark, texts), {5: 0, 6: 0, 7: 0, 8: 0, 3: 1, 9: 2, 4: 2}
    slice = F.coalesce(*[F.when(F.col("id") == i, n) for i, n in batch.items()])
    stream, out = sliced(spark, messages, slice), fresh_path(spark, "index")
    got = links(spark, stream, out)
    # The first to come stays first; its own row comes with the second claim of the bucket.
    assert rows(got.select("batch_id", "first_id", "id").distinct()) == [(1, 5, 3), (1, 5, 5), (2, 5, 4), (2, 5, 9)]
    written = rows(got)
    assert rows(links(spark, stream, out, f"{out}/_again")) == written
    changed = spark.read.parquet(f"{out}/index/changes")
    bands = lsh.bands_for()[0]
    assert rows(changed.groupBy("batch_id").count()) == [(0, 2 * bands), (1, bands), (2, bands)]
    assert rows(changed.where("batch_id = 2").select("first_id", "claims").distinct()) == [(5, 4)]
