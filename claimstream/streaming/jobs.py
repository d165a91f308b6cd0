"""The streaming jobs.  Each starts a checkpointed query; a failure stops the query.

The stateful jobs work in foreachBatch with the batch operators, so a stream gives the
numbers a batch run over the same rows gives, and a key that fills a micro-batch is split
like any other.  Whatever a batch writes is keyed by its batch id, and the state it starts
from is that of the batch before it: running a batch again changes nothing.  They take a
stream of messages, or the slices of a manifest (``readers.stream_slices``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from claimstream.functions import scored as S
from claimstream.functions.text import choose_text, joined_tokens, split_joined
from claimstream.operators import classifier, dgim, lsh, patterns, positions, sampling
from claimstream.operators import scored as ops
from claimstream.operators.spread import same_keys, spread_lookup
from claimstream.schemas import CLAIM
from claimstream.session import cut, scratch
from claimstream.sources.readers import Slices, keyed_state, snapshot_before
from claimstream.sources.sinks import (
    FILE_FORMATS,
    as_messages,
    publish,
    write_batch,
    write_keyed_state,
    write_state,
)

EVERY_5_SECONDS = {"processingTime": "5 seconds"}
EVERY_15_SECONDS = {"processingTime": "15 seconds"}
EVERY_30_SECONDS = {"processingTime": "30 seconds"}
ALL_THEN_STOP = {"availableNow": True}


def _per_batch(
    stream: DataFrame | Slices, parse, work, checkpoint: str, trigger: dict
) -> StreamingQuery:
    """Run ``work`` on every batch as ``parse`` makes it; a batch is parsed and kept once."""
    sliced = isinstance(stream, Slices)

    def unless_empty(batch: DataFrame, batch_id: int) -> None:
        parsed = parse(stream.rows(batch) if sliced else batch).persist()
        try:
            if not parsed.isEmpty():
                with scratch(parsed.sparkSession):
                    work(parsed, batch_id)
        finally:
            parsed.unpersist()

    return (
        (stream.entries if sliced else stream)
        .writeStream.foreachBatch(unless_empty)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def score_topic(
    messages: DataFrame,
    model: PipelineModel,
    fmt: str,
    options: dict[str, str],
    checkpoint: str,
    trigger: dict = EVERY_5_SECONDS,
    rejects: str | None = None,
) -> StreamingQuery:
    """Score a topic of claims with a fitted model and publish the decisions.

    Messages without a text to score, such as lines that are no JSON, are written to the
    table ``rejects`` (beside the checkpoint if not named) and scoring goes on.  A
    batch that runs again replaces what it wrote to files; to a topic it is sent once more.
    """
    rejected = rejects or f"{checkpoint.rstrip('/')}-rejects"

    def parse(batch: DataFrame) -> DataFrame:
        line = F.col("value").cast("string")
        return batch.select(line.alias("line"), F.inline_outer(F.array(F.from_json(line, CLAIM))))

    def work(parsed: DataFrame, batch_id: int) -> None:
        usable = F.col(classifier.TEXT).isNotNull()
        decided = as_messages(classifier.score(model, parsed.where(usable)))
        if fmt in FILE_FORMATS:
            write_batch(decided, options["path"], batch_id, fmt, options=options)
        else:
            publish(decided, fmt, options, encoded=True)
        write_batch(parsed.where(~usable).select("line"), rejected, batch_id)

    return _per_batch(messages, parse, work, checkpoint, trigger)


def metrics_and_sample(
    messages: DataFrame | Slices,
    id: str,
    out: str,
    checkpoint: str,
    k: int = 100,
    seed: int = 42,
    trigger: dict = EVERY_30_SECONDS,
) -> StreamingQuery:
    """Quality of each batch, a uniform sample of all rows so far, and the rejects.

    ``id`` names a column that is unique per message, such as partition and offset.
    Writes the tables stats, sample, sample_distribution and rejects under ``out``; of the sample
    the last few versions are kept, the total goes on from the stats of the batch before.
    """

    def parse(batch: DataFrame) -> DataFrame:
        return ops.stamp(ops.parse_scored(batch, [id]))

    def work(parsed: DataFrame, batch_id: int) -> None:
        spark = parsed.sparkSession
        parsed = parsed.withColumn("arrival_batch", F.lit(batch_id).cast("bigint"))
        rows = ops.with_category(parsed)
        drawn = sampling.reservoir(rows, id, k, seed)
        earlier = snapshot_before(spark, f"{out}/sample", batch_id, StructType(drawn.schema.fields))
        sample = sampling.merge_reservoirs(earlier, drawn, id, k).persist()
        totals = snapshot_before(
            spark, f"{out}/stats", batch_id, StructType().add("total_processed", LongType())
        )
        before = (totals.first() or [0])[0]
        write_state(sample, f"{out}/sample", batch_id)
        write_batch(sampling.sample_distribution(sample), f"{out}/sample_distribution", batch_id)
        write_batch(ops.rejects(parsed), f"{out}/rejects", batch_id)
        stats = (
            ops.quality(ops.confusion(rows))
            .withColumn("reservoir_sample_count", F.lit(sample.count()))
            .withColumn("reservoir_size", F.lit(k))
            .withColumn("total_processed", F.col("batch_size") + F.lit(before))
        )
        write_batch(ops.stamp(stats), f"{out}/stats", batch_id)
        sample.unpersist()

    return _per_batch(messages, parse, work, checkpoint, trigger)


def positives_in_window(
    messages: DataFrame | Slices,
    keys: Sequence[str],
    order: Sequence[str],
    out: str,
    checkpoint: str,
    window: int = 1000,
    trigger: dict = EVERY_30_SECONDS,
    chunk_rows: int = dgim.CHUNK_ROWS,
) -> StreamingQuery:
    """Approximate number of positives among the last ``window`` rows of each stream.

    Rows must arrive in the order of ``order`` from one batch to the next; a batch with a row
    before the last one of its stream stops the query.  Writes the tables stats and
    raw_sample (the first rows of each batch) and the keyed state under ``out``: a batch
    reads and writes the state of its own streams only.
    """
    keys = list(keys)
    schema = window_state(messages.schema, keys, order)

    def parse(batch: DataFrame) -> DataFrame:
        return ops.parse_scored(batch, [*keys, *order])

    def work(parsed: DataFrame, batch_id: int) -> None:
        spark = parsed.sparkSession
        bits = parsed.select(
            *keys, *order, S.positive_bit(F.col("predicted_label")).alias("is_positive")
        )
        pieces = cut(positions.packed_streams(bits, keys, order, "is_positive"))
        first, last = (
            F.struct(*[F.col(f"_{end}_{i}").alias(c) for i, c in enumerate(order)]) for end in ("first", "last")
        )
        arrived = cut(
            pieces.groupBy(*keys).agg(
                F.min(first).alias("_first"),
                F.max(last).alias("last"),
                F.sum("_ones").alias("actual_count"),
                F.sum("_n").alias("batch_size"),
            )
        )
        state = keyed_state(spark, f"{out}/state", keys, schema, batch_id, arrived)
        late = F.raise_error(F.lit(f"batch {batch_id} has rows before the last one of their stream"))
        known = cut(
            same_keys(state, arrived.select(*keys, "_first"), keys)
            .withColumn("pos", F.when(F.col("_first") <= F.col("last"), late).otherwise(F.col("pos")))
            .drop("_first", "last", "updated_at")
        )
        ends = dgim.window_ends(pieces, keys, window, known, chunk_rows)
        newest = cut(same_keys(ends, arrived.drop("_first"), keys))
        stats = dgim.end_statistics(newest, keys, window)
        write_batch(ops.head_sample(ops.stamp(parsed), [], order), f"{out}/raw_sample", batch_id)
        write_batch(ops.stamp(stats), f"{out}/stats", batch_id)
        stamped = newest.withColumn("updated_at", F.unix_timestamp())
        write_keyed_state(stamped.select(*schema.fieldNames()), f"{out}/state", batch_id, keys)

    return _per_batch(messages, parse, work, checkpoint, trigger)


def window_state(messages: StructType, keys: Sequence[str], order: Sequence[str]) -> StructType:
    """Schema of the state of ``positives_in_window``: a row per stream."""
    return StructType(
        [
            *[messages[c] for c in keys],
            StructField("pos", LongType()),
            StructField("overhang", LongType()),
            StructField("recent", ArrayType(IntegerType())),
            StructField("last", StructType([messages[c] for c in order])),
            StructField("updated_at", LongType()),
        ]
    )


def similar_and_frequent(
    messages: DataFrame | Slices,
    id: str,
    out: str,
    checkpoint: str,
    k: int = 50,
    threshold: float = lsh.THRESHOLD,
    permutations: int = lsh.PERMUTATIONS,
    trigger: dict = EVERY_15_SECONDS,
) -> StreamingQuery:
    """Near-duplicates and frequent n-grams among the positives of each batch.

    Writes the tables clusters, summary and patterns under ``out``.  Signatures and both passes of the
    n-gram counts read the tokens that parsing made: cutting texts by rule costs more than hashing them.
    """

    def parse(batch: DataFrame) -> DataFrame:
        parsed = ops.parse_scored(batch, [id])
        text = choose_text(F.col("entity_redacted_claim"), F.col("claim"))
        positive = F.col("predicted_label") >= S.THRESHOLD
        return parsed.select(id, positive.alias("_positive"), F.when(positive, joined_tokens(text)).alias("_text"))

    def work(parsed: DataFrame, batch_id: int) -> None:
        text = F.col("_text")
        positives = parsed.where("_positive").select(id, "_text").withColumn("_all", F.lit(0))
        links = cut(
            lsh.bucket_links(positives, id, text, ["_all"], threshold, permutations, split_joined)
        )
        counted = lsh.summary(
            positives, links, id, ["_all"], F.lit(1)
        ).drop("_all")
        record = patterns.pattern_record(positives, text, ["_all"], k, words=split_joined).drop("_all")
        members = lsh.clusters(links, id, ["_all"]).drop("_all")
        write_batch(members, f"{out}/clusters", batch_id)
        write_batch(ops.stamp(counted), f"{out}/summary", batch_id)
        write_batch(ops.stamp(record), f"{out}/patterns", batch_id)

    return _per_batch(messages, parse, work, checkpoint, trigger)


def similar_to_earlier(
    messages: DataFrame | Slices,
    id: str,
    out: str,
    checkpoint: str,
    text: Column | None = None,
    threshold: float = lsh.THRESHOLD,
    permutations: int = lsh.PERMUTATIONS,
    trigger: dict = EVERY_15_SECONDS,
) -> StreamingQuery:
    """Near-duplicates of each claim among all claims so far, whatever batch they came in.

    The index is keyed state, a row per band and bucket with the claim that came first (the
    smallest id within a batch) and the number of claims.  A batch reads and writes the rows of
    its own buckets only.  Writes the table links under ``out``: (band, first_id, id) for every
    claim of a bucket of two or more; a bucket's first claim gets its own row when the second
    claim comes.  ``id`` must be unique; claims without words are in no bucket.
    """
    chosen = choose_text(F.col("entity_redacted_claim"), F.col("claim")) if text is None else text
    bands, rows = lsh.bands_for(threshold, permutations)
    bucket = ["band", "bucket"]
    schema = StructType().add("band", IntegerType()).add("bucket", StringType())
    schema = schema.add("first_id", messages.schema[id].dataType).add("claims", LongType())

    def parse(batch: DataFrame) -> DataFrame:
        return ops.parse_scored(batch, [id])

    def work(parsed: DataFrame, batch_id: int) -> None:
        signed = lsh.signatures(parsed, id, chosen, (), permutations)
        placed = cut(lsh.buckets(signed, id, (), bands, rows))
        new = cut(placed.groupBy(*bucket).agg(F.min(id).alias("_new_id"), F.count("*").alias("_new")))
        held = keyed_state(parsed.sparkSession, f"{out}/index", bucket, schema, batch_id, new)
        index = cut(
            same_keys(new, held, bucket, "left").select(
                *bucket,
                F.coalesce("first_id", "_new_id").alias("first_id"),
                F.coalesce("claims", F.lit(0)).alias("_before"),
                (F.coalesce("claims", F.lit(0)) + F.col("_new")).alias("claims"),
            )
        )
        shared = index.where("claims > 1").select(*bucket, "first_id")
        late = index.where("_before = 1").select("band", "first_id", F.col("first_id").alias(id))
        links = spread_lookup(placed, shared, bucket, id).select("band", "first_id", id)
        write_batch(links.unionByName(late), f"{out}/links", batch_id)
        write_keyed_state(index.select(*schema.fieldNames()), f"{out}/index", batch_id, bucket)

    return _per_batch(messages, parse, work, checkpoint, trigger)


def to_table(
    messages: DataFrame | Slices,
    out: str | None,
    checkpoint: str,
    keep: Sequence[str] = (),
    partitions: int | None = None,
    fmt: str = "parquet",
    trigger: dict = EVERY_30_SECONDS,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Append the parsed predictions to a table, in ``partitions`` parts per batch if given.

    ``fmt`` may be any format of the session, a warehouse connector included: ``options``
    go to its writer, and ``out`` is None where the options name the table.
    """

    def parse(batch: DataFrame) -> DataFrame:
        return ops.stamp(ops.parse_scored(batch, keep))

    def work(parsed: DataFrame, batch_id: int) -> None:
        write_batch(parsed, out, batch_id, fmt, partitions, options)

    return _per_batch(messages, parse, work, checkpoint, trigger)


def without_repeats(
    messages: DataFrame,
    id: str,
    time: str,
    delay: str,
    out: str,
    checkpoint: str,
    trigger: dict = EVERY_5_SECONDS,
) -> StreamingQuery:
    """Write each message once although its producer sends it again.

    Ids are remembered for ``delay`` of event time; rows later than that are dropped, so
    ``delay`` must cover the disorder of the input; ``rows_behind_watermark`` counts them.  All
    ids of that time are state: set spark.sql.streaming.stateStore.providerClass to the
    RocksDB provider where they do not fit in memory.
    """
    return (
        messages.withWatermark(time, delay)
        .dropDuplicatesWithinWatermark([id])
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def rows_behind_watermark(query: StreamingQuery) -> int:
    """Rows the reported batches of a query dropped because they came too late."""
    return sum(
        int(operator["numRowsDroppedByWatermark"])
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
