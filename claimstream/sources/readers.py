"""Batch and streaming readers."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from claimstream.operators.spread import same_keys
from claimstream.schemas import CLAIM, RAW
from claimstream.session import folder_numbers


# An entry of a manifest: the place of a slice in the order, and the folder of its rows.
ENTRY = "number bigint, folder string"


def read_claims(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned claims from JSON lines; the schema is fixed, so the input is read once."""
    return spark.read.schema(CLAIM).json(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Labelled corpus lines; a line that is no JSON lands in ``_corrupt_record``."""
    return spark.read.schema(RAW).json(path)


def read_table(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """A parquet table, dealt out anew only if the caller says into how many partitions."""
    table = spark.read.parquet(path)
    return table if partitions is None else table.repartition(partitions)


def topic_options(
    servers: str,
    topic: str,
    starting: str = "latest",
    fail_on_data_loss: bool = True,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options of a topic; the broker's connector jar comes with the cluster."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def stream_topic(spark: SparkSession, servers: str, topic: str, **settings) -> DataFrame:
    """A topic as a stream; see ``topic_options`` for the settings."""
    options = topic_options(servers, topic, **settings)
    return spark.readStream.format("kafka").options(**options).load()


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "json",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A folder as a stream, oldest file first, with an optional rate limit."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


class Slices(NamedTuple):
    """A stream cut into batches by a manifest instead of by the files its rows lie in."""

    entries: DataFrame
    schema: StructType
    fmt: str

    def rows(self, batch: DataFrame) -> DataFrame:
        """The rows of the slices that a batch of entries names; a batch has as many as its limit."""
        folders = [entry["folder"] for entry in batch.orderBy("number").collect()]
        return batch.sparkSession.read.schema(self.schema).format(self.fmt).load(folders)


def stream_slices(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    slices_per_trigger: int = 1,
) -> Slices:
    """What ``sinks.write_slices`` wrote, as a rate-limited stream of whole slices.

    A batch is the same rows however many files hold them, and a replayed batch reads the same
    slices again, since the checkpoint holds their manifest entries.
    """
    entries = stream_files(spark, f"{path}/manifest", ENTRY, "json", slices_per_trigger)
    return Slices(entries, schema, fmt)


def latest_state(snapshots: DataFrame, keys: list[str], version: str = "batch_id") -> DataFrame:
    """The newest snapshot row of each key."""
    value = F.struct(*[c for c in snapshots.columns if c not in keys])
    return snapshots.groupBy(*keys).agg(F.max_by(value, version).alias("_row")).select(
        *keys, "_row.*"
    )


def snapshot_before(
    spark: SparkSession, path: str, batch_id: int, schema: StructType
) -> DataFrame:
    """The snapshot of the newest batch before this one; empty when there is none.

    Only that snapshot's folder is read.  A replayed batch therefore starts from the same
    state as its first run.
    """
    older = [n for n in folder_numbers(spark, path, "batch_id") if n < batch_id]
    if not older:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/batch_id={older[-1]}")


def state_parts(spark: SparkSession, path: str, before: int | None = None) -> tuple[int | None, list[int]]:
    """The newest whole state of ``write_keyed_state`` and the changes since, by batch id."""
    whole = [n for n in folder_numbers(spark, f"{path}/base", "batch_id") if before is None or n < before]
    base = whole[-1] if whole else None
    changes = folder_numbers(spark, f"{path}/changes", "batch_id")
    return base, [n for n in changes if (before is None or n < before) and (base is None or n > base)]


def keyed_state(
    spark: SparkSession,
    path: str,
    keys: list[str],
    schema: StructType,
    before: int | None = None,
    touched: DataFrame | None = None,
) -> DataFrame:
    """The newest row of each key, as of the batch ``before``; of the ``touched`` keys if given."""
    base, changes = state_parts(spark, path, before)
    folders = [] if base is None else [(base, f"{path}/base/batch_id={base}")]
    folders += [(n, f"{path}/changes/batch_id={n}") for n in changes]
    versioned = StructType([*schema.fields, StructField("batch_id", LongType())])
    rows = spark.createDataFrame([], versioned)
    for n, folder in folders:
        rows = rows.unionByName(
            spark.read.schema(schema).parquet(folder).withColumn("batch_id", F.lit(n).cast("bigint"))
        )
    if touched is not None:
        rows = same_keys(rows, touched.select(*keys), keys, "left_semi")
    return latest_state(rows, keys).drop("batch_id")


def operator_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Keys and values a keyed stateful operator holds in the checkpoint of its query.

    As of the newest finished batch, or of ``batch_id``.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    held = reader.load(checkpoint)
    return held.select("key.*", "value.groupState.*")
