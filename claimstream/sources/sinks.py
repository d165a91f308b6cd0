"""Batch writers.  Everything written from a micro-batch is keyed by its batch id."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimstream.session import folder_numbers, remove
from claimstream.sources.readers import keyed_state, state_parts

FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro", "text")


def as_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """One JSON value per row, with an optional constant key that is not part of the value."""
    messages = df.select(F.to_json(F.struct("*")).alias("value"))
    return messages if key is None else messages.select(F.lit(key).alias("key"), "value")


def publish(
    df: DataFrame,
    fmt: str,
    options: dict[str, str],
    key: str | None = None,
    encoded: bool = False,
) -> None:
    """Publish rows as messages; ``fmt`` is kafka on a cluster, any file format in tests.

    ``encoded`` rows are messages already.
    """
    messages = df if encoded else as_messages(df, key)
    messages.write.format(fmt).options(**options).mode("append").save()


def write_table(df: DataFrame, path: str, fmt: str, partitions: int | None = None) -> None:
    """Write a whole table as json, csv or parquet."""
    out = df if partitions is None else df.repartition(partitions)
    options = {"header": "true"} if fmt == "csv" else {}
    out.write.format(fmt).options(**options).mode("overwrite").save(path)


def write_batch(
    df: DataFrame,
    path: str | None,
    batch_id: int,
    fmt: str = "parquet",
    partitions: int | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Write the rows of one micro-batch under batch_id=<n>; a replay replaces them.

    A format that is not one of files gets the rows appended with their batch id as a
    column, by which the receiver can drop the first copy of a batch that came twice.
    """
    out = df if partitions is None else df.repartition(partitions)
    writer = out.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.format(fmt)
    writer = writer.options(**{k: v for k, v in (options or {}).items() if path is None or k != "path"})
    if fmt in FILE_FORMATS:
        writer.partitionBy("batch_id").mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).save(path)
    elif path is None:
        writer.mode("append").save()
    else:
        writer.mode("append").save(path)


def write_slices(df: DataFrame, path: str, number: str, fmt: str = "parquet") -> None:
    """Write rows in slices by the integer column ``number``, and a manifest that names them in order.

    An entry is written once its slice is complete, one file after the other, so readers that take
    the oldest file first get the slices in order.  More slices may be written later; a number that
    is there already is an error, as are rows without one.
    """
    spark = df.sparkSession
    slice = F.coalesce(F.col(number), F.raise_error(F.lit("a row without a slice")).cast("bigint"))
    rows = f"{path}/rows-{uuid.uuid4().hex}"
    df.withColumn(number, slice).write.partitionBy(number).format(fmt).save(rows)
    new = folder_numbers(spark, rows, number)
    twice = {*new} & {*folder_numbers(spark, f"{path}/manifest", "number")}
    if twice:
        remove(spark, rows)
        raise ValueError(f"{path} already has the slices {sorted(twice)}")
    for n in new:
        entry = spark.createDataFrame([(f"{rows}/{number}={n}",)], "folder string")
        entry.coalesce(1).write.json(f"{path}/manifest/number={n}")


def write_state(df: DataFrame, path: str, batch_id: int, keep: int = 3) -> None:
    """Write a whole state as of a batch and drop all but the last few before it."""
    write_batch(df, path, batch_id)
    spark = df.sparkSession
    older = [n for n in folder_numbers(spark, path, "batch_id") if n < batch_id]
    for n in older[: len(older) - keep + 1]:
        remove(spark, f"{path}/batch_id={n}")


def write_keyed_state(
    df: DataFrame, path: str, batch_id: int, keys: list[str], compact_every: int = 16
) -> None:
    """Write the rows of the keys a batch has changed.

    After some batches the changes are put together with the whole state before them, and what
    only older batches needed goes.
    """
    spark, schema = df.sparkSession, StructType(df.schema.fields)
    write_batch(df, f"{path}/changes", batch_id)
    base, changes = state_parts(spark, path, batch_id + 1)
    if len(changes) < compact_every:
        return
    whole = keyed_state(spark, path, keys, schema, before=batch_id + 1)
    write_batch(whole, f"{path}/base", batch_id)
    if base is not None:
        for folder in ("base", "changes"):
            for n in folder_numbers(spark, f"{path}/{folder}", "batch_id"):
                if n < base or (n == base and folder == "changes"):
                    remove(spark, f"{path}/{folder}/batch_id={n}")
