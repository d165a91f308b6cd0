"""Stream positions and bounded chunks of them, however long one stream is."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from claimstream.operators.spread import same_keys
from claimstream.session import cut

CHUNK_ROWS = 65536


def with_positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], base: DataFrame | None = None
) -> DataFrame:
    """Add ``pos``, the 1-based place of each row in its stream.

    ``base`` (keys and ``_base``) holds the rows each stream has had before; ``pos`` then
    counts on from there and ``_base`` stays in the result.

    ``order`` must be unique within a stream.  Rows are range-partitioned by key and
    order, so a long stream spreads over many tasks; the rows in earlier partitions are
    counted and added.  The partitioning is sampled, hence the checkpoint: the counts
    and the rows must come from the same run of it.
    """
    placed = cut(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_slot", 33))
    )
    return _counted_on(placed, keys, F.count("*"), base)


def _counted_on(placed: DataFrame, keys: Sequence[str], rows: Column, base: DataFrame | None) -> DataFrame:
    """``pos`` from the place in the partition; ``rows`` counts those of a stream in a partition."""
    runs = placed.groupBy(*keys, "_part").agg(rows.alias("_rows"), F.min("_slot").alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    runs = runs.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    if base is not None:
        runs = same_keys(runs, base, keys, "left").fillna(0, ["_base"])
        runs = runs.withColumn("_before", F.col("_before") + F.col("_base"))
    return (
        same_keys(placed, runs.drop("_rows"), [*keys, "_part"])
        .withColumn("pos", F.col("_slot") - F.col("_first") + F.col("_before") + 1)
        .drop("_slot", "_part", "_first", "_before")
    )


def utc(table: pa.Table) -> pa.Table:
    """Instants as UTC: they arrive in the session's time zone, but must leave in UTC."""
    for i, field in enumerate(table.schema):
        if pa.types.is_timestamp(field.type) and field.type.tz:
            table = table.set_column(i, field.name, table[i].cast(pa.timestamp("us", "UTC")))
    return table


def _stream_starts(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Where rows in order have other keys than the row before; null keys are alike."""
    new = np.ones(table.num_rows, bool)
    new[1:] = False
    for key in keys:
        column = table[key].combine_chunks()
        mine, other = column.slice(1), column.slice(0, len(column) - 1)
        differ = pc.fill_null(pc.not_equal(mine, other), True)
        alike = pc.and_(pc.is_null(mine), pc.is_null(other))
        new[1:] |= pc.and_not(differ, alike).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def packed_streams(df: DataFrame, keys: Sequence[str], order: Sequence[str], bit: str) -> DataFrame:
    """The bits of each stream in order, a row per stream and Arrow batch.

    ``_bits`` holds them as the characters 0 and 1, ``_n`` and ``_ones`` count them; ``_first_<i>`` and
    ``_last_<i>`` are the i-th order column of the first and the last row.  Rows are range-partitioned as
    for ``with_positions`` and shuffled this once; checkpoint the pieces before ``place_pieces``.
    """
    keys, order = list(keys), list(order)
    ordered = (
        df.select(*keys, *order, F.col(bit).cast("byte").alias("_bit"))
        .repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_part", F.spark_partition_id())
    )
    ends = [StructField(f"_{end}_{i}", df.schema[c].dataType) for end in ("first", "last") for i, c in enumerate(order)]
    numbers = [StructField(c, LongType()) for c in ("_slot", "_n", "_ones")]
    schema = StructType(
        [*[df.schema[k] for k in keys], StructField("_part", IntegerType()), *numbers,
         StructField("_bits", BinaryType()), *ends]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            table = utc(pa.Table.from_batches([batch]))
            starts = _stream_starts(table, keys)
            edges = np.append(starts, table.num_rows)
            bits = table["_bit"].to_numpy()
            characters = pa.py_buffer((bits + ord("0")).astype(np.uint8).tobytes())
            places = pa.py_buffer(edges.astype(np.int32).tobytes())
            head, tail = table.take(pa.array(starts)), table.take(pa.array(edges[1:] - 1))
            counts = (slot + starts, np.diff(edges), np.add.reduceat(bits, starts, dtype=np.int64))
            columns = [
                *[head[c] for c in [*keys, "_part"]],
                *[pa.array(c, pa.int64()) for c in counts],
                pa.Array.from_buffers(pa.binary(), len(starts), [None, places, characters]),
                *[head[c] for c in order],
                *[tail[c] for c in order],
            ]
            yield from pa.table(columns, names=schema.fieldNames()).combine_chunks().to_batches()
            slot += table.num_rows

    return ordered.mapInArrow(pack, schema)


def place_pieces(pieces: DataFrame, keys: Sequence[str], base: DataFrame | None = None) -> DataFrame:
    """``pos`` of the first bit of each piece of ``packed_streams``; see ``with_positions`` for ``base``."""
    return _counted_on(pieces, keys, F.sum("_n"), base)


def in_chunks(
    positioned: DataFrame, window: int, chunk_rows: int = CHUNK_ROWS, base: str | None = None
) -> DataFrame:
    """Lay each stream out in chunks that also hold the ``window`` rows before them.

    Adds ``_chunk`` and ``_carried`` (true for the rows copied from the chunk before).
    Chunks count from the position after ``base``; rows up to ``base`` are context only.
    """
    if chunk_rows < window:
        raise ValueError("a chunk must hold at least one window")
    place = F.col("pos") - (F.col(base) if base else F.lit(0))
    home = F.floor((place - 1) / F.lit(chunk_rows)).cast("bigint")
    chunks = F.when(
        place > (home + 1) * chunk_rows - window, F.array(home, home + 1)
    ).otherwise(F.array(home))
    laid = positioned.withColumn("_home", home).withColumn("_chunk", F.explode(chunks))
    return (
        laid.where(F.col("_chunk") >= 0)
        .withColumn("_carried", F.col("_chunk") != F.col("_home"))
        .drop("_home")
    )


def window_counts(
    positioned: DataFrame,
    keys: Sequence[str],
    bit: str,
    window: int = 1000,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Exact number of ones among the last ``window`` positions at every row.

    Taken as the difference of two running counts: a sliding frame would add up the
    whole window again at every row.
    """
    chunk = Window.partitionBy(*keys, "_chunk").orderBy("pos")
    so_far = chunk.rowsBetween(Window.unboundedPreceding, 0)
    return (
        in_chunks(positioned, window, chunk_rows)
        .withColumn("_ones", F.sum(bit).over(so_far))
        .withColumn("exact", F.col("_ones") - F.lag("_ones", window, 0).over(chunk))
        .where(~F.col("_carried"))
        .drop("_chunk", "_carried", "_ones")
    )
