"""Contiguous shards of near-equal bytes from global prefix sums.

Rows are range-partitioned by id.  Each partition's byte and row totals, one row per
partition, are added up to what precedes it; a running sum inside the partition then gives
every row its place in the whole table without a window over all rows.  The total is cut
at equal targets: a row goes to the shard its middle byte falls into, so a shard misses
its target by half a row at each end at most.

Defined results: a null text has no bytes and counts for the overhead alone; rows with a
null id come first; rows of one id are ordered by size and checksum, repeated rows
stay next to each other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimstream.llm.common import cut

OVERHEAD = 8


def stored_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus what a record costs besides."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("bigint")


def assign(docs: DataFrame, id: str, text: str, shards: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row; ``keep`` names columns to carry on.

    Two shuffles of these narrow rows; no task sees more than a range partition.
    """
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    sized = docs.select(
        id,
        *keep,
        stored_size(F.col(text)).alias("size"),
        F.crc32(content).alias("text_crc32"),
    )
    # The last key only splits rows that are equal in all others.
    placed = cut(
        sized.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(id, "size", "text_crc32", "_tie")
        .sortWithinPartitions(id, "size", "text_crc32", "_tie")
        .withColumn("_tie", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_tie", 33))
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    totals = (
        placed.groupBy("_part")
        .agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
        .select(
            "_part",
            F.coalesce(F.sum("_bytes").over(earlier), zero).alias("_bytes_before"),
            F.coalesce(F.sum("_rows").over(earlier), zero).alias("_rows_before"),
            F.sum("_bytes").over(Window.partitionBy()).alias("_total"),
        )
    )
    # One row per partition of the shuffle, so its size is that of the cluster's plan.
    inside = Window.partitionBy("_part").orderBy("_tie")
    before = F.sum("size").over(inside) - F.col("size") + F.col("_bytes_before")
    numbered = cut(
        placed.join(F.broadcast(totals), "_part")
        .withColumn("_index", F.row_number().over(inside) - 1 + F.col("_rows_before"))
        .withColumn("_middle", 2 * before + F.col("size"))
        .withColumn("shard", F.expr(f"cast(_middle * {shards} div (2 * _total) as int)"))
        .select(id, *keep, "size", "text_crc32", "shard", "_index")
    )
    starts = numbered.groupBy("shard").agg(F.min("_index").alias("_start"))
    return (
        numbered.join(F.broadcast(starts), "shard")
        .withColumn("slot", F.col("_index") - F.col("_start"))
        .select(id, *keep, "size", "text_crc32", "shard", "slot")
    )


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard, its rows in slot order; a large shard is several files."""
    (
        assigned.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .mode("overwrite")
        .parquet(path)
    )
