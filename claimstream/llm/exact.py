"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

Texts are equal when they are after white space is deleted.  Three passes read the
table, each looking harder at fewer rows: the first takes the length, the second a hash of
the first characters where the length is shared, the third the full hash where length and
prefix hash are shared.  Between the passes the shared keys travel as a bitmap of fixed
size, so no text is shuffled and the broadcast does not grow with the data.  Two keys that
meet in one bit only cost a hash more; the groups come from the full hash.

Defined results: null counts as empty; of equal texts the row with the most code
points stays, then the smallest id (nulls last); of rows alike in both, one stays.  An
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimstream.llm.common import SPACES, attach, cut

PREFIX_CHARACTERS = 64
# 2^22 bits: 128 rows of 4 KB, half a megabyte to broadcast whatever the input.
BITMAP_BITS = 1 << 22


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, "")


def _bit(*key: str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(BITMAP_BITS)) + 1


def _shared(keys: DataFrame, *key: str) -> DataFrame:
    """Bitmap of the keys that more than one row has."""
    often = keys.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1")
    bit = often.select(_bit(*key).alias("_b"))
    return bit.groupBy(F.bitmap_bucket_number("_b").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_b")).alias("_bits")
    )


def _marked(rows: DataFrame, bitmap: DataFrame, name: str, *key: str) -> DataFrame:
    """``rows`` with a column that tells whether the key's bit is set."""
    at = F.bitmap_bit_position("_b")
    octet = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    is_set = F.getbit(octet.cast("int"), (at % 8).cast("int")) == 1
    return (
        rows.withColumn("_b", _bit(*key))
        .withColumn("_bucket", F.bitmap_bucket_number("_b"))
        .join(F.broadcast(bitmap), "_bucket", "left")
        .withColumn(name, F.coalesce(is_set, F.lit(False)))
        .drop("_b", "_bucket", "_bits")
    )


def digests(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, _chars, _text, digest): the full hash only where the refinement asks for it.

    ``_text`` is the normalised text, for a caller that goes on with it.
    """
    rows = docs.select(
        id,
        F.coalesce(F.char_length(text), F.lit(0)).alias("_chars"),
        normalised(F.col(text)).alias("_text"),
    ).withColumn("_length", F.char_length("_text"))
    lengths = _shared(rows.select("_length"), "_length")
    prefix = F.xxhash64(F.substring("_text", 1, PREFIX_CHARACTERS))
    same_length = _marked(rows, lengths, "_again", "_length")
    prefixes = _shared(
        same_length.where("_again").select("_length", prefix.alias("_prefix")),
        "_length",
        "_prefix",
    )
    checked = _marked(same_length.withColumn("_prefix", prefix), prefixes, "_twice", "_length", "_prefix")
    full = F.when(F.col("_again") & F.col("_twice"), F.sha2(F.col("_text").cast("binary"), 256))
    return checked.select(id, "_chars", "_text", full.alias("digest"))


def groups(hashed: DataFrame, id: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every row with ``keep_id``, ``group_size`` and ``kept``; a null digest stands alone.

    ``hashed`` has the id, ``_chars`` and ``digest``.  A group may hold a third of all rows:
    the summaries of such groups are broadcast and their rows stay where they are.
    """
    rows = cut(
        hashed.select(id, *keep, "_chars", "digest").withColumn("_row", F.monotonically_increasing_id())
    )
    best = F.struct(-F.col("_chars"), F.col(id).isNull(), F.col(id).alias("id"), F.col("_row"))
    many = (
        rows.where(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.count("*").alias("_size"), F.min(best).alias("_best"))
        .where("_size > 1")
    )
    return attach(rows, many, "digest", "_size").select(
        id,
        *keep,
        F.when(F.col("_size").isNotNull(), F.col("_best.id")).otherwise(F.col(id)).alias("keep_id"),
        F.coalesce("_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.coalesce(F.col("_best._row") == F.col("_row"), F.lit(True)).alias("kept"),
    )
