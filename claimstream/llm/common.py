"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstream.session import shared_folder

# The white space of the contracts, as a Java pattern and as characters.
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARACTERS = " \t\n\x0b\x0c\r"
HEAVY_KEYS = 1000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The rows as written to the shared checkpoint folder; lineage ends here."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def split_words(text: Column) -> Column:
    """Words between white space; an empty array when there is none, null for null."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARACTERS))
    none = F.array().cast("array<string>")
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACES)).when(text.isNotNull(), none)


def held_out(id: Column) -> Column:
    """Rows kept out of all training: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def attach(rows: DataFrame, summary: DataFrame, key: str, size: str) -> DataFrame:
    """Left-join one summary row per key onto ``rows``; ``size`` counts the key's rows.

    Keys with over a thousandth of all rows number under a thousand: their summaries
    are broadcast and their rows are not shuffled.  Rows without a key are not shuffled either.
    Both sides are read more than once, so they should be cut or cheap.
    """
    summary = cut(summary)
    heavy_from = rows.count() / HEAVY_KEYS
    heavy = F.broadcast(summary.where(F.col(size) > heavy_from))
    light = summary.where(F.col(size) <= heavy_from)
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in summary.schema if f.name != key]
    keyed = rows.where(F.col(key).isNotNull())
    return (
        keyed.join(heavy, key)
        .unionByName(keyed.join(heavy.select(key), key, "left_anti").join(light, key, "left"))
        .unionByName(rows.where(F.col(key).isNull()).select("*", *extra))
    )


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    while name in df.columns:
        name += "_"
    return name
