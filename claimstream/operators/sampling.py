"""Uniform samples and splits that depend on row ids only.

A row's place in the sample follows from a seeded hash of its id.  The k smallest
hashes are a uniform sample without replacement, two samples merge by taking the k
smallest of both, and reading a batch twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimstream.functions.hashing import HASH_RANGE, priority, small_hash
from claimstream.functions.scored import CATEGORIES


def reservoir(df: DataFrame, id: str, k: int = 100, seed: int = 42) -> DataFrame:
    """A uniform sample of k rows; every task keeps k rows, then the smallest k win."""
    ranked = df.withColumn("priority", priority(F.col(id), seed))
    return ranked.orderBy("priority", id).limit(k)


def merge_reservoirs(old: DataFrame, new: DataFrame, id: str, k: int = 100) -> DataFrame:
    """The sample of two inputs from the samples of each; a row seen twice counts once."""
    both = old.unionByName(new).dropDuplicates([id])
    return both.orderBy("priority", id).limit(k)


def sample_distribution(sample: DataFrame) -> DataFrame:
    """Rows and percent of the sample per outcome, all four outcomes listed."""
    spark = sample.sparkSession
    names = spark.createDataFrame([(c,) for c in CATEGORIES], "prediction_category string")
    counts = sample.groupBy("prediction_category").agg(F.count("*").alias("n"))
    listed = names.join(counts, "prediction_category", "left").select(
        "prediction_category", F.coalesce("n", F.lit(0)).alias("sample_count")
    )
    total = F.sum("sample_count").over(Window.partitionBy())
    return listed.withColumn(
        "percent",
        F.when(total > 0, F.col("sample_count") * 100.0 / total).otherwise(F.lit(0.0)),
    )


def split(df: DataFrame, id: str, fraction: float = 0.8, seed: int = 42) -> DataFrame:
    """Mark each row as train or not; the mark does not depend on the partitioning."""
    drawn = small_hash(F.concat_ws(":", F.lit(str(seed)), F.col(id).cast("string")))
    return df.withColumn("is_train", drawn < int(fraction * HASH_RANGE))
