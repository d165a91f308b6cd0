"""Frequent word n-grams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimstream.functions.text import tokens, word_ngrams
from claimstream.session import cut

# So many rows of hashes are copied to every task; more, as many ties or groups give, are left to the optimizer.
FEW = 1 << 16


def pattern_counts(df: DataFrame, text: Column, by: Sequence[str] = (), n: int = 3) -> DataFrame:
    """How often each word n-gram occurs, repeats within a text included."""
    grams = word_ngrams(df, by, text, n)
    return grams.groupBy(*by, "pattern").agg(F.count("*").alias("count"))


def _frequent(hashed: DataFrame, k: int) -> DataFrame:
    """(_group, _hash) of the n-grams that are among the k most frequent of their group, ties included.

    Groups and n-grams go by 64-bit hashes, so that none is shuffled as text.  An n-gram is only
    counted too high where two share a hash, which may let it in.
    """
    counts = hashed.groupBy("_group", "_hash").agg(F.count("*").alias("count"))
    rank = F.rank().over(Window.partitionBy("_group").orderBy(F.col("count").desc()))
    return cut(counts.withColumn("_rank", rank).where(F.col("_rank") <= k).select("_group", "_hash"))


def top_patterns(
    df: DataFrame,
    text: Column,
    k: int = 20,
    by: Sequence[str] = (),
    n: int = 3,
    words: Callable[[Column], Column] = tokens,
) -> DataFrame:
    """The k most frequent n-grams, per group if asked; ties go alphabetically.

    The texts are read twice: for the counts by hash, and for the few n-grams that may be listed.
    """
    by = list(by)
    grams = word_ngrams(df, by, text, n, words=words)
    grams = grams.withColumns({"_group": F.xxhash64(*(by or [F.lit(0)])), "_hash": F.xxhash64("pattern")})
    frequent = _frequent(grams.select("_group", "_hash"), k)
    if frequent.count() <= FEW:
        frequent = F.broadcast(frequent)
    listed = grams.join(frequent, ["_group", "_hash"], "left_semi")
    counts = listed.groupBy(*by, "pattern").agg(F.count("*").alias("count"))
    order = [F.col("count").desc(), F.col("pattern")]
    if not by:
        return counts.orderBy(*order).limit(k)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k)


def pattern_record(
    df: DataFrame,
    text: Column,
    by: Sequence[str],
    k: int = 50,
    n: int = 3,
    words: Callable[[Column], Column] = tokens,
) -> DataFrame:
    """One row per group with its top patterns as an array, most frequent first."""
    top = top_patterns(df, text, k, by, n, words)
    entries = F.sort_array(F.collect_list(F.struct("rank", "pattern", "count")))
    return top.groupBy(*by).agg(
        F.transform(
            entries, lambda e: F.struct(e["pattern"].alias("pattern"), e["count"].alias("count"))
        ).alias("patterns")
    )
