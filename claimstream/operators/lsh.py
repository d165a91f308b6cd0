"""Near-duplicate claims by banded MinHash.

Two claims are similar when they agree on all rows of at least one band.  A bucket of
similar claims may hold a large part of the table, so claims are never paired inside a
bucket.  Each claim is linked to the first (smallest) id of its bucket instead: per
band, the claims with the same first id are exactly the claims that are similar to each
other, which makes the links a complete record in at most one row per claim and band.
Counts and clusters come straight from the links; ``similar_to`` lists every
similar claim of the claims one asks about.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from claimstream.functions.hashing import PRIME, permutation, small_hash
from claimstream.functions.text import tokens, word_ngrams
from claimstream.operators.spread import same_keys, spread_lookup
from claimstream.session import cut

PERMUTATIONS = 64
THRESHOLD = 0.7


def bands_for(threshold: float = THRESHOLD, permutations: int = PERMUTATIONS) -> tuple[int, int]:
    """Bands and rows per band with the least expected error at a similarity threshold.

    The error is half the area of false positives below the threshold plus half the
    area of false negatives above it, under the collision curve 1 - (1 - s^r)^b.
    """
    step = 0.001
    s = np.arange(step / 2, 1, step)
    choices = []
    for bands in range(1, permutations + 1):
        for rows in range(1, permutations // bands + 1):
            hit = 1 - (1 - s**rows) ** bands
            wrong = np.where(s < threshold, hit, 1 - hit).sum() * step / 2
            choices.append((wrong, bands, rows))
    _, bands, rows = min(choices)
    return bands, rows


def signatures(
    claims: DataFrame,
    id: str,
    text: Column,
    scope: Sequence[str] = (),
    permutations: int = PERMUTATIONS,
    n: int = 3,
    words: Callable[[Column], Column] = tokens,
) -> DataFrame:
    """MinHash signature of the word n-grams of each claim.

    A claim's n-grams lie in one task, so the partial minima leave it as a row per Arrow batch.
    A claim with fewer than n words has its words as its only n-gram; without words it
    has no signature.
    """
    keys = [*scope, id]
    rows = claims.withColumn("_row", F.monotonically_increasing_id())
    grams = word_ngrams(rows, [*keys, "_row"], text, n, short=True, words=words)
    hashed = grams.select(*keys, "_row", small_hash(F.col("pattern")).alias("_hash"))
    drawn = [permutation(i) for i in range(permutations)]
    schema = StructType([*[hashed.schema[k] for k in keys], StructField("_minima", ArrayType(LongType()))])
    parts = hashed.mapInArrow(lambda batches: _minima(batches, drawn), schema)
    least = [F.min(F.get("_minima", F.lit(i))).alias(f"_min{i}") for i in range(permutations)]
    return parts.groupBy(*keys).agg(*least).select(
        *keys, F.array(*[f"_min{i}" for i in range(permutations)]).alias("signature")
    )


def _minima(batches: Iterator[pa.RecordBatch], drawn: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """The least permuted hashes of each run of rows of one claim.

    One permutation at a time, so that its numbers stay in the cache.  PRIME is 2^31 - 1: the high and
    the low bits of a number below 2^61 add up to its remainder, or to that and PRIME once more.
    """
    prime, bits = np.uint64(PRIME), np.uint64(PRIME.bit_length())
    drawn = [(np.uint64(a), np.uint64(b)) for a, b in drawn]
    for batch in batches:
        if not len(batch):
            continue
        row, hashes = (batch.column(c).to_numpy() for c in ("_row", "_hash"))
        starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        hashes, least = hashes.astype(np.uint64), np.empty((len(starts), len(drawn)), np.int64)
        for i, (factor, offset) in enumerate(drawn):
            permuted = hashes * factor + offset
            permuted = (permuted >> bits) + (permuted & prime)
            # Below PRIME the difference wraps around to a number that is never the smaller one.
            least[:, i] = np.minimum.reduceat(np.minimum(permuted, permuted - prime), starts)
        ends = np.arange(0, least.size + 1, len(drawn), dtype=np.int32)
        keys = [batch.column(c).take(pa.array(starts)) for c in range(batch.num_columns - 2)]
        names = [*batch.schema.names[:-2], "_minima"]
        yield pa.RecordBatch.from_arrays([*keys, pa.ListArray.from_arrays(ends, least.ravel())], names=names)


def buckets(
    signed: DataFrame, id: str, scope: Sequence[str] = (), bands: int = 8, rows: int = 8
) -> DataFrame:
    """One row per claim and band with the bucket the claim falls into."""
    entries = [
        F.struct(
            F.lit(band).alias("band"),
            F.md5(
                F.concat_ws("-", F.slice("signature", band * rows + 1, rows).cast("array<string>"))
            ).alias("bucket"),
        )
        for band in range(bands)
    ]
    return signed.select(*scope, id, F.inline(F.array(*entries)))


def bucket_links(
    claims: DataFrame,
    id: str,
    text: Column,
    scope: Sequence[str] = (),
    threshold: float = THRESHOLD,
    permutations: int = PERMUTATIONS,
    words: Callable[[Column], Column] = tokens,
) -> DataFrame:
    """(band, first_id, id) for every claim in a bucket of two or more, the first included.

    With a ``scope`` (such as a batch id) claims are similar within their scope only.
    The buckets are checkpointed: they are read twice and cost a pass over all texts.
    """
    bands, rows = bands_for(threshold, permutations)
    signed = signatures(claims, id, text, scope, permutations, words=words)
    placed = cut(buckets(signed, id, scope, bands, rows))
    key = [*scope, "band", "bucket"]
    shared = (
        placed.groupBy(*key)
        .agg(F.min(id).alias("first_id"), F.count("*").alias("_claims"))
        .where(F.col("_claims") > 1)
        .drop("_claims")
    )
    return spread_lookup(placed, shared, key, id).select(*scope, "band", "first_id", id)


def nearest(links: DataFrame, id: str, scope: Sequence[str] = ()) -> DataFrame:
    """Each claim that has an earlier similar claim, with the earliest one as ``cluster_id``."""
    return (
        links.where(F.col(id) > F.col("first_id"))
        .groupBy(*scope, id)
        .agg(F.min("first_id").alias("cluster_id"))
    )


def similar_claims(
    links: DataFrame, claims: DataFrame, id: str, text: str, scope: Sequence[str] = ()
) -> DataFrame:
    """Each claim with the first claim of every bucket it shares, and both texts.

    At most one row per claim and band.  The texts of linked claims are picked out of the
    whole table once; a frequent first claim is looked up in slices.
    """
    linked = links.select(*scope, id).distinct()
    texts = cut(same_keys(claims.select(*scope, id, text), linked, [*scope, id]))
    found = links.where(F.col(id) > F.col("first_id")).select(
        *scope, id, F.col("first_id").alias("similar_id")
    ).distinct()
    first_texts = texts.withColumnsRenamed({id: "similar_id", text: "similar_text"})
    own_texts = texts.withColumnRenamed(text, "claim_text")
    looked_up = spread_lookup(found, first_texts, [*scope, "similar_id"], id)
    return same_keys(looked_up, own_texts, [*scope, id])


def nest_similar(rows: DataFrame, id: str, scope: Sequence[str] = ()) -> DataFrame:
    """One record per claim with its similar claims as an array, at most one per band."""
    entry = F.struct(F.col("similar_id").alias("id"), F.col("similar_text").alias("text"))
    return rows.groupBy(*scope, id).agg(
        F.first("claim_text").alias("claim_text"),
        F.sort_array(F.collect_list(entry)).alias("similar_claims"),
    )


def similar_to(
    links: DataFrame, asked: DataFrame, id: str, scope: Sequence[str] = ()
) -> DataFrame:
    """All earlier similar claims of the asked claims, one row per match.

    The result is as large as the number of matches, so ask about some claims, not all.
    """
    bucket = [*scope, "band", "first_id"]
    mine = same_keys(links, asked.select(*scope, id).distinct(), [*scope, id])
    mine = mine.withColumnRenamed(id, "_asked")
    return (
        spread_lookup(links, mine, bucket, id)
        .where(F.col(id) < F.col("_asked"))
        .select(*scope, F.col("_asked").alias(id), F.col(id).alias("similar_id"))
        .distinct()
    )


def clusters(links: DataFrame, id: str, scope: Sequence[str] = ()) -> DataFrame:
    """(cluster_id, id): clusters named by the earliest similar claim, one hop only.

    At most one row per claim, under the earliest claim it is similar to.  Claims that
    overlap with a cluster in another way are listed by ``cluster_members``.
    """
    return nearest(links, id, scope).select(*scope, "cluster_id", id)


def cluster_members(
    links: DataFrame, asked: DataFrame, id: str, scope: Sequence[str] = ()
) -> DataFrame:
    """(cluster_id, id) of the asked clusters, with all earlier claims similar to their own.

    For those it is enough to know, per bucket and cluster, the last claim that belongs:
    the bucket's claims before it are in.  One claim may be in many clusters, so ask about
    some of them, not all.
    """
    bucket = [*scope, "band", "first_id"]
    chosen = asked.select(*scope, "cluster_id").distinct()
    named = same_keys(nearest(links, id, scope), chosen, [*scope, "cluster_id"])
    reach = (
        same_keys(links, named, [*scope, id])
        .groupBy(*bucket, "cluster_id")
        .agg(F.max(id).alias("_last"))
    )
    others = (
        spread_lookup(links, reach, bucket, id)
        .where((F.col(id) < F.col("_last")) & (F.col(id) != F.col("cluster_id")))
        .select(*scope, "cluster_id", id)
    )
    return named.select(*scope, "cluster_id", id).unionByName(others).distinct()


def summary(
    claims: DataFrame, links: DataFrame, id: str, scope: Sequence[str], bit: Column
) -> DataFrame:
    """Per scope: rows, positive rows, and claims with an earlier similar claim."""
    counted = claims.groupBy(*scope).agg(
        F.count("*").alias("row_count"), F.sum(bit).alias("positive_count")
    )
    similar = nearest(links, id, scope).groupBy(*scope).agg(F.count("*").alias("similar_count"))
    return same_keys(counted, similar, scope, "left").fillna(0, ["similar_count"])
