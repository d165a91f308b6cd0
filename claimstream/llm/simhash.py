"""SimHash near-duplicates within two bits, by one-wildcard segment variants.

A fingerprint is cut into two halves; of two fingerprints that differ in at most two bits,
one half differs in at most one.  So every half is indexed as it is and with each of its
bits deleted, and equal keys are joined and verified.  Fingerprints are compared once
however many documents have them, and found pairs are joined into components.

A bucket of many fingerprints would make a pair of each two.  Fingerprints that
lie in such a bucket are linked another way that needs no pairs: each is indexed under
itself and under its 64 one-bit neighbours.  Two fingerprints share such a key exactly
when they differ in at most two bits, at most 65 fingerprints can share one, and each is
linked to the smallest of them.

Defined results: a text without words, or null, has fingerprint zero and is linked like
any other; rows of one id keep their own fingerprints; a component is named by its
smallest id, null only if all its ids are null.  Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimstream.llm.common import ascii_lower, attach, cut, split_words
from claimstream.llm.graph import components

SHINGLE = 3
BUCKET_PAIRS = 48


def fingerprints(docs: DataFrame, id: str, text: str, n: int = SHINGLE) -> DataFrame:
    """(id, text_key, fingerprint) of every row, 64 bits as a long; the key tells texts apart.

    The shingles of a text are counted where it is read: two bits share one sum of longs,
    and a row of 32 sums per text is all that is shuffled.
    """
    worded = docs.select(
        F.col(id),
        F.monotonically_increasing_id().alias("_row"),
        F.xxhash64(text).alias("text_key"),
        split_words(ascii_lower(F.col(text))).alias("_words"),
    )
    words = worded.select(id, "_row", "text_key", "_words", F.posexplode_outer("_words").alias("_at", "_word"))
    starts = F.coalesce(F.col("_at") <= F.greatest(F.size("_words") - n, F.lit(0)), F.lit(True))
    gram = F.concat_ws(" ", "_word", *[F.get("_words", F.col("_at") + i) for i in range(1, n)])
    hashed = words.where(starts).select(
        id, "_row", "text_key", F.when(F.col("_word").isNotNull(), F.xxhash64(gram)).alias("_h")
    )
    two = F.lit((1 << 32) + 1)
    sums = [
        F.sum(F.shiftrightunsigned("_h", i).bitwiseAND(two)).alias(f"_s{i}") for i in range(32)
    ]
    counted = hashed.groupBy("_row", id, "text_key").agg(F.count("_h").alias("_n"), *sums)
    low, half = F.lit((1 << 32) - 1), F.col("_n")

    def bits(take) -> Column:
        parts = [
            F.when(2 * take(F.col(f"_s{i}")) > half, F.lit(1 << i)).otherwise(F.lit(0).cast("bigint"))
            for i in range(32)
        ]
        return reduce(lambda a, b: a.bitwiseOR(b), parts)

    print32 = F.shiftleft(bits(lambda s: F.shiftrightunsigned(s, 32)), 32).bitwiseOR(
        bits(lambda s: s.bitwiseAND(low))
    )
    return counted.select(id, "text_key", F.coalesce(print32, F.lit(0).cast("bigint")).alias("fingerprint"))


def links(prints: DataFrame, bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """(a, b): fingerprints that differ in one or two bits; enough of them for components.

    ``prints`` has distinct fingerprints.  Buckets of up to ``bucket_pairs`` yield all
    their pairs; the members of larger ones are linked through common neighbours.
    """
    halves = [F.col("fp").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned("fp", 32)]
    keys = []
    for side, half in enumerate(halves):
        tag = side * 64
        keys.append(F.struct(F.shiftleft(F.lit(tag + 32), 32).bitwiseOR(half).alias("key"), F.lit(-1).alias("bit")))
        for i in range(32):
            rest = half.bitwiseAND(F.lit(((1 << 32) - 1) ^ (1 << i)))
            own = F.shiftrightunsigned(half, i).bitwiseAND(F.lit(1)).cast("int")
            key = F.lit((tag + i) << 32).bitwiseOR(rest)
            keys.append(F.struct(key.alias("key"), own.alias("bit")))
    indexed = prints.select("fp", F.inline(F.array(*keys)))
    # A bucket with one half throughout has no pair that differs in its own bit.
    sizes = (
        indexed.groupBy("key")
        .agg(
            F.count("*").alias("n"),
            F.min("bit").alias("lowest"),
            F.max("bit").alias("highest"),
        )
        .where("n > 1 and (lowest = -1 or lowest != highest)")
        .select("key", "n")
    )
    members = cut(indexed.join(sizes, "key"))
    few = members.where(F.col("n") <= bucket_pairs)
    a = few.select("key", F.col("fp").alias("a"), F.col("bit").alias("bit_a"))
    b = few.select("key", F.col("fp").alias("b"), F.col("bit").alias("bit_b"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    other = (F.col("bit_a") < F.col("bit_b")) | ((F.col("bit_a") == -1) & (F.col("a") < F.col("b")))
    pairs = a.join(b, "key").where(other & (apart <= 2)).select("a", "b")

    crowded = members.where(F.col("n") > bucket_pairs).select("fp").distinct()
    near = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)]
    met = (
        crowded.select("fp", F.explode(F.array(*near)).alias("near"))
        .groupBy("near")
        .agg(F.min("fp").alias("a"), F.collect_set("fp").alias("all"))
        .where(F.size("all") > 1)
        .select("a", F.explode("all").alias("b"))
    )
    return pairs.unionByName(met).where("a != b").distinct()


def near_duplicates(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, text_key, fingerprint, component_id, keeps_key) of every row.

    Of a component the row with its smallest id stays, of several such rows the one
    whose text has the key ``keeps_key``.
    """
    printed = cut(fingerprints(docs, id, text))
    first = F.struct(F.col(id).isNull(), F.col(id).alias("id"), F.col("text_key").alias("key"))
    classes = printed.groupBy("fingerprint").agg(
        F.min(first).alias("_first"), F.count("*").alias("_n")
    )
    prints = cut(classes.withColumnRenamed("fingerprint", "fp"))
    found = components(links(prints.select("fp")), "a", "b")
    joined = prints.join(found, prints["fp"] == found["node"], "left").select(
        "fp", "_first", "_n", F.coalesce("component", "fp").alias("component")
    )
    named = joined.groupBy("component").agg(
        F.min("_first").alias("_kept")
    )
    of_print = joined.join(named, "component").select(
        F.col("fp").alias("fingerprint"),
        "_n",
        F.col("_kept.id").alias("component_id"),
        F.col("_kept.key").alias("keeps_key"),
    )
    return attach(printed, of_print, "fingerprint", "_n").drop("_n")


def survivors(docs: DataFrame, id: str, text: str) -> DataFrame:
    """One row of each component, whole.  Rows alike in id and text count as one.

    The texts are shuffled once, to meet the ids that stay.
    """
    found = near_duplicates(docs, id, text)
    stays = F.col(id).eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("keeps_key"))
    stay = found.where(stays).select(F.col(id).alias("stays"), F.col("text_key").alias("with_text")).distinct()
    keyed = docs.select(F.struct("*").alias("row"), F.col(id).alias("id"), F.xxhash64(text).alias("key"))
    same = keyed["id"].eqNullSafe(stay["stays"]) & (keyed["key"] == stay["with_text"])
    return keyed.join(stay, same, "left_semi").dropDuplicates(["id", "key"]).select("row.*")
