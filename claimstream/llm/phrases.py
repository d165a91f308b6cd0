"""Phrase collocations by dynamic itemset counting.

Brin, Motwani, Ullman, Tsur: "Dynamic Itemset Counting and Implication Rules for Market Basket
Data", 1997.  The texts are dealt into ``SHARDS`` shards that are scanned in turn, round and round.
Words are counted from the first scan on.  A longer phrase is activated once both its
subphrases (all words but the last, all but the first) have been seen ``least`` times, is
counted from the next shard on, and is complete after one full cycle.  So lengths are
counted side by side, and every phrase with enough occurrences gets its exact count: its
subphrases have at least as many, so it is activated at some scan.

What a scan needs to know is, for every phrase, at which scan it reached ``least``: a table of
one byte per slot of a hash, 16 MB at most whatever the data.  Two phrases that share a slot
only activate some phrase early or in vain; counts stay exact, since a phrase's start follows from the
table, which never changes for a slot once set.

A scan counts phrases where the text is read and packs them by bucket; a bucket's rows meet its
counters from the scans before.  Counters are held by a 64-bit hash of the phrase.  Phrases
that are complete and too rare are dropped from them at once.  In the end one more scan finds the words of
the frequent phrases; should two of them share a hash, all is counted anew under another one.

Defined results: a null language counts as ``und``; null and empty texts have no words; phrases do not
cross the pieces of a text; repeated rows count each; an empty table gives no rows; other columns are
not read.  Ties in score go to more occurrences, then to the phrase's UTF-8 bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimstream.llm.common import cut
from claimstream.llm.exchange import mix64
from claimstream.llm.wordhash import Words, feeds, gaps
from claimstream.session import fresh_path, remove

SHARDS = 4
LONGEST = 3
LEAST = 10
FEED_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
# One byte per slot, a slot for so many bytes of text; 16 MB at most whatever the input.
SLOT_TEXT_BYTES = 256
FEWEST_SLOTS, MOST_SLOTS = 1 << 16, 1 << 24
NEVER = 255
# What ends a piece of text, and what stands between words of a piece.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BETWEEN = gaps(PIECE_ENDS + b" \t")
_ENDS = gaps(PIECE_ENDS)
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

COUNTED = "bucket int, keys binary, counts binary, starts binary, firsts binary"
MERGED = COUNTED + ", reached array<int>"
FOUND = "key bigint, lang string, size int, parts array<bigint>, word string"


class _Phrases:
    """The words of texts of one language: ``key`` per word, and whether the next ones are in its piece."""

    def __init__(self, lang: str, texts: list[bytes], seed: int):
        self.words = words = Words(texts, BETWEEN, lower=True)
        salt = np.uint64(xxhash.xxh64_intdigest(lang.encode(), seed))
        self.key = mix64(words.hashes() ^ salt)
        piece = np.cumsum(_ENDS[words.buffer])[words.starts] if len(words.starts) else words.starts
        self.joined = piece[1:] == piece[:-1]

    def keys(self, size: int) -> np.ndarray:
        """Key of the phrase of ``size`` words that starts at each word, in its piece or not."""
        out = self.key
        for k in range(1, size):
            out = mix64(out[: len(self.key) - k] * _C1 + self.key[k:] * _C2 + np.uint64(k))
        return out

    def whole(self, size: int) -> np.ndarray:
        """Whether that phrase lies in one piece."""
        out = np.ones(len(self.key), bool)
        for k in range(1, size):
            out = out[:-1] & self.joined[k - 1 :]
        return out

    def active(self, reached: np.ndarray, scan: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, key, scan it is counted from) of every occurrence of an active phrase."""
        if scan < SHARDS:
            yield 1, self.key, np.zeros(len(self.key), np.uint8)
        mask = np.uint64(len(reached) - 1)
        known = reached[self.key & mask]
        for size in range(2, LONGEST + 1):
            if len(known) < 2:
                return
            start = np.maximum(known[:-1], known[1:]).astype(np.int64) + 1
            whole, keys = self.whole(size), self.keys(size)
            on = whole & (start <= scan) & (scan < start + SHARDS)
            yield size, keys[on], start[on].astype(np.uint8)
            counted = whole & (start <= scan)
            known = np.full(len(keys), NEVER, np.uint8)
            # A slot may be set by another phrase; this one is not known before it is counted.
            known[counted] = np.maximum(reached[keys[counted] & mask], start[counted].astype(np.uint8))


def _by_language(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[list[tuple[str, _Phrases]]]:
    for rows, texts in feeds(batches, 1, FEED_BYTES):
        own: dict[str, list] = {}
        for lang, text in zip(rows.column(0).to_pylist(), texts):
            own.setdefault(lang, []).append(text)
        yield [(lang, _Phrases(lang, own[lang], seed)) for lang in own]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, their summed counts, and the first place of each in the order of keys."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.flatnonzero(new)
    return ordered[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0], order[first]


def _scanned(
    batches: Iterator[pa.RecordBatch], reached: np.ndarray, scan: int, buckets: int, seed: int
) -> Iterator[pa.RecordBatch]:
    for languages in _by_language(batches, seed):
        found = [f for _, phrases in languages for f in phrases.active(reached, scan)]
        if not sum(len(keys) for _, keys, _ in found):
            continue
        every = np.concatenate([keys for _, keys, _ in found])
        long = np.repeat([size == LONGEST for size, *_ in found], [len(keys) for _, keys, _ in found])
        starts = np.concatenate([s for *_, s in found])
        keys, counts, first = _summed(every, np.ones(len(every), np.int64))
        starts, bucket = starts[first], (keys >> np.uint64(32)) % np.uint64(buckets)
        bucket[long[first]] += np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(2 * buckets + 1, dtype=np.uint64))
        rows = []
        for b in np.flatnonzero(np.diff(bounds)).tolist():
            at = order[bounds[b] : bounds[b + 1]]
            firsts = np.full(len(at), scan, np.uint8)
            rows.append((b, keys[at], counts[at].astype(np.uint32), starts[at], firsts))
        yield _packed(rows)


def _packed(rows: list[tuple], reached: list[list[int]] | None = None) -> pa.RecordBatch:
    columns = [pa.array([r[0] for r in rows], pa.int32())]
    columns += [pa.array([r[k].tobytes() for r in rows], pa.binary()) for k in range(1, 5)]
    names = ["bucket", "keys", "counts", "starts", "firsts"]
    if reached is not None:
        columns.append(pa.array(reached, pa.list_(pa.int32())))
        names.append("reached")
    return pa.RecordBatch.from_arrays(columns, names=names)


def _numbers(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), kind)


def _merged(table: pa.Table, scan: int, least: int, buckets: int, slots: int) -> pa.Table:
    """The counters of a bucket with those of one more scan, which come in rows of their own.

    Phrases of the most words are in the buckets from ``buckets`` on: they activate nothing.
    """
    keys = _numbers(table, "keys", np.uint64)
    counts = _numbers(table, "counts", np.uint32).astype(np.int64)
    starts, firsts = _numbers(table, "starts", np.uint8), _numbers(table, "firsts", np.uint8)
    old = np.repeat(table["old"].to_numpy(), [len(k) // 8 for k in table["keys"].to_pylist()])
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.flatnonzero(new)
    total = np.add.reduceat(counts[order], first)
    before = np.add.reduceat(np.where(old, counts, 0)[order], first)
    keys = ordered[first]
    starts, firsts = starts[order][first], np.minimum.reduceat(firsts[order], first)
    bucket = table["bucket"][0].as_py()
    crossed = keys[(total >= least) & (before < least) & (bucket < buckets)] & np.uint64(slots - 1)
    stay = (total >= least) | (scan < starts.astype(np.int64) + SHARDS - 1)
    row = (bucket, keys[stay], total[stay].astype(np.uint32), starts[stay], firsts[stay])
    return pa.Table.from_batches([_packed([row], [np.unique(crossed).astype(np.int32).tolist()])])


def _witnesses(batches: Iterator[pa.RecordBatch], wanted: np.ndarray, seed: int) -> Iterator[pa.RecordBatch]:
    """The words of every phrase whose slot is wanted, once per feed."""
    schema = pa.schema(
        [("key", pa.int64()), ("lang", pa.string()), ("size", pa.int32()), ("parts", pa.list_(pa.int64())), ("word", pa.string())]
    )
    for languages in _by_language(batches, seed):
        for lang, phrases in languages:
            for size in range(1, LONGEST + 1):
                keys = phrases.keys(size)
                if not len(keys):
                    continue
                at = np.flatnonzero(wanted[keys & np.uint64(len(wanted) - 1)] & phrases.whole(size))
                _, first = np.unique(keys[at], return_index=True)
                at = at[first]
                if not len(at):
                    continue
                words = [w.decode() for w in phrases.words.spelled(at)] if size == 1 else [None] * len(at)
                parts = np.stack([phrases.key[at + k] for k in range(size)], 1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[at].view(np.int64)),
                        pa.array([lang] * len(at)),
                        pa.array(np.full(len(at), size, np.int32)),
                        pa.array(parts.tolist(), pa.list_(pa.int64())),
                        pa.array(words, pa.string()),
                    ],
                    schema=schema,
                )


def _sent(spark: SparkSession, table: np.ndarray) -> Broadcast:
    """A table of bytes, which is mostly of one value, packed and sent to the executors."""
    return spark.sparkContext.broadcast(zlib.compress(table.view(np.uint8).tobytes(), 1))


def _received(sent: Broadcast) -> np.ndarray:
    return np.frombuffer(zlib.decompress(sent.value), np.uint8)


def _slots(numbers: DataFrame, slots: int) -> np.ndarray:
    """Which slots are among the numbers, by bitmaps of fixed size."""
    bit = numbers.select((F.col("slot") + 1).alias("bit"))
    parts = bit.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    out = np.zeros(slots, bool)
    for bucket, bits in parts.collect():
        start = (bucket - 1) * len(bits) * 8
        flags = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").view(bool)
        out[start : start + len(flags)] = flags[: slots - start]
    return out


def _counters(spark: SparkSession, folder: str, shards: str, buckets: int, slots: int, least: int, seed: int) -> str:
    """Scan the shards round and round until every active phrase is complete; the path of the counters."""
    reached, path, scan = np.full(slots, NEVER, np.uint8), None, 0
    schema = spark.read.parquet(shards).drop("shard").schema
    while True:
        # A phrase is active for a cycle from the scan after its subphrases are known, which is at
        # most one scan for each word beyond two after the words were.
        oldest = scan - SHARDS - (LONGEST - 2)
        if oldest > 0 and not ((reached >= oldest) & (reached < scan)).any():
            return path
        rows = spark.read.schema(schema).parquet(f"{shards}/shard={scan % SHARDS}")
        sent = _sent(spark, reached)
        counted = rows.mapInArrow(
            lambda batches, n=scan, sent=sent: _scanned(batches, _received(sent), n, buckets, seed), COUNTED
        ).withColumn("old", F.lit(False))
        if path is not None:
            old = spark.read.schema(MERGED).parquet(path).drop("reached").withColumn("old", F.lit(True))
            counted = counted.unionByName(old)
        merged = counted.groupBy("bucket").applyInArrow(lambda t: _merged(t, scan, least, buckets, slots), MERGED)
        before, path = path, f"{folder}/scan-{scan}"
        merged.write.parquet(path)
        if before is not None:
            remove(spark, before)
        crossed = spark.read.schema(MERGED).parquet(path).select(F.explode("reached").alias("slot"))
        reached = reached.copy()
        reached[_slots(crossed, slots) & (reached == NEVER)] = scan
        sent.destroy()
        scan += 1


def _unpacked(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys, counts, firsts in zip(*(batch.column(k).to_pylist() for k in range(3))):
            keys, counts = np.frombuffer(keys, np.int64), np.frombuffer(counts, np.uint32)
            often = counts >= least
            first = np.frombuffer(firsts, np.uint8)[often] % SHARDS
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[often]), pa.array(counts[often].astype(np.int64)), pa.array(first.astype(np.int32))],
                names=["key", "f", "shard"],
            )


def frequent(
    docs: DataFrame, lang: str, text: str, least: int = LEAST, seed: int = 0, fewest_slots: int = FEWEST_SLOTS
) -> DataFrame:
    """(lang, size, key, parts, words, f): every phrase of one to three words with ``least`` occurrences.

    ``parts`` are the keys of its words, ``words`` the words themselves.
    """
    spark = docs.sparkSession
    folder = fresh_path(spark, "phrases")
    shards = f"{folder}/shards"
    given = docs.select(
        F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text")
    )
    shard = F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(SHARDS))
    given.where("text is not null").withColumn("shard", shard).write.partitionBy("shard").parquet(shards)
    for n in range(SHARDS):  # a shard without rows has no folder
        given.where("false").write.mode("append").parquet(f"{shards}/shard={n}")
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(16, int(total // BUCKET_BYTES) + 1)
    slots = min(MOST_SLOTS, max(fewest_slots, 1 << int(total // SLOT_TEXT_BYTES).bit_length()))
    while True:
        path = _counters(spark, f"{folder}/{seed}", shards, buckets, slots, least, seed)
        packed = spark.read.schema(MERGED).parquet(path).select("keys", "counts", "firsts")
        counts = cut(
            packed.mapInArrow(lambda batches: _unpacked(batches, least), "key bigint, f bigint, shard int")
        )
        found = None
        for n in range(SHARDS):
            slot = F.col("key").bitwiseAND(F.lit(slots - 1))
            sent = _sent(spark, _slots(counts.where(F.col("shard") == n).select(slot.alias("slot")), slots))
            rows = spark.read.schema(given.schema).parquet(f"{shards}/shard={n}")
            seen = rows.mapInArrow(lambda batches, sent=sent: _witnesses(batches, _received(sent).view(bool), seed), FOUND)
            found = seen if found is None else found.unionByName(seen)
        found = found.groupBy("key", "lang", "size", "parts").agg(F.min("word").alias("word"), F.max("word").alias("other"))
        named = cut(found.join(counts.drop("shard"), "key"))
        clash = named.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        if clash.isEmpty() and named.where("word != other").isEmpty():
            break
        seed += 1
    remove(spark, folder)
    words = named.where("size = 1").select(F.col("key").alias("part"), F.col("word").alias("spelled"))
    each = named.select("key", F.posexplode("parts").alias("at", "part")).join(words, "part")
    spelled = each.groupBy("key").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "spelled"))), lambda w: w["spelled"]).alias("words")
    )
    return cut(named.select("lang", "size", "key", "parts", "f").join(spelled, "key"))


def totals(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, n): all words of each language."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")), PIECE_ENDS.decode() + "\t", " " * (len(PIECE_ENDS) + 1))
    n = F.size(F.split(F.btrim(low), " +")) - (F.btrim(low) == "").cast("int")
    return docs.groupBy(F.coalesce(F.col(lang), F.lit("und")).alias("lang")).agg(F.sum(n).cast("bigint").alias("n"))


def _exact(*factors: Column | int) -> Column:
    out = F.lit(1).cast("decimal(38,0)")
    for factor in factors:
        out = (out * (F.lit(factor) if isinstance(factor, int) else factor).cast("decimal(19,0)")).cast("decimal(38,0)")
    return out


def collocations(counted: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words or more that no longer phrase stands for.

    ``counted`` comes from ``frequent``.  A phrase goes if a longer one that holds it has at least half its count.
    """
    f = counted.select(F.col("lang"), F.col("parts"), F.col("f"))
    long = counted.where("size > 1")
    cuts = long.select(
        "lang", "key", "size", "f", "parts", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    )
    left = f.select("lang", F.col("parts").alias("left"), F.col("f").alias("l"))
    right = f.select("lang", F.col("parts").alias("right"), F.col("f").alias("r"))
    sides = cuts.select(
        "key",
        "lang",
        "f",
        "k",
        F.slice("parts", 1, F.col("k")).alias("left"),
        F.slice("parts", F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    scored = sides.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    quotient = F.expr("number div divisor")
    scored = scored.withColumns(
        {"number": _exact(1_000_000, F.col("f"), F.col("f")), "divisor": _exact(F.col("l"), F.col("r"))}
    ).withColumn("score", quotient)
    lowest = scored.groupBy("key").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    held = long.where("size > 2").select(
        "lang",
        F.col("f").alias("longer"),
        F.explode(F.array(F.expr("slice(parts, 1, size - 1)"), F.expr("slice(parts, 2, size - 1)"))).alias("parts"),
    )
    held = held.groupBy("lang", "parts").agg(F.max("longer").alias("longer"))
    standing = long.join(held, ["lang", "parts"], "left").where("longer is null or 100 * longer < 50 * f")
    return standing.join(lowest, "key").select(
        "lang",
        F.array_join("words", " ").alias("phrase"),
        F.col("f").alias("a"),
        F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"),
        F.col("cut.score").alias("score"),
    )


def best(found: DataFrame, most: int) -> DataFrame:
    """The first ``most`` of each language with their rank."""
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return found.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= most)
