"""Approximate count of ones in a sliding window (exponential histogram, DGIM).

Method: Datar, Gionis, Indyk, Motwani, "Maintaining Stream Statistics over Sliding
Windows", 2002, with the oldest bucket counted in full.

The textbook form walks one stream bit by bit.  Here a stream of any length is worked
on in parallel, with the same numbers.  The bucket sizes at any moment follow from their
sum, and the sum exceeds the exact window count by the ones that left the window while
their bucket was still alive - call that the overhang.  The overhang grows by one
whenever a one leaves the window, and falls to zero when it reaches the size of the oldest
bucket.  With ``h`` ones in the window just before a one leaves, the overhang resets at a
power of two ``s`` exactly when ``s <= h < 3 s``; so from one reset the next one can be
looked up, and a chunk of the stream is a small table from overhang at entry to overhang
at exit.  The tables of all chunks are built in parallel and chained in a tree.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from claimstream.operators.positions import CHUNK_ROWS, in_chunks, place_pieces, with_positions
from claimstream.operators.positions import utc as _utc
from claimstream.operators.spread import same_keys, spread_lookup
from claimstream.session import cut

FAN = 256


def _next_reset(starts: np.ndarray, held: np.ndarray) -> np.ndarray:
    """For a reset after the r-th leaving one, the leaving one of the next reset.

    ``held[j - 1]`` is the window count just before the j-th one leaves; a start of -x
    means an overhang of x at entry.  len(held) + 1 stands for "not in this chunk".
    """
    found = np.full(len(starts), len(held) + 1)
    size = 1
    while len(held) and size <= held.max():
        at = starts + size
        inside = (at >= 1) & (at <= len(held)) & (at < found)
        count = held[at[inside] - 1]
        hit = np.flatnonzero(inside)[(size <= count) & (count < 3 * size)]
        found[hit] = at[hit]
        size *= 2
    return found


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of every run of equal values."""
    edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return list(zip(edges[:-1], edges[1:]))


def _window_view(bits: np.ndarray, first: int, window: int):
    """Exact count, whether a one leaves, and the count before, at a chunk's own rows, from ``first`` on."""
    ones = np.concatenate([[0], np.cumsum(bits)])
    at = np.arange(first, len(bits))
    out = np.maximum(at - window, 0)
    exact = ones[at + 1] - ones[np.maximum(at + 1 - window, 0)]
    leaves = (at >= window) & (bits[out] == 1)
    return exact, leaves, ones[at] - ones[out]


def _exit_table(bits: np.ndarray, first: int, window: int) -> list[int]:
    """Overhang at exit of a chunk for every overhang at entry.

    An overhang never exceeds the window count.  Entries that cannot occur are kept
    within that bound too, so that tables can be chained without a special case.
    """
    exact, leaves, held = _window_view(bits, first, window)
    highest, left = int(held[0]), int(leaves.sum())
    starts = np.arange(-highest, left + 1)
    hop = _next_reset(starts, held[leaves])
    hop = np.where(hop > left, starts, hop) + highest
    while not np.array_equal(hop, hop[hop]):
        hop = hop[hop]
    exits = left + highest - hop[: highest + 1][::-1]
    return np.minimum(exits, exact[-1]).tolist()


def _estimates(bits: np.ndarray, first: int, overhang: int, window: int):
    """Exact count and estimate at a chunk's own rows, from ``first`` on."""
    exact, leaves, held = _window_view(bits, first, window)
    held = held[leaves]
    following = _next_reset(np.arange(len(held) + 1), held)
    resets = [-overhang]
    at = _next_reset(np.array([-overhang]), held)[0]
    while at <= len(held):
        resets.append(at)
        at = following[at]
    left = np.cumsum(leaves)
    latest = np.array(resets)[np.searchsorted(resets, left, side="right") - 1]
    return exact, exact + left - latest


def continued(recent: np.ndarray, bits: np.ndarray, overhang: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact count and estimate at every new bit of a stream, given the bits of its last window.

    ``recent`` holds the last ``window`` bits before the new ones, or all there were.
    """
    return _estimates(np.concatenate([recent, bits]), len(recent), overhang, window)


def _in_groups(tables: DataFrame, fan: int) -> tuple[DataFrame, Column]:
    """The exit tables with the ``_group`` of ``fan`` neighbours, and what packs groups into one call."""
    grouped = tables.withColumn("_group", F.floor(F.col("_chunk") / fan).cast("bigint"))
    return grouped, F.floor(F.col("_group") / max(1, FAN // fan)).alias("_pack")


def _chained(tables: DataFrame, keys: list[str], fan: int) -> DataFrame:
    """One exit table for every ``fan`` neighbouring ones."""

    def combine(section: pa.Table) -> pa.Table:
        section = _utc(section).sort_by("_chunk")
        tables, firsts, chains = section["_table"].to_pylist(), [], []
        for a, b in _runs(section["_group"].to_numpy()):
            chained = None
            for table in tables[a:b]:
                table = np.array(table, np.int64)
                # The last chunk of a stream has no table, and needs none.
                chained = table if chained is None or not len(table) else table[chained]
            firsts.append(a)
            chains.append(chained.tolist())
        ones = section.select([*keys, "_group"]).take(pa.array(firsts)).rename_columns([*keys, "_chunk"])
        return ones.append_column("_table", pa.array(chains, pa.list_(pa.int64())))

    grouped, pack = _in_groups(tables, fan)
    fields = [StructField("_chunk", LongType()), StructField("_table", ArrayType(LongType()))]
    schema = StructType([*[tables.schema[k] for k in keys], *fields])
    return cut(grouped.groupBy(*keys, pack).applyInArrow(combine, schema))


def _entry_overhangs(tables: DataFrame, keys: list[str], start: DataFrame, fan: int) -> DataFrame:
    """Overhang at entry of every chunk, from the exit tables and the overhang at the start.

    Neighbouring tables are chained into one until few are left per stream; the entry of
    each group of chunks is then handed down to its members.  Of a stream no task sees more than
    ``fan`` tables, or several groups of them up to ``FAN`` tables.
    """
    grouped, pack = _in_groups(tables, fan)

    def hand_down(section: pa.Table) -> pa.Table:
        section = _utc(section).sort_by("_chunk")
        tables, starts, entries = section["_table"].to_pylist(), section["_start"].to_pylist(), []
        for a, b in _runs(section["_group"].to_numpy()):
            overhang = starts[a]
            for table in tables[a:b]:
                entries.append(overhang)
                overhang = table[overhang] if table else None
        return section.select([*keys, "_chunk"]).append_column(
            "_overhang", pa.array(entries, pa.int64())
        )

    if tables.agg(F.max("_chunk")).first()[0] >= fan:
        above = _entry_overhangs(_chained(tables, keys, fan), keys, start, fan).withColumnsRenamed(
            {"_chunk": "_group", "_overhang": "_start"}
        )
        ready = same_keys(grouped, above, [*keys, "_group"])
    else:
        ready = same_keys(grouped, start, keys)
    fields = [StructField("_chunk", LongType()), StructField("_overhang", LongType())]
    schema = StructType([*[tables.schema[k] for k in keys], *fields])
    return ready.groupBy(*keys, pack).applyInArrow(hand_down, schema)


def dgim(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bit: str,
    window: int = 1000,
    state: DataFrame | None = None,
    chunk_rows: int = CHUNK_ROWS,
    fan: int = FAN,
) -> DataFrame:
    """Position, exact window count and DGIM estimate at every row of every stream.

    ``rows`` holds the key columns, the order columns, the bit (0 or 1) and the columns
    the caller wants back.  ``state`` (from ``dgim_state``) continues earlier rows.
    """
    keys = list(keys)
    rows = rows.withColumn("_bit", F.col(bit).cast("int"))
    zero = F.lit(0).cast("bigint")
    if state is None:
        positioned = with_positions(rows, keys, order).withColumn("_base", zero)
        start = positioned.select(*keys).distinct().withColumn("_start", zero)
    else:
        known = state.select(*keys, F.col("pos").alias("_base"), F.col("overhang").alias("_start"))
        positioned = with_positions(rows, keys, order, known.drop("_start"))
        streams = positioned.select(*keys).distinct()
        start = same_keys(streams, known.drop("_base"), keys, "left").fillna(0, ["_start"])
        past = _recent_rows(state, keys).withColumnRenamed("_last", "_base")
        positioned = positioned.unionByName(past, allowMissingColumns=True)
    laid = in_chunks(positioned, window, chunk_rows, base="_base").drop("_base")
    chunk = [*keys, "_chunk"]
    returned = [*rows.columns, "pos"]
    key_fields = [rows.schema[k] for k in keys]
    result_schema = StructType(
        [
            *rows.schema.fields,
            StructField("pos", LongType()),
            StructField("exact", LongType()),
            StructField("estimate", LongType()),
        ]
    )

    # Small chunks are worked on several at a time, up to the rows of one of ordinary size.
    pack = F.floor(F.col("_chunk") / max(1, CHUNK_ROWS // chunk_rows)).cast("bigint").alias("_pack")

    def in_order(section: pa.Table) -> tuple[pa.Table, list, np.ndarray, np.ndarray]:
        section = _utc(section).sort_by([("_chunk", "ascending"), ("pos", "ascending")])
        runs = _runs(section["_chunk"].to_numpy())
        return section, runs, section["_carried"].to_numpy(), section["_bit"].to_numpy()

    def tabulate(section: pa.Table) -> pa.Table:
        section, runs, carried, bits = in_order(section)
        places, tables = [], []
        for a, b in runs:
            first = int(carried[a:b].sum())
            if first < b - a:
                places.append(a)
                tables.append(_exit_table(bits[a:b], first, window) if b - a - first == chunk_rows else [])
        ones = section.select(chunk).take(pa.array(places, pa.int64()))
        return ones.append_column("_table", pa.array(tables, pa.list_(pa.int64())))

    def replay(section: pa.Table, entered: pa.Table) -> pa.Table:
        section, runs, carried, bits = in_order(section)
        own = section.filter(pc.invert(section["_carried"]))
        starts = dict(zip(entered["at__chunk"].to_pylist(), entered["at__overhang"].to_pylist()))
        chunks, counts = section["_chunk"].to_numpy(), []
        for a, b in runs:
            first = int(carried[a:b].sum())
            if first < b - a:
                counts.append(_estimates(bits[a:b], first, starts[chunks[a]], window))
        exact, estimate = np.concatenate(counts, axis=1) if counts else np.empty((2, 0), np.int64)
        return (
            own.select(returned)
            .append_column("exact", pa.array(exact, pa.int64()))
            .append_column("estimate", pa.array(estimate, pa.int64()))
        )

    schema = StructType(
        [*key_fields, StructField("_chunk", LongType()), StructField("_table", ArrayType(LongType()))]
    )
    narrow = laid.select(*chunk, "pos", "_bit", "_carried")
    tables = cut(narrow.groupBy(*keys, pack).applyInArrow(tabulate, schema))
    entry = _entry_overhangs(tables, keys, start, fan)
    entry = entry.withColumn("_pack", pack).select(*[F.col(c).alias(f"at_{c}") for c in [*chunk, "_overhang", "_pack"]])
    together = laid.groupBy(*keys, pack).cogroup(entry.groupBy(*[f"at_{c}" for c in [*keys, "_pack"]]))
    return together.applyInArrow(replay, result_schema).drop("_bit")


def window_ends(
    pieces: DataFrame,
    keys: Sequence[str],
    window: int,
    state: DataFrame,
    chunk_rows: int = CHUNK_ROWS,
    fan: int = FAN,
) -> DataFrame:
    """The state (see ``dgim_state``) of every stream of ``pieces`` after its last bit.

    ``pieces`` comes from ``positions.packed_streams``, checkpointed.  The exit tables of all chunks
    are chained and no row gets an estimate of its own, so rows are shuffled only to be put in order.
    """
    if chunk_rows < window:
        raise ValueError("a chunk must hold at least one window")
    keys = list(keys)
    known = state.select(*keys, F.col("pos").alias("_base"), F.col("overhang").alias("_start"))
    placed = cut(place_pieces(pieces, keys, known.drop("_start")))
    ends = placed.groupBy(*keys).agg(F.max(F.col("pos") + F.col("_n") - 1).alias("_end"))
    n = F.size("recent").cast("bigint")
    past = state.select(
        *keys,
        (-n).alias("_at"),
        n.alias("_n"),
        F.array_join(F.col("recent").cast("array<string>"), "").cast("binary").alias("_bits"),
    )
    at = (F.col("pos") - F.col("_base") - 1).alias("_at")
    low = F.greatest(F.lit(0), F.floor(F.col("_at") / chunk_rows)).cast("bigint")
    high = F.floor((F.col("_at") + F.col("_n") - 1 + window) / chunk_rows).cast("bigint")
    laid = placed.select(*keys, at, "_n", "_bits").unionByName(past)
    laid = laid.withColumn("_chunk", F.explode(F.sequence(low, high)))
    pack = F.floor(F.col("_chunk") / max(1, CHUNK_ROWS // chunk_rows)).cast("bigint").alias("_pack")

    def tabulate(section: pa.Table) -> pa.Table:
        section = _utc(section).sort_by([("_chunk", "ascending"), ("_at", "ascending")])
        begins, pieces = section["_at"].to_pylist(), section["_bits"].to_pylist()
        chunks, places, tables, recent = section["_chunk"].to_numpy(), [], [], []
        for a, b in _runs(chunks):
            own = int(chunks[a]) * chunk_rows
            begin = max(begins[a], own - window)
            bits = np.frombuffer(b"".join(pieces[a:b]), np.uint8)[begin - begins[a] : own + chunk_rows - begins[a]]
            bits = bits.astype(np.int64) - ord("0")
            if len(bits) > own - begin:
                places.append(a)
                tables.append(_exit_table(bits, own - begin, window))
                recent.append(bits[-window:].tolist())
        ones = section.select([*keys, "_chunk"]).take(pa.array(places, pa.int64()))
        ones = ones.append_column("_table", pa.array(tables, pa.list_(pa.int64())))
        return ones.append_column("recent", pa.array(recent, pa.list_(pa.int32())))

    key_fields = [pieces.schema[k] for k in keys]
    fields = [
        StructField("_chunk", LongType()),
        StructField("_table", ArrayType(LongType())),
        StructField("recent", ArrayType(IntegerType())),
    ]
    tabled = cut(laid.groupBy(*keys, pack).applyInArrow(tabulate, StructType([*key_fields, *fields])))
    newest = tabled.groupBy(*keys).agg(F.max_by("recent", "_chunk").alias("recent"))
    tables = tabled.drop("recent")
    while tables.agg(F.max("_chunk")).first()[0] >= fan:
        tables = _chained(tables, keys, fan)

    def last_exit(section: pa.Table) -> pa.Table:
        section = _utc(section).sort_by("_chunk")
        overhang = section["_start"][0].as_py()
        for table in section["_table"].to_pylist():
            overhang = table[overhang]
        return section.select(keys).slice(0, 1).append_column("overhang", pa.array([overhang], pa.int64()))

    started = same_keys(tables, known.drop("_base"), keys, "left").fillna(0, ["_start"])
    overhangs = started.groupBy(*keys).applyInArrow(
        last_exit, StructType([*key_fields, StructField("overhang", LongType())])
    )
    found = same_keys(same_keys(ends, overhangs, keys), newest, keys)
    return found.select(*keys, F.col("_end").alias("pos"), "overhang", "recent")


def _recent_rows(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last window of each stream, back from its state to one row per position."""
    return state.select(
        *keys,
        F.col("pos").alias("_last"),
        F.size("recent").alias("_n"),
        F.posexplode("recent").alias("_i", "_bit"),
    ).select(*keys, "_last", (F.col("_last") - F.col("_n") + 1 + F.col("_i")).alias("pos"), "_bit")


def dgim_state(
    result: DataFrame,
    keys: Sequence[str],
    bit: str,
    window: int = 1000,
    state: DataFrame | None = None,
) -> DataFrame:
    """What the next batch needs per stream: position, overhang and the last window's bits.

    ``result`` comes from ``dgim`` and is read more than once: checkpoint it first.
    Streams without new rows keep their state.
    """
    bits = result.select(*keys, "pos", F.col(bit).cast("int").alias("_bit"))
    ends = result.groupBy(*keys).agg(
        F.max_by(F.col("estimate") - F.col("exact"), "pos").alias("overhang"),
        F.max("pos").alias("_last"),
    )
    if state is not None:
        bits = bits.unionByName(_recent_rows(state, keys).drop("_last"))
        before = state.select(*keys, "overhang", F.col("pos").alias("_last"))
        ends = ends.unionByName(before).groupBy(*keys).agg(
            F.max_by("overhang", "_last").alias("overhang"), F.max("_last").alias("_last")
        )
    kept = spread_lookup(bits, ends, keys, "pos").where(F.col("pos") > F.col("_last") - window)
    in_order = F.sort_array(F.collect_list(F.struct("pos", "_bit")))
    return kept.groupBy(*keys, F.col("_last").alias("pos"), "overhang").agg(
        F.transform(in_order, lambda r: r["_bit"]).alias("recent")
    )


def dgim_total(recent: Column, overhang: Column) -> Column:
    """The estimate a state stands for: the ones of its last window plus the overhang."""
    zero = F.lit(0).cast("bigint")
    return F.aggregate(recent, zero, lambda n, b: n + b.cast("bigint")) + overhang


def dgim_buckets(state: DataFrame, keys: Sequence[str], window: int = 1000) -> DataFrame:
    """The histogram of each stream: its buckets as (size, ts), the newest first.

    With one or two buckets of each power of two, the sizes are the digits of the total
    in bijective base 2; a bucket's time is the position of the newest one it holds.
    """
    n = F.size("recent")
    ones = F.filter(
        F.transform("recent", lambda b, i: F.when(b == 1, F.col("pos") - n + 1 + i)),
        lambda p: p.isNotNull(),
    )
    sizes = F.expr(
        "flatten(transform(sequence(0, levels - 1), m -> array_repeat(shiftleft(1L, m),"
        " 1 + cast(shiftright(total - (shiftleft(1L, levels) - 1), m) & 1 as int))))"
    )
    buckets = F.expr(
        "transform(sizes, (s, i) -> struct(s as size, get(ones, cast(size(ones) - 1"
        " - aggregate(slice(sizes, 1, i), 0L, (a, x) -> a + x) as int)) as ts))"
    )
    return (
        state.withColumn("total", dgim_total(F.col("recent"), F.col("overhang")))
        .withColumn("levels", F.length(F.bin(F.col("total") + 1)) - 1)
        .withColumn("ones", ones)
        .withColumn(
            "sizes",
            F.when(F.col("total") > 0, sizes).otherwise(F.array().cast("array<bigint>")),
        )
        .select(
            *keys,
            F.lit(window).alias("window_size"),
            F.col("pos").alias("stream_position"),
            F.col("total").alias("total_ones"),
            buckets.alias("buckets"),
        )
    )


def batch_statistics(
    result: DataFrame, keys: Sequence[str], batch: str, bit: str, window: int = 1000
) -> DataFrame:
    """One record per stream and batch: estimate at its end against what was counted.

    ``actual_count`` counts the batch's own ones and ``error_percentage`` compares the
    estimate with it; ``exact_window_count`` is the true count the estimate stands for.
    """
    counted = result.groupBy(*keys, batch).agg(
        F.max("pos").alias("stream_position"),
        F.max_by("estimate", "pos").alias("approximate_count"),
        F.max_by("exact", "pos").alias("exact_window_count"),
        F.sum(bit).alias("actual_count"),
        F.count("*").alias("batch_size"),
    )
    return _with_errors(counted, window)


def end_statistics(ends: DataFrame, keys: Sequence[str], window: int = 1000) -> DataFrame:
    """``batch_statistics`` of one batch, from its ``window_ends`` with actual_count and batch_size."""
    counted = ends.select(
        *keys,
        F.col("pos").alias("stream_position"),
        dgim_total(F.col("recent"), F.col("overhang")).alias("approximate_count"),
        dgim_total(F.col("recent"), F.lit(0).cast("bigint")).alias("exact_window_count"),
        "actual_count",
        "batch_size",
    )
    return _with_errors(counted, window)


def _with_errors(counted: DataFrame, window: int) -> DataFrame:
    estimate, actual = F.col("approximate_count"), F.col("actual_count")
    return (
        counted.withColumn("window_size", F.lit(window))
        .withColumn("positive_ratio", estimate / F.lit(window))
        .withColumn(
            "error_percentage",
            F.when(actual > 0, F.abs(estimate - actual) / actual * 100).otherwise(F.lit(0.0)),
        )
    )
