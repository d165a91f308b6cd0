"""Repeated byte strings from merged Burrows-Wheeler transforms.

Every window of 100 bytes is named by its anchor, the least hash among its 24-byte strings.
All occurrences of a window have the same anchor at the same place in them, so they meet
in the anchor's bucket.  Consecutive windows of one anchor form a segment.  Equal segments are
settled by their hash: the first stands for all.  A window reaches at least 38 bytes beyond
its anchor on one side, so of the different segments of an anchor only those matter that agree
with another one on the 38 bytes to the left or to the right: the edges of repeated passages.

Each task sorts its shard of these segments once and sends its Burrows-Wheeler transform to the
bucket.  There the transforms are merged by refining their interleave (Holt, McMillan,
"Merging of multi-string BWTs with applications", 2014): each pass puts the rows in
the order of two more leading bytes, and where these first tell two neighbours apart their
common prefix ends.  After 100 bytes the intervals without such an end are the
strings that stand more than once, and no suffix has been sorted anew.

An anchor with very many different segments, such as one in a notice that a third of all
documents have, would fill one task.  The windows of such anchors go by their own hash instead,
and of equal windows each block of documents sends one.  Anchors of more than one in a hundred
documents of a bounded sample are treated so from the start, others once their
segments have been counted; how an anchor is treated changes nothing in the result.

Defined results: a null or empty text has no bytes; texts under 100 bytes lose nothing;
the texts of rows with one id count as one document, in the order of a hash of theirs, and
rows that are alike in both do not repeat each other; a null id comes after all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimstream.llm import exchange
from claimstream.llm.common import cut
from claimstream.llm.exchange import mix64

WIDTH = 100
GRAM = 24
FLANK = (WIDTH - GRAM) // 2
# Bytes of text a worker hashes at a time; places in a block take 21 bits.
BLOCK_BYTES = 1 << 20
PLACE_BITS = 21
# Documents whose anchors are counted beforehand, and the share of them that makes one frequent.
SAMPLE_ROWS = 2000
FREQUENT = 0.01
# Different segments of one anchor beyond which its windows are hashed one by one.
CROWD = 500
# Bytes of segments that are merged in one task.
MERGE_BYTES = 1 << 19
# Measured: packed bytes of segments per byte of text.
PACKED_SHARE = 0.8

_RANDOM = np.random.default_rng(2014)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = [int(x) | 1 for x in _RANDOM.integers(1, 1 << 62, 8)]

SEGMENTS = (
    "bucket int, id bigint, text bigint, ids binary, texts binary, counts binary,"
    " starts binary, sizes binary, anchors binary, hashes binary, lefts binary, rights binary"
)
FOUND = "id bigint, text bigint, starts binary, sizes binary, anchors binary, crowded binary"
#: A transform of candidate segments (symbols set), or a row of ``exchange.PACKED``.
SHARD = exchange.PACKED + ", symbols binary, rows binary"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 24 bytes at every place, from hashes of 1, 2, 4, 8 and 16 bytes."""
    h, width = _BYTE[data], 1
    eight = None
    while width < 16:
        h = h[:-width] * np.uint64(_ODD[width.bit_length()]) + h[width:]
        width *= 2
        if width == 8:
            eight = h
    return mix64(h[: len(data) - GRAM + 1] * np.uint64(_ODD[6]) + eight[16:])


def least_within(h: np.ndarray, width: int) -> np.ndarray:
    """The least value of every stretch of ``width``."""
    size = 1
    while 2 * size <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: len(h) - (width - size)], h[width - size :]) if size < width else h


def segments(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(document, first window, windows, anchor, hash, left, right) of the segments of a block.

    Left and right are hashes of the anchor with 38 bytes on that side, 0 where the text ends
    before.
    """
    out = []
    for lot in _lots(texts):
        out.append(_segments(texts, lot))
    return tuple(np.concatenate(c) for c in zip(*out))


def _lots(texts: list[bytes]) -> Iterator[list[tuple[int, int, int]]]:
    """Pieces (document, from, to) of a bounded size; pieces of a long text overlap."""
    lot, held = [], 0
    for d, text in enumerate(texts):
        for a in range(0, max(1, len(text)), BLOCK_BYTES):
            b = min(len(text), a + BLOCK_BYTES + WIDTH - 1)
            lot.append((d, a, b))
            held += b - a
            if held >= BLOCK_BYTES // 2:
                yield lot
                lot, held = [], 0
    if lot or not texts:
        yield lot


def _segments(texts: list[bytes], lot: list[tuple[int, int, int]]) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(texts[d][a:b] for d, a, b in lot), np.uint8)
    none = (*[np.zeros(0, np.int64)] * 3, *[np.zeros(0, np.uint64)] * 4)
    if len(data) < WIDTH:
        return none
    place = np.uint64((1 << PLACE_BITS) - 1)
    h = gram_hashes(data) & ~place
    h |= np.arange(len(h), dtype=np.uint64)
    least = least_within(h, WIDTH - GRAM + 1)
    sizes = np.array([b - a for _, a, b in lot])
    ends = np.cumsum(sizes)
    piece = np.repeat(np.arange(len(lot)), sizes)[: len(least)]
    valid = np.arange(len(least)) + WIDTH <= ends[piece]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (piece[1:] != piece[:-1]) | ~valid[:-1]
    starts = np.flatnonzero(new & valid)
    if not len(starts):
        return none
    run = np.cumsum(new & valid) - 1
    number = np.bincount(run[valid], minlength=len(starts))
    # The hash of any stretch from prefix sums of byte values times powers of an odd number.
    one = np.uint64(1)
    power = np.concatenate([[one], np.cumprod(np.full(len(data), _ODD[7], np.uint64))])
    undo = np.concatenate([[one], np.cumprod(np.full(len(data), pow(_ODD[7], -1, 1 << 64), np.uint64))])
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * power[:-1])])

    def stretch(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return mix64((sums[high] - sums[low]) * undo[low] + (high - low).astype(np.uint64))

    content = stretch(starts, starts + number + WIDTH - 1)
    at, of_piece = (least[starts] & place).astype(np.int64), piece[starts]
    begin, end = (ends - sizes)[of_piece], ends[of_piece]
    low, high = np.maximum(at - FLANK, begin), np.minimum(at + GRAM + FLANK, end)
    left = np.where(at - FLANK < begin, np.uint64(0), stretch(low, at + GRAM) | np.uint64(1))
    right = np.where(at + GRAM + FLANK > end, np.uint64(0), stretch(at, high) | np.uint64(1))
    of = np.array([d for d, _, _ in lot])[piece[starts]]
    offset = np.array([a for _, a, _ in lot])[piece[starts]] - (ends - sizes)[piece[starts]]
    return of, starts + offset, number, mix64(least[starts] >> np.uint64(PLACE_BITS)), content, left, right


def _bound(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(rows), 256):
        columns = list(zip(*rows[a : a + 256]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
        )


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(","))])


def _stretches(values: np.ndarray) -> zip:
    """(start, end) of the runs of equal values."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    starts = np.flatnonzero(new)
    return zip(starts.tolist(), np.append(starts[1:], len(values)).tolist())


def _short(anchor: np.ndarray) -> np.ndarray:
    return (anchor >> np.uint64(32)).astype(np.uint32)


def _frequent(rows: DataFrame, share: float) -> np.ndarray:
    """Anchors of more than ``share`` of a sample of documents; at most a few thousand."""
    drawn = rows.select("_id", "_key").orderBy(F.xxhash64("_id", "_key")).limit(SAMPLE_ROWS).distinct()

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, texts in exchange.blocks(batches, 4 * BLOCK_BYTES):
            doc, _, _, anchor, *_ = segments(texts)
            found = np.unique(np.stack([doc.astype(np.uint32), _short(anchor)]), axis=1)[1]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["anchor"])

    counted = (
        rows.join(F.broadcast(drawn), ["_id", "_key"])
        .select("_id", "_key", "_content")
        .mapInArrow(own, "anchor bigint")
        .groupBy("anchor")
        .count()
        .where(F.col("count") > share * SAMPLE_ROWS)
    )
    return np.array(sorted(r["anchor"] for r in counted.collect()), np.uint32)


def _window_values(text: bytes, first: int, number: int) -> np.ndarray:
    """Hashes of consecutive windows, from those of the 24-byte strings that cover them."""
    h = gram_hashes(np.frombuffer(text, np.uint8, number + WIDTH - 1, first))
    total = np.zeros(number, np.uint64)
    for k in (0, 24, 48, 72, WIDTH - GRAM):
        total = mix64(total * np.uint64(_ODD[5]) + h[k : k + number])
    return total


def _pack_windows(ids, keys, texts, doc, first, number, buckets: int) -> Iterator[pa.RecordBatch]:
    """Packed hashes of the windows of the given segments, one by one."""
    if not len(doc):
        return
    value = np.concatenate(
        [_window_values(texts[d], f, n) for d, f, n in zip(doc.tolist(), first.tolist(), number.tolist())]
    )
    begin = np.cumsum(number) - number
    at = np.arange(len(value)) + np.repeat(first - begin, number)
    doc = np.repeat(doc, number)
    order = np.lexsort((at, doc))
    doc, at, value = doc[order], at[order], value[order]
    meet = (value % np.uint64(buckets)).astype(np.int64)
    yield from exchange.pack(ids, keys, doc, at, value, meet, buckets, inside=True)


def _send_segments(
    batches: Iterator[pa.RecordBatch], buckets: int, frequent: np.ndarray
) -> Iterator[pa.RecordBatch]:
    schema = _schema(SEGMENTS)
    for ids, keys, texts in exchange.blocks(batches, 4 * BLOCK_BYTES):
        ids, keys = np.array(ids, np.int64), np.array(keys, np.int64)
        doc, *parts = segments(texts)
        first, _, _, content, _, _ = parts
        if not len(doc):
            continue
        rank = exchange.ranks(ids, keys, doc, first, inside=True)
        again = rank > exchange.first_seen(content, rank)
        rows = []
        own, low, count = (x[again] for x in (doc, *parts[:2]))
        for a, b in _stretches(own):
            d = own[a]
            starts, sizes = (x[a:b].astype(np.uint32).tobytes() for x in (low, count))
            to = hash((int(ids[d]), int(keys[d]))) % buckets
            rows.append((to, int(ids[d]), int(keys[d]), None, None, None, starts, sizes, *[None] * 4))
        often = ~again & np.isin(_short(parts[2]), frequent)
        windows = (x[often] for x in (doc, *parts[:2]))
        for batch in _pack_windows(ids, keys, texts, *windows, buckets):
            named = dict(zip(batch.schema.names, batch.columns)) | {"counts": batch.column("runs")}
            none = pa.nulls(batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([named.get(c, none) for c in schema.names], schema=schema)
        again |= often
        bucket = (parts[2][~again] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        doc, first, number, anchor, content, left, right = (x[~again][order] for x in (doc, *parts))
        for a, b in _stretches(bucket):
            used, counts = np.unique(doc[a:b], return_counts=True)
            rows.append(
                (
                    int(bucket[a]),
                    None,
                    None,
                    ids[used].tobytes(),
                    keys[used].tobytes(),
                    counts.astype(np.uint32).tobytes(),
                    first[a:b].astype(np.uint32).tobytes(),
                    number[a:b].astype(np.uint8).tobytes(),
                    _short(anchor[a:b]).tobytes(),
                    content[a:b].tobytes(),
                    left[a:b].astype(np.uint32).tobytes(),
                    right[a:b].astype(np.uint32).tobytes(),
                )
            )
        yield from _bound(rows, schema)


def _numbers(section: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(section[name].to_pylist()), kind)


def _candidates(section: pa.Table, crowd: int) -> pa.Table:
    """Settles equal segments; passes on the different segments of shared anchors."""
    schema = _schema(FOUND)
    out = []
    for r in section.filter(section["id"].is_valid()).select(["id", "text", "starts", "sizes"]).to_pylist():
        out.append((r["id"], r["text"], r["starts"], r["sizes"], None, None))
    packed = section.filter(section["id"].is_null())
    windows = packed.filter(packed["anchors"].is_null())
    for r in exchange.repeated(windows.rename_columns({"counts": "runs"}), inside=True).to_pylist():
        out.append((r["id"], r["text"], r["starts"], r["sizes"], None, None))
    packed = packed.filter(packed["anchors"].is_valid())
    ids, keys = _numbers(packed, "ids", np.int64), _numbers(packed, "texts", np.int64)
    counts = _numbers(packed, "counts", np.uint32).astype(np.int64)
    first = _numbers(packed, "starts", np.uint32).astype(np.int64)
    number = _numbers(packed, "sizes", np.uint8).astype(np.int64)
    anchor = _numbers(packed, "anchors", np.uint32)
    content = _numbers(packed, "hashes", np.uint64)
    doc = np.repeat(np.arange(len(ids)), counts)
    rank = exchange.ranks(ids, keys, doc, first, inside=True)
    again = rank > exchange.first_seen(content, rank)
    # Rows alike in id and text send the same segment; they count as one.
    _, one, which = np.unique(content, return_index=True, return_inverse=True)
    name = anchor[one].astype(np.uint64) << np.uint64(32)
    matters = np.zeros(len(one), bool)
    for side in (_numbers(packed, "lefts", np.uint32), _numbers(packed, "rights", np.uint32)):
        flank = side[one]
        _, inverse, counts = np.unique(name | flank, return_inverse=True, return_counts=True)
        matters |= (flank > 0) & (counts[inverse] > 1)
    shared, of_name, members = np.unique(name[matters], return_inverse=True, return_counts=True)
    crowd_of = np.zeros(len(one), np.int64)
    crowd_of[matters] = members[of_name]
    several = ~again & matters[which]
    for keep, passed_on in ((again, False), (several, True)):
        own, low, count, names = (x[keep] for x in (doc, first, number, anchor))
        crowded = crowd_of[which[keep]] > crowd
        for a, b in _stretches(own):
            d = own[a]
            out.append(
                (
                    int(ids[d]),
                    int(keys[d]),
                    low[a:b].astype(np.uint32).tobytes(),
                    count[a:b].astype(np.uint32).tobytes(),
                    names[a:b].tobytes() if passed_on else None,
                    crowded[a:b].tobytes() if passed_on else None,
                )
            )
    return pa.Table.from_batches(_bound(out, schema), schema)


def transform(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform of strings, and the place of each row in the joined strings.

    A string ends in an end mark, written 0; a byte is written as its value plus 1, which UTF-8
    leaves room for.  A row has the two symbols before it as one number.  Sorting starts from
    eight symbols at a time and doubles the length where rows are still equal.
    """
    joined = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8) + np.uint8(1)
    n = len(joined)
    padded = np.concatenate([joined, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : k + n]
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    places = np.arange(n)
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, places, 0))
    rank[n] = -1
    step, open_places = 8, np.flatnonzero(~new | np.append(~new[1:], False))
    while len(open_places):
        rows = order[open_places]
        key = rank[rows] * (n + 2) + rank[np.minimum(rows + step, n)] + 1
        by_key = np.argsort(key, kind="stable")
        rows, key = rows[by_key], key[by_key]
        order[open_places] = rows
        new = np.ones(len(rows), bool)
        new[1:] = key[1:] != key[:-1]
        rank[rows] = np.maximum.accumulate(np.where(new, open_places, 0))
        open_places = open_places[~new | np.append(~new[1:], False)]
        step *= 2
    before = joined[order - 1].astype(np.uint16)
    return (joined[order - 2].astype(np.uint16) << np.uint16(8)) | before, order


def merge(symbols: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of several transforms, refined to ``depth`` leading symbols, an even number.

    Returns the merged place of every row, shard after shard, and the interval of
    every merged place: places of one interval share their first ``depth`` symbols.  A pass
    takes each row's two symbols to the front: a stable sort of the interleave by them.
    """
    kind = np.uint8 if len(symbols) <= 256 else np.uint16
    source = np.repeat(np.arange(len(symbols), dtype=kind), [len(s) for s in symbols])
    every = np.concatenate(symbols)
    interval = np.zeros(len(every), np.int32)
    laid = np.empty_like(every)
    for _ in range(depth // 2):
        place = np.argsort(source, kind="stable")
        laid[place] = every
        order = np.argsort(laid, kind="stable")
        symbol, before = laid[order], interval[order]
        ends = np.ones(len(every), bool)
        ends[1:] = (symbol[1:] != symbol[:-1]) | (before[1:] != before[:-1])
        interval = np.cumsum(ends, dtype=np.int32)
        source = source[order]
    return np.argsort(source, kind="stable"), interval


def _send_shards(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The transforms of the candidate segments of this task's documents, by bucket.

    The windows of crowded anchors go along as packed hashes.
    """
    schema = _schema(SHARD)
    for lot in _documents(batches):
        for batch in _crowded_windows(lot, buckets):
            none = pa.nulls(batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, none, none], schema=schema)
        ids = np.array([i for i, *_ in lot], np.int64)
        keys = np.array([k for _, k, *_ in lot], np.int64)
        parts = []
        for d, (_, _, text, spans) in enumerate(lot):
            for span in spans:
                first = np.frombuffer(span["starts"], np.uint32).astype(np.int64)
                number = np.frombuffer(span["sizes"], np.uint32).astype(np.int64)
                names = np.frombuffer(span["anchors"], np.uint32)
                usual = ~np.frombuffer(span["crowded"], bool)
                for f, n, name in zip(first[usual].tolist(), number[usual].tolist(), names[usual].tolist()):
                    parts.append((name % buckets, d, f, n, text[f : f + n + WIDTH - 1]))
        parts.sort(key=lambda p: p[0])
        rows = []
        for a, b in _stretches(np.array([p[0] for p in parts], np.int64)):
            bucket, doc, first, number, content = zip(*parts[a:b])
            shown, order = transform(list(content))
            used, local = np.unique(np.array(doc), return_inverse=True)
            rows.append(
                (
                    int(bucket[0]),
                    None,
                    None,
                    ids[used].tobytes(),
                    keys[used].tobytes(),
                    local.astype(np.uint32).tobytes(),
                    np.array(first, np.uint32).tobytes(),
                    np.array(number, np.uint8).tobytes(),
                    None,
                    shown.tobytes(),
                    order.astype(np.uint16 if len(order) <= 1 << 16 else np.uint32).tobytes(),
                )
            )
        yield from _bound(rows, schema)


def _documents(batches: Iterator[pa.RecordBatch], size: int = 8 << 20) -> Iterator[list[tuple]]:
    lot, held = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            lot.append(row)
            held += sum(len(s["starts"]) * 32 for s in row[3])
            if held >= size:
                yield lot
                lot, held = [], 0
    if lot:
        yield lot


def _merge_shards(section: pa.Table) -> pa.Table:
    """Window runs that come earlier, from merged transforms and from packed hashes."""
    packed = exchange.repeated(section.filter(section["symbols"].is_null()), inside=True)
    section = section.filter(section["symbols"].is_valid())
    if not section.num_rows:
        return packed
    ids, keys, docs, firsts, numbers, texts, symbols, rows = [], [], [], [], [], [], [], []
    for r in section.to_pylist():
        base = sum(map(len, ids))
        ids.append(np.frombuffer(r["ids"], np.int64))
        keys.append(np.frombuffer(r["texts"], np.int64))
        docs.append(np.frombuffer(r["runs"], np.uint32).astype(np.int64) + base)
        firsts.append(np.frombuffer(r["starts"], np.uint32).astype(np.int64))
        numbers.append(np.frombuffer(r["sizes"], np.uint8).astype(np.int64))
        symbols.append(np.frombuffer(r["symbols"], np.uint16))
        # Places take two bytes, as symbols do, unless the transform has more of them than that.
        narrow = len(r["rows"]) == len(r["symbols"])
        rows.append(np.frombuffer(r["rows"], np.uint16 if narrow else np.uint32).astype(np.int64))
    place, interval = merge(symbols, WIDTH)
    out_doc, out_at, out_interval = [], [], []
    base = 0
    for doc, first, number, row in zip(docs, firsts, numbers, rows):
        begin = np.cumsum(number + WIDTH) - (number + WIDTH)
        part = np.searchsorted(begin, row, side="right") - 1
        offset = row - begin[part]
        window = offset < number[part]
        out_doc.append(doc[part[window]])
        out_at.append(first[part[window]] + offset[window])
        out_interval.append(interval[place[base : base + len(row)][window]])
        base += len(row)
    ids, keys = np.concatenate(ids), np.concatenate(keys)
    doc, at, value = map(np.concatenate, (out_doc, out_at, out_interval))
    rank = exchange.ranks(ids, keys, doc, at, inside=True)
    again = rank > exchange.first_seen(value, rank)
    doc, at = doc[again], at[again]
    order = np.lexsort((at, doc))
    found = exchange.span_table(exchange.span_rows(ids, keys, *exchange.runs_of(doc[order], at[order])))
    return pa.concat_tables([packed.cast(found.schema), found])


def _crowded_windows(lot: list[tuple], buckets: int) -> Iterator[pa.RecordBatch]:
    """Packed hashes of the windows of crowded anchors."""
    doc, first, number = [], [], []
    for d, (_, _, _, spans) in enumerate(lot):
        for span in spans:
            crowded = np.frombuffer(span["crowded"], bool)
            first.append(np.frombuffer(span["starts"], np.uint32)[crowded].astype(np.int64))
            number.append(np.frombuffer(span["sizes"], np.uint32)[crowded].astype(np.int64))
            doc.append(np.full(len(first[-1]), d))
    ids, keys, texts = ([row[k] for row in lot] for k in range(3))
    return _pack_windows(ids, keys, texts, *map(np.concatenate, (doc, first, number)), buckets)


def removed(
    docs: DataFrame, id: str, text: str, crowd: int = CROWD, share: float = FREQUENT
) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans and kept, the bytes left over.

    The four replace columns of their names.  Shuffles: packed segments; the texts to meet
    their candidates, and again to meet the runs found; transforms of the candidates.
    """
    buckets = exchange.bucket_count(docs, text, PACKED_SHARE)
    rows = exchange.keyed(docs, id, text)

    def settle(section: pa.Table) -> pa.Table:
        return _candidates(section, crowd)

    send = partial(_send_segments, buckets=buckets, frequent=_frequent(rows, share))
    found = cut(
        rows.select("_id", "_key", "_content")
        .mapInArrow(send, SEGMENTS)
        .groupBy("bucket")
        .applyInArrow(settle, FOUND)
    )
    settled = found.where("anchors is null").select("id", "text", "starts", "sizes")
    passed = found.where("anchors is not null")
    asked = passed.groupBy("id", "text").agg(
        F.collect_list(F.struct("starts", "sizes", "anchors", "crowded")).alias("_parts")
    )
    texts = rows.select("_id", "_key", "_content")
    met = texts.join(asked.withColumnsRenamed({"id": "_id", "text": "_key"}), ["_id", "_key"])
    # A candidate takes 4 bytes for its first window and about 140 of text.
    size = passed.agg(F.sum(F.octet_length("starts"))).first()[0] or 0
    parallel = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merges = max(parallel, int(size * 35 / MERGE_BYTES) + 1)
    merged = (
        met.mapInArrow(partial(_send_shards, buckets=merges), SHARD)
        .groupBy("bucket")
        .applyInArrow(_merge_shards, exchange.SPANS)
    )
    spans = settled.unionByName(merged)
    return _without(docs, text, rows, spans)


def _without(docs: DataFrame, text: str, rows: DataFrame, spans: DataFrame) -> DataFrame:
    added = ("n_bytes", "n_removed", "n_spans", "kept")
    plain = docs.drop(*[c for c in added if c in docs.columns])
    own = plain.columns
    zero = F.lit(0).cast("bigint")
    schema = plain.withColumns(
        {"n_bytes": zero, "n_removed": zero, "n_spans": zero, "kept": F.lit(b"")}
    ).schema

    def strike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
            sizes, gone, runs, kept = [], [], [], []
            for content, found in zip(column[text], column["_spans"]):
                raw, found = (content.as_py() or "").encode(), found.as_py()
                sizes.append(len(raw))
                if found:
                    hit = exchange.covered(found, len(raw), WIDTH)
                    runs.append(int(hit[0]) + int((hit[1:] & ~hit[:-1]).sum()))
                    raw = np.frombuffer(raw, np.uint8)[~hit].tobytes()
                else:
                    runs.append(0)
                gone.append(sizes[-1] - len(raw))
                kept.append(raw)
            yield pa.RecordBatch.from_arrays(
                [
                    *[column[c] for c in own],
                    *[pa.array(c, pa.int64()) for c in (sizes, gone, runs)],
                    pa.array(kept, pa.binary()),
                ],
                names=schema.fieldNames(),
            )

    carried = [*own, "_spans"]
    return exchange.with_spans(rows, spans).select(*carried).mapInArrow(strike, schema)
