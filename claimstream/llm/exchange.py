"""Packed exchange of window hashes between blocks of documents and buckets of hashes.

A task packs the windows of a block of documents into one row per bucket, so the shuffle
moves a few binary rows in place of a row per window.  Of equal windows in a block only those
of its first document are sent, and the others are known to repeat at once: a window
that stands in a third of all documents reaches its bucket once per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# About the size of a bucket's packed windows, and the least number of buckets.
BUCKET_BYTES = 24 << 20
FEWEST_BUCKETS = 64
# Windows of one packed run; longer ones are cut.
LONGEST_RUN = (1 << 16) - 1
LAST = (1 << 63) - 1

#: A block's part of a bucket, or (id and text set) spans of one document, found already.
PACKED = (
    "bucket int, id bigint, text bigint, ids binary, texts binary, runs binary,"
    " starts binary, sizes binary, hashes binary"
)
#: Window runs of one document: first window and number of windows, as packed integers.
SPANS = "id bigint, text bigint, starts binary, sizes binary"


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """The documents with what orders them and tells them apart.

    A null id comes last.  Rows of one id and one text are alike and share their spans.
    """
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.withColumns(
        {
            "_id": F.coalesce(F.col(id).cast("bigint"), F.lit(LAST)),
            "_key": F.xxhash64(content),
            "_content": content,
        }
    )


def bucket_count(docs: DataFrame, text: str, bytes_per_byte: float) -> int:
    """Buckets for the windows of all texts, given packed bytes per byte of text."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(FEWEST_BUCKETS, int(total * bytes_per_byte / BUCKET_BYTES) + 1)


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list, list]]:
    """(ids, keys, contents) of documents, about ``size`` bytes of text at a time."""
    ids, keys, texts, held = [], [], [], 0
    for batch in batches:
        for i, k, t in zip(*(batch.column(c).to_pylist() for c in range(3))):
            ids.append(i)
            keys.append(k)
            texts.append(t)
            held += len(t)
            if held >= size:
                yield ids, keys, texts
                ids, keys, texts, held = [], [], [], 0
    if ids:
        yield ids, keys, texts


def _ends(change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(change)
    return starts, np.append(starts[1:], len(change))


def runs_of(doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first, number) of runs of consecutive places; both arrays are in order."""
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none
    new = np.ones(len(at), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1)
    starts, ends = _ends(new)
    return doc[starts], at[starts], ends - starts


def cut_runs(doc: np.ndarray, first: np.ndarray, number: np.ndarray, most: int = LONGEST_RUN):
    """The same runs, none of them longer than ``most``."""
    parts = -(-number // most)
    which = np.repeat(np.arange(len(number)), parts)
    before = (np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)) * most
    return doc[which], first[which] + before, np.minimum(most, number[which] - before)


def first_seen(value: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For every entry, the lowest rank among the entries of its value."""
    order = np.argsort(value, kind="stable")
    ordered = value[order]
    new = np.ones(len(value), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(new)
    lowest = np.minimum.reduceat(rank[order], starts) if len(starts) else rank[:0]
    out = np.empty(len(value), rank.dtype)
    out[order] = lowest[np.cumsum(new) - 1] if len(starts) else lowest
    return out


def span_rows(ids, keys, doc, first, number) -> list[tuple]:
    """One (id, text, starts, sizes) row per document of the runs, which are in document order."""
    out = []
    if len(doc):
        new = np.ones(len(doc), bool)
        new[1:] = doc[1:] != doc[:-1]
        for a, b in zip(*_ends(new)):
            d = doc[a]
            out.append(
                (
                    int(ids[d]),
                    int(keys[d]),
                    first[a:b].astype(np.uint32).tobytes(),
                    number[a:b].astype(np.uint32).tobytes(),
                )
            )
    return out


def ranks(ids: np.ndarray, keys: np.ndarray, doc: np.ndarray, at: np.ndarray, inside: bool) -> np.ndarray:
    """What must be smaller for a window to come earlier: the id or, ``inside``, also the place."""
    if not inside:
        return ids[doc]
    order = np.lexsort((keys, ids))
    change = np.ones(len(order), bool)
    change[1:] = (ids[order][1:] != ids[order][:-1]) | (keys[order][1:] != keys[order][:-1])
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(change) - 1
    return (place[doc] << 32) + at


def pack(ids, keys, doc, at, value, bucket, buckets: int, inside: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows of ``PACKED`` for the windows (document, place, hash) of one block."""
    ids, keys = np.array(ids, np.int64), np.array(keys, np.int64)
    schema = pa.schema(
        [("bucket", pa.int32()), ("id", pa.int64()), ("text", pa.int64())]
        + [(c, pa.binary()) for c in ("ids", "texts", "runs", "starts", "sizes", "hashes")]
    )
    rank = ranks(ids, keys, doc, at, inside)
    again = rank > first_seen(value, rank)
    rows = [
        (hash((i, k)) % buckets, i, k, None, None, None, s, n, None)
        for i, k, s, n in span_rows(ids, keys, *runs_of(doc[again], at[again]))
    ]
    sent = ~again
    doc, at, value, bucket = doc[sent], at[sent], value[sent], bucket[sent]
    order = np.argsort(bucket, kind="stable")
    doc, at, value, bucket = doc[order], at[order], value[order], bucket[order]
    new = np.ones(len(bucket), bool)
    new[1:] = bucket[1:] != bucket[:-1]
    for a, b in zip(*_ends(new)):
        run_doc, first, number = cut_runs(*runs_of(doc[a:b], at[a:b]))
        used, runs = np.unique(run_doc, return_counts=True)
        rows.append(
            (
                int(bucket[a]),
                None,
                None,
                ids[used].tobytes(),
                keys[used].tobytes(),
                runs.astype(np.uint32).tobytes(),
                first.astype(np.uint32).tobytes(),
                number.astype(np.uint16).tobytes(),
                value[a:b].tobytes(),
            )
        )
    for a in range(0, len(rows), 256):
        columns = list(zip(*rows[a : a + 256]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
        )


def _numbers(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def span_table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [[], [], [], []]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.table(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["id", "text", "starts", "sizes"]
    )


def repeated(section: pa.Table, inside: bool = False) -> pa.Table:
    """Of the windows in a bucket, the runs whose hash also comes earlier."""
    known = section.filter(section["id"].is_valid()).select(["id", "text", "starts", "sizes"])
    packed = section.filter(section["id"].is_null())
    ids, keys = _numbers(packed["ids"], np.int64), _numbers(packed["texts"], np.int64)
    runs = _numbers(packed["runs"], np.uint32).astype(np.int64)
    first = _numbers(packed["starts"], np.uint32).astype(np.int64)
    number = _numbers(packed["sizes"], np.uint16).astype(np.int64)
    value = _numbers(packed["hashes"], np.uint64)
    doc = np.repeat(np.repeat(np.arange(len(ids)), runs), number)
    begin = np.cumsum(number) - number
    at = np.arange(len(value)) + np.repeat(first - begin, number)
    if not len(value):
        return known
    rank = ranks(ids, keys, doc, at, inside)
    again = rank > first_seen(value, rank)
    found = span_table(span_rows(ids, keys, *runs_of(doc[again], at[again])))
    return pa.concat_tables([known.cast(found.schema), found])


def gathered(spans: DataFrame) -> DataFrame:
    """All window runs of each document in one row."""
    return spans.groupBy("id", "text").agg(
        F.collect_list(F.struct("starts", "sizes")).alias("_spans")
    )


def with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``rows`` (see ``keyed``) with their window runs; null where there are none.

    Of the texts only the documents' own column goes along.
    """
    rows = rows.drop("_content")
    found = gathered(spans).withColumnsRenamed({"id": "_id", "text": "_key"})
    return rows.join(found, ["_id", "_key"], "left")


def covered(spans: list | None, places: int, width: int) -> np.ndarray:
    """Which of ``places`` places lie in a window of the runs."""
    change = np.zeros(places + 1, np.int32)
    for span in spans or ():
        first = np.frombuffer(span["starts"], np.uint32).astype(np.int64)
        number = np.frombuffer(span["sizes"], np.uint32).astype(np.int64)
        np.add.at(change, first, 1)
        np.add.at(change, first + number + width - 1, -1)
    return np.cumsum(change[:-1]) > 0
