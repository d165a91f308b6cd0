"""Substring dedup by recompression.

Each round renames, everywhere at once, runs of equal symbols and then pairs of a left and
a right symbol; a symbol's side depends on its name alone.  Names are hashes of what they
stand for, so all tasks agree on them without asking each other.  Where two texts have a
passage in common their interior symbols come out the same: only the symbols at the two ends
depend on what stands around, and these are left out (Jez, "Recompression", 2013).

A window of 13 words therefore has interior symbols that every other occurrence of it has
as well.  The least of those of all its levels names the bucket where all its
occurrences meet, consecutive windows mostly the same one.  There the window's own hash of 64
bits is compared, and every window that also starts in a smaller id is a repeat.

Defined results: null and empty texts have no words; fewer words than a window are
never removed; rows of one id are not repeats of each other; a null id comes after all others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimstream.llm import exchange
from claimstream.llm.exchange import mix64

WINDOW = 13
ROUNDS = 2
# Bytes of text a worker recompresses at a time.
BLOCK_BYTES = 3 << 20
# Measured: packed bytes of windows per byte of text.
PACKED_SHARE = 1.2

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BYTE = np.random.default_rng(2013).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWER = np.uint64(0xD1342543DE82EF95)
_NONE = np.uint64((1 << 64) - 1)
_RUN, _PAIR = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word, its document, and the first word of each document."""
    joined = np.frombuffer(b" ".join(texts), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    inside = ~_SPACE[joined]
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]])) if len(joined) else np.zeros(0, int)
    doc = np.searchsorted(ends, starts, side="right")
    first = np.searchsorted(doc, np.arange(len(texts)))
    if not len(starts):
        return np.zeros(0, np.uint64), doc, first
    letters = np.flatnonzero(inside)
    word = np.searchsorted(starts, letters, side="right") - 1
    place = letters - starts[word]
    power = np.cumprod(np.full(int(place.max()) + 1, _POWER, np.uint64))
    part = _BYTE[joined[letters]] * power[place]
    head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    return mix64(np.add.reduceat(part, head)), doc, first


def _least(symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least symbol of each stretch [low, high) of up to 15, none of them empty."""
    tables = [symbols]
    for k in range(3):
        tables.append(np.minimum(tables[-1][: -(1 << k)], tables[-1][1 << k :]))
    size, out = high - low, np.empty(len(low), symbols.dtype)
    for k, table in enumerate(tables):
        fit = (size >= 1 << k) & (size < 2 << k)
        out[fit] = np.minimum(table[low[fit]], table[high[fit] - (1 << k)])
    return out


def anchors(words: np.ndarray, doc: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For the windows at ``starts``, the interior symbol that all their occurrences share."""
    out = np.full(len(starts), _NONE)
    left = np.zeros(len(starts), bool)
    symbols, at_doc = words, doc
    low, high = starts.copy(), starts + window
    for level in range(ROUNDS):
        new = np.ones(len(symbols), bool)
        new[1:] = (symbols[1:] != symbols[:-1]) | (at_doc[1:] != at_doc[:-1])
        heads = np.flatnonzero(new)
        length = np.diff(np.append(heads, len(symbols))).astype(np.uint64)
        run = np.cumsum(new) - 1
        # The outer runs may go on beyond the window, so they are no interior symbols.
        low, high = run[low] + 1, run[np.maximum(high - 1, low)]
        symbols, at_doc = symbols[heads], at_doc[heads]
        symbols = np.where(length > 1, mix64(symbols * _RUN + length), symbols)
        is_left = (mix64(symbols + np.uint64(level)) & np.uint64(1)).astype(bool)
        opens = np.zeros(len(symbols), bool)
        opens[:-1] = is_left[:-1] & ~is_left[1:] & (at_doc[1:] == at_doc[:-1])
        # A right symbol in front may pair with one outside, so may a left symbol at the end.
        last = len(symbols) - 1
        low = low + ~is_left[np.minimum(low, last)]
        high = high - is_left[np.maximum(high - 1, 0)]
        some = high > low
        keep = np.ones(len(symbols), bool)
        keep[1:] = ~opens[:-1]
        named = symbols.copy()
        pair = np.flatnonzero(opens)
        named[pair] = mix64(symbols[pair] * _PAIR + symbols[pair + 1])
        place = np.cumsum(keep) - 1
        symbols, at_doc = named[keep], at_doc[keep]
        low = np.where(some, place[np.minimum(low, last)], 0)
        high = np.where(some, place[np.maximum(high - 1, 0)] + 1, 0)
        # A window without interior symbols at this level has those of the levels below.
        some &= ~left
        out[some] = np.minimum(out[some], _least(symbols, low[some], high[some]))
        left |= high <= low
        low, high = np.where(left, 0, low), np.where(left, 1, high)
    none = out == _NONE
    if none.any():
        out[none] = window_hashes(words, starts[none], window)
    return mix64(out)


def window_hashes(words: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    total = np.zeros(len(starts), np.uint64)
    factor = int(_PAIR)
    for k in range(window):
        total += words[starts + k] * np.uint64(factor)
        total ^= total >> np.uint64(29)
        factor = factor * int(_POWER) % (1 << 64)
    return mix64(total)


def removed(docs: DataFrame, id: str, text: str, window: int = WINDOW) -> DataFrame:
    """``docs`` with n_words, n_removed and kept, the words left over joined by blanks.

    The three replace columns of their names.  Shuffles: packed window hashes, window runs
    found, and the texts once, to meet their runs.
    """
    buckets = exchange.bucket_count(docs, text, PACKED_SHARE)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys, texts in exchange.blocks(batches, BLOCK_BYTES):
            words, doc, first = word_hashes(texts)
            last = max(0, len(doc) - window + 1)
            starts = np.flatnonzero(doc[:last] == doc[window - 1 :][:last])
            if len(starts):
                meet = (anchors(words, doc, starts, window) % np.uint64(buckets)).astype(np.int64)
                value = window_hashes(words, starts, window)
                yield from exchange.pack(ids, keys, doc[starts], starts - first[doc[starts]], value, meet, buckets)

    def compare(section: pa.Table) -> pa.Table:
        return exchange.repeated(section)

    rows = exchange.keyed(docs, id, text)
    spans = (
        rows.select("_id", "_key", "_content")
        .mapInArrow(send, exchange.PACKED)
        .groupBy("bucket")
        .applyInArrow(compare, exchange.SPANS)
    )
    added = ("n_words", "n_removed", "kept")
    plain = docs.drop(*[c for c in added if c in docs.columns])
    schema = plain.withColumns(
        {"n_words": F.lit(0).cast("bigint"), "n_removed": F.lit(0).cast("bigint"), "kept": F.lit("")}
    ).schema

    own = plain.columns

    def strike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
            counts, gone, kept = [], [], []
            for content, spans in zip(column[text], column["_spans"]):
                words, spans = _WORD.findall((content.as_py() or "").encode()), spans.as_py()
                counts.append(len(words))
                if spans:
                    hit = exchange.covered(spans, len(words), window)
                    words = [w for w, h in zip(words, hit.tolist()) if not h]
                gone.append(counts[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    *[column[c] for c in own],
                    pa.array(counts, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                names=schema.fieldNames(),
            )

    carried = [*own, "_spans"]
    joined = exchange.with_spans(rows, spans).select(*carried)
    return joined.mapInArrow(strike, schema)
