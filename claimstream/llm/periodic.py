"""Periodic runs of words, by catchers over completed power-of-two blocks.

A run is a stretch of words with smallest period q (words q apart are identical), of at least
``SHORTEST`` words and ``EXPONENT`` periods, that no neighbouring word extends.

A catcher of size 2^k waits at a completed block of 2^k words.  It holds the block's name and
compares it with the 2^k suffixes that begin in the next block, which is every square that
starts at the block and has a period of 2^k to 2^(k+1) - 1.  A run of four periods has
two neighbouring blocks that catch the same period, so a square of one block alone is not
followed up.  The catchers of one size are advanced together, the smallest first: a caught
square is widened word by word to both sides and merges with all squares of its stretch;
squares inside a run already known are multiples of its period.  Names are hashes of
hashes of half the size; widening compares the words' own hashes, and words of a run are at
last compared themselves.

Texts are worked on about ``FEED_BYTES`` at a time, a longer text by itself, in memory
proportional to its words and time proportional to words times the logarithm of the longest period.

Defined results: null and empty texts have no words and no runs; rows of one id are worked on each
for itself; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimstream.llm.exchange import mix64
from claimstream.llm.wordhash import Words, feeds

SHORTEST, EXPONENT = 6, 4
FEED_BYTES = 1 << 20
_C = np.uint64(0x9E3779B97F4A7C15)
RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])


def _same_for(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading entries of both are the same; looks at twice as many each time."""
    done, step, n = 0, 64, min(len(a), len(b))
    while done < n:
        apart = np.flatnonzero(a[done : done + step][: n - done] != b[done : done + step][: n - done])
        if len(apart):
            return done + int(apart[0])
        done, step = done + step, 2 * step
    return n


def runs(words: np.ndarray, longest: int) -> np.ndarray:
    """(start, end, period) of all runs with a period of up to ``longest``, in no order."""
    n, found = len(words), []
    reach = np.zeros(n, np.int64)  # for every word, the furthest end of a known run over it
    names, size = mix64(words.astype(np.uint64) + _C), 1
    while size <= longest and n >= 3 * size:
        # The suffix names, block by block; places past the end have a name no block has.
        blocks = -(-n // size)
        padded = np.zeros((blocks + 2) * size, np.uint64)
        padded[: len(names)] = np.where(names == 0, np.uint64(1), names)
        rows = padded.reshape(-1, size)
        caught = (rows[1:] == rows[:-1, :1]) & (rows[:-1, :1] != 0)
        block, off = np.nonzero(caught[:-1] & caught[1:])
        at, period = block * size, size + off
        ahead = reach[at] < at + period + 2 * size
        looked: dict[int, int] = {}  # per period, how far its last stretch of squares begins
        for s, q in zip(at[ahead].tolist(), period[ahead].tolist()):
            if s < looked.get(q, 0) or reach[s] >= s + q + 2 * size:
                continue
            right = s + _same_for(words[s:], words[s + q :])
            left = s - _same_for(words[:s][::-1], words[q : s + q][::-1])
            looked[q] = right
            if right + q - left >= max(SHORTEST, EXPONENT * q) and q <= longest:
                found.append((left, right + q, q))
                np.maximum(reach[left : right + q], right + q, out=reach[left : right + q])
        names = mix64(names[: max(0, n - 2 * size + 1)] * _C + mix64(names[size : size + max(0, n - 2 * size + 1)]))
        size *= 2
    return np.array(found, np.int64).reshape(-1, 3)


def _spelled_alike(words: list[bytes], start: int, end: int, period: int) -> bool:
    return words[start : end - period] == words[start + period : end]


def _worked(
    batches: Iterator[pa.RecordBatch], altered: Callable[[object, list[bytes]], list[bytes]] | None
) -> Iterator[pa.RecordBatch]:
    run = pa.struct([pa.field(c, pa.int64(), False) for c in ("start", "length", "period")])
    for rows, texts in feeds(batches, 1, FEED_BYTES):
        split = [(t or b"").split() for t in texts]
        if altered is not None:
            for i, id in enumerate(rows.column(0).to_pylist()):
                split[i] = altered(id, split[i])
        counts = np.array([len(w) for w in split], np.int64)
        # Between two texts stands a number no word has, another one each time.
        begin = np.cumsum(counts + 1) - counts - 1
        numbers = Words([b" ".join(w) for w in split]).hashes()
        sequence = np.arange(1, len(numbers) + len(counts) + 1).astype(np.uint64)
        inside = np.ones(len(sequence), bool)
        inside[begin + counts] = False
        sequence[inside] = numbers
        found = runs(sequence, int(counts.max(initial=0)) // EXPONENT)
        of = np.searchsorted(begin, found[:, 0], side="right") - 1
        listed: list[list] = [[] for _ in split]
        kept = split
        for i in np.unique(of).tolist():
            own = found[of == i] - np.array([begin[i], begin[i], 0])
            words = split[i]
            if not all(_spelled_alike(words, *r) for r in own.tolist()):
                number: dict[bytes, int] = {}
                exact = np.array([number.setdefault(w, len(number)) for w in words], np.uint64)
                own = runs(exact, len(words) // EXPONENT)
            own = own[np.lexsort((own[:, 2], own[:, 0]))].tolist()
            listed[i] = [{"start": a, "length": b - a, "period": q} for a, b, q in own]
            again = np.zeros(len(words), bool)
            for a, b, q in own:
                again[a + q : b] = True
            kept[i] = [w for w, drop in zip(words, again.tolist()) if not drop]
        yield pa.RecordBatch.from_arrays(
            [
                rows.column(0),
                pa.array(counts),
                pa.array(listed, pa.list_(run)),
                pa.array([b" ".join(w) for w in kept], pa.binary()),
            ],
            names=[rows.schema.names[0], "n_words", "runs", "collapsed"],
        )


def collapsed(
    docs: DataFrame,
    id: str,
    text: str,
    altered: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """(id, n_words, runs, collapsed) of every row.

    ``runs`` has every run as (start, length, period) in words, by start and period; ``collapsed`` is
    the text with each run cut to its first period, as UTF-8 words joined by one space.
    ``altered`` may rewrite a text's words, given its id, before they are looked at.
    """
    given = docs.select(F.col(id), F.col(text).cast("binary").alias("_text"))
    schema = T.StructType(
        [
            given.schema[0],
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(RUN, False)),
            T.StructField("collapsed", T.BinaryType()),
        ]
    )
    return given.mapInArrow(lambda batches: _worked(batches, altered), schema)


def strongest(runs: str):
    """The run of greatest length / period, then smallest start, then smallest period; null without runs."""

    def better(a, b):
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        earlier = (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] <= b["period"]))
        return F.when((left > right) | ((left == right) & earlier), a).otherwise(b)

    return F.aggregate(runs, F.get(runs, F.lit(0)), better)
