"""Words of many texts at once, as places in one buffer and as 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from claimstream.llm.exchange import mix64

LAST = np.uint64((1 << 64) - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def gaps(between: bytes) -> np.ndarray:
    """Which bytes stand between words."""
    out = np.zeros(256, bool)
    out[list(between)] = True
    return out


# The white space of the contracts, and A-Z in lower case.
WHITE = gaps(b" \t\n\x0b\x0c\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


class Words:
    """The words of some texts: ``starts`` and ``ends`` in ``buffer``, ``counts`` per text."""

    def __init__(self, texts: list[bytes | None], gap: np.ndarray = WHITE, lower: bool = False):
        joined = b"\n".join([t or b"" for t in texts]) + b"\n" if texts else b""
        raw = np.frombuffer(joined, np.uint8)
        self.buffer = LOWER[raw] if lower else raw
        apart = gap[raw]
        before = np.ones(len(raw), bool)
        before[1:] = apart[:-1]
        self.starts = np.flatnonzero(before & ~apart)
        self.ends = np.flatnonzero(~before & apart)
        sizes = np.array([len(t or b"") + 1 for t in texts], np.int64)
        self.counts = np.diff(np.searchsorted(self.starts, np.concatenate([[0], np.cumsum(sizes)])))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word's bytes."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        power, inverse = _power_tables(len(self.buffer) + 1)
        sums = np.zeros(len(self.buffer) + 1, np.uint64)
        np.cumsum((self.buffer.astype(np.uint64) + np.uint64(1)) * power[: len(self.buffer)], out=sums[1:])
        h = (sums[self.ends] - sums[self.starts]) * inverse[self.starts]
        return mix64(h + (self.ends - self.starts).astype(np.uint64))

    def spelled(self, at: np.ndarray) -> list[bytes]:
        data = self.buffer.tobytes()
        return [data[a:b] for a, b in zip(self.starts[at].tolist(), self.ends[at].tolist())]


def feeds(batches: Iterator[pa.RecordBatch], text: int, most: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """(rows, texts) of about ``most`` bytes of text each, at least one row."""
    for batch in batches:
        texts = batch.column(text).to_pylist()
        start, held = 0, 0
        for i, t in enumerate(texts):
            held += len(t or b"")
            if held >= most:
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, held = i + 1, 0
        if start < len(texts):
            yield batch.slice(start), texts[start:]
