"""Quality classifier: a factorisation machine over words and the form of a text.

Features are the hashed words of the whole text, statistics of its structure and its size.
All pairs of features interact through low-rank factors, and the sum over pairs comes from
the identity  sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2),
so a text is scored in time linear in its features (Rendle, "Factorization Machines", 2010).

It is trained in numpy on the driver, on at most ``TRAIN_ROWS`` labelled rows drawn by a
hash of the id; scoring reads every whole text.  Words too rare for the sample to say anything
about share the hashed buckets with frequent ones, hence the small factors they start from.

Defined results: null and empty texts get the score of a text without words; rows of one id
are scored each by itself; without any training row every score is 0.5.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimstream.llm.sparse import row_sums, training_sample

# The bound on what the driver learns from.
TRAIN_ROWS = 4000
BUCKETS = 1 << 14
FACTORS = 8
EPOCHS = 8
ACCEPT = 0.3

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123)) + bytes(range(128, 256))
_DIGIT = bytes(range(48, 58))
_STOPS = b".,;:?'\"-()"
_MARKS = bytes(c for c in range(33, 127) if c not in _UPPER + _LOWER + _DIGIT + _STOPS)
_SPACE = b" \t\n\x0b\x0c\r"


def _share(text: bytes, characters: bytes) -> float:
    return (len(text) - len(text.translate(None, characters))) / max(1, len(text))


def structure(text: bytes, counts: Counter, n: int) -> list[float]:
    """Statistics of form, each between 0 and about 1."""
    lines = [x for x in text.split(b"\n") if x]
    repeated = 1 - len(set(lines)) / len(lines) if lines else 0.0
    marked = sum(k for w, k in counts.items() if w[-1] in _MARKS)
    ended = sum(k for w, k in counts.items() if w[-1] in b".?!")
    return [
        1.0,
        min(1.0, np.log1p(n) / 12),
        min(1.0, len(text) / max(1, n) / 20),
        _share(text, _UPPER),
        _share(text, _LOWER),
        _share(text, _DIGIT),
        _share(text, _MARKS),
        _share(text, _SPACE),
        len(counts) / max(1, n),
        marked / max(1, n),
        ended / max(1, n),
        min(1.0, np.log1p(n / max(1, len(lines))) / 8),
        repeated,
        max(counts.values(), default=0) / max(1, n),
        float(n == 0),
    ]


STATISTICS = len(structure(b"", Counter(), 0))


def features(text: bytes | None) -> tuple[list[int], list[float]]:
    """Feature numbers and values: the statistics, then the words of the text."""
    text = text or b""
    found = _WORD.findall(text)
    counts = Counter(found)
    index = list(range(STATISTICS))
    values = structure(text, counts, len(found))
    scale = 1 / max(1.0, len(counts)) ** 0.5
    index += [STATISTICS + zlib.crc32(w.lower()) % BUCKETS for w in counts]
    values += [scale] * len(counts)
    return index, values


@dataclass
class Machine:
    """The trained machine: bias, weights and factors."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, index: np.ndarray, values: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        x = values[:, None] * self.factors[index]
        total = row_sums(x, starts, ends)
        squares = row_sums((x * x).sum(1), starts, ends)
        linear = row_sums(values * self.weights[index], starts, ends)
        return self.bias + linear + 0.5 * ((total * total).sum(1) - squares), total

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        index, values, starts, ends = ragged(map(features, texts))
        return 1 / (1 + np.exp(-np.clip(self.raw(index, values, starts, ends)[0], -30, 30)))


def ragged(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    index, values, sizes = [], [], []
    for i, v in rows:
        index += i
        values += v
        sizes.append(len(i))
    ends = np.cumsum(np.array(sizes, dtype=np.int64))
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    return np.array(index, dtype=np.int64), np.array(values, dtype=np.float32), starts, ends


def fit(rows: list[tuple[list[int], list[float]]], labels: list[int], seed: int = 7) -> Machine:
    """Logistic loss, one pass per epoch over mini-batches, step sizes by AdaGrad."""
    draw = np.random.default_rng(seed)
    size = STATISTICS + BUCKETS
    factors = draw.normal(0, 0.02, (size, FACTORS)).astype(np.float32)
    machine = Machine(0.0, np.zeros(size, np.float32), factors)
    if not rows:
        machine.factors[:] = 0
        return machine
    y = np.array(labels, dtype=np.float32)
    seen_w = np.full(size, 1e-6, np.float32)
    seen_v = np.full((size, FACTORS), 1e-6, np.float32)
    seen_b, step, decay = 1e-6, 0.1, 1e-5
    for _ in range(EPOCHS):
        order = draw.permutation(len(rows))
        for at in range(0, len(rows), 64):
            batch = order[at : at + 64]
            index, values, starts, ends = ragged(rows[i] for i in batch)
            raw, total = machine.raw(index, values, starts, ends)
            error = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[batch]
            each = np.repeat(error / len(batch), ends - starts).astype(np.float32)
            sums = np.repeat(total, ends - starts, axis=0)
            held = machine.factors[index]
            grad_w = each * values
            grad_v = each[:, None] * (values[:, None] * sums - held * (values**2)[:, None])
            used, place = np.unique(index, return_inverse=True)
            gw = np.bincount(place, grad_w, len(used)) + decay * machine.weights[used]
            gv = np.stack(
                [np.bincount(place, grad_v[:, f], len(used)) for f in range(FACTORS)], axis=1
            ) + decay * machine.factors[used]
            seen_w[used] += gw**2
            seen_v[used] += gv**2
            machine.weights[used] -= step * gw / np.sqrt(seen_w[used])
            machine.factors[used] -= 0.2 * step * gv / np.sqrt(seen_v[used])
            gb = float(error.mean())
            seen_b += gb * gb
            machine.bias -= step * gb / seen_b**0.5
    return machine


def train(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str) -> Machine:
    """A machine from the labelled rows of ``docs``; the caller has left out what is held out."""
    sample = training_sample(
        docs.select(id, F.col(text).cast("binary").alias("_text")), labels, id, label, TRAIN_ROWS
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _ in found], pa.list_(pa.int32())),
                    pa.array([v for _, v in found], pa.list_(pa.float32())),
                    batch.column(1),
                    batch.column(2),
                ],
                names=["index", "value", "label", "order"],
            )

    rows = (
        sample.select("_text", F.col("_label").cast("int").alias("label"), F.xxhash64(id, "_text").alias("order"))
        .mapInArrow(extract, "index array<int>, value array<float>, label int, order bigint")
        .toArrow()
        .sort_by("order")
    )
    pairs = list(zip(rows["index"].to_pylist(), rows["value"].to_pylist()))
    return fit(pairs, rows["label"].to_pylist())


def scored(docs: DataFrame, text: str, machine: Machine, out: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text; ``out`` replaces a column of that name."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    rows = docs.drop(out) if out in docs.columns else docs
    schema = rows.withColumn(out, F.lit(0.0)).schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            scores = []
            for value in texts:
                content = value.as_py()
                if isinstance(content, str):
                    content = content.encode()
                scores.append(float(sent.value.score([content])[0]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=schema.fieldNames()
            )

    return rows.mapInArrow(add, schema)
