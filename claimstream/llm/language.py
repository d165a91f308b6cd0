"""Language identification from averaged hashed subword embeddings.

The byte 3-grams and 4-grams of a text, lower-cased and with everything but letters as one
blank, are hashed to embeddings; their average goes through a linear softmax (Joulin et
al., "Bag of Tricks for Efficient Text Classification", 2017).  Average and softmax layer are
both linear, so for scoring the two are multiplied once and each n-gram adds one row of
a small table.

Training is stochastic gradient descent in numpy on the driver, on at most ``TRAIN_ROWS``
rows drawn by a hash of the id.  A part of them sets the temperature of the scores
and the score below which a prediction is marked as not trusted.

Defined results: ``und`` with score 0 where the text is null or has no letter; rows of
one id are judged each by itself; without any training row everything is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimstream.llm.sparse import letters, row_sums, training_sample

# The bound on what the driver learns from.
TRAIN_ROWS = 2000
BUCKETS = 1 << 15
DIMENSIONS = 16
EPOCHS = 6
UNKNOWN = "und"
# Bytes of text hashed at a time: bounds a worker's arrays.
PIECE = 1 << 20
_SIZES = (3, 4)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _plain() -> np.ndarray:
    """Byte to byte: letters in lower case, bytes beyond ASCII as they are, else a blank."""
    table = np.full(256, 32, np.uint8)
    table[97:123] = table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


def ngrams(text: bytes) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams, in pieces; pieces overlap so that none is missed."""
    plain = _plain()[np.frombuffer(b" " + text + b" ", np.uint8)]
    blank = plain == 32
    plain = plain[~(blank & np.concatenate([[False], blank[:-1]]))]
    for at in range(0, len(plain), PIECE):
        piece = plain[at : at + PIECE + max(_SIZES) - 1].astype(np.uint64)
        for n in _SIZES:
            count = min(len(piece) - n + 1, PIECE)
            if count > 0:
                code = np.full(count, n, np.uint64)
                for k in range(n):
                    code = (code << np.uint64(8)) | piece[k : k + count]
                code = (code * _FACTOR) >> np.uint64(64 - 15)
                yield code.astype(np.int64)


@dataclass
class Model:
    """Languages, their row in the table of each bucket, temperature and trust threshold."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    trusted: float

    def logits(self, text: bytes) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for codes in ngrams(text):
            total += self.table[codes].sum(0, dtype=np.float64)
            n += len(codes)
        return total / max(1, n) + self.bias

    def predict(self, text: bytes) -> tuple[str, float]:
        p = softmax(self.logits(text)[None] / self.temperature)[0]
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _counted(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    parts = list(ngrams(text))
    codes, counts = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int64), return_counts=True)
    return codes, (counts / max(1, counts.sum())).astype(np.float32)


def fit(texts: list[bytes], labels: list[str], seed: int = 11) -> Model | None:
    if not texts:
        return None
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels])
    rows = [_counted(t) for t in texts]
    draw = np.random.default_rng(seed)
    embed = draw.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    out = np.zeros((DIMENSIONS, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    order = draw.permutation(len(rows))
    checked = order[: len(rows) // 5] if len(rows) >= 50 else order
    learned = order[len(rows) // 5 :] if len(rows) >= 50 else order

    def forward(batch):
        codes = np.concatenate([rows[i][0] for i in batch])
        share = np.concatenate([rows[i][1] for i in batch])
        ends = np.cumsum([len(rows[i][0]) for i in batch])
        starts = np.concatenate([[0], ends[:-1]])
        hidden = row_sums(share[:, None] * embed[codes], starts, ends)
        return codes, share, ends - starts, hidden, hidden @ out + bias

    for epoch in range(EPOCHS):
        step = 8.0 * (1 - epoch / EPOCHS)
        order = draw.permutation(learned)
        for at in range(0, len(order), 16):
            batch = order[at : at + 16]
            codes, share, sizes, hidden, logits = forward(batch)
            error = softmax(logits)
            error[np.arange(len(batch)), y[batch]] -= 1
            error /= len(batch)
            back = np.repeat(error @ out.T, sizes, axis=0) * share[:, None]
            out -= step * hidden.T @ error
            bias -= 0.05 * step * error.sum(0)
            used, place = np.unique(codes, return_inverse=True)
            for d in range(DIMENSIONS):
                embed[used, d] -= 20 * step * np.bincount(place, back[:, d], len(used)).astype(np.float32)
    logits = np.concatenate([forward([i])[4] for i in checked]).astype(np.float64)
    loss = {
        t: -np.log(softmax(logits / t)[np.arange(len(checked)), y[checked]] + 1e-12).mean()
        for t in np.geomspace(0.05, 5, 41)
    }
    temperature = min(loss, key=loss.get)
    p = softmax(logits / temperature)
    right, score = p.argmax(1) == y[checked], p.max(1)
    descending = np.argsort(-score)
    accuracy = np.cumsum(right[descending]) / np.arange(1, len(score) + 1)
    enough = np.flatnonzero(accuracy >= 0.99)
    trusted = float(score[descending][enough[-1]]) if len(enough) else 1.0
    return Model(languages, embed @ out, bias.astype(np.float64), float(temperature), trusted)


def train(docs: DataFrame, id: str, text: str, lang: str) -> Model | None:
    """A model from the rows of ``docs`` that have a language; held-out rows are not among them."""
    usable = docs.where(letters(F.col(text))).select(id, F.col(text).cast("binary").alias("_text"), lang)
    drawn = training_sample(usable.select(id, "_text"), usable.select(id, lang), id, lang, TRAIN_ROWS)
    rows = (
        drawn.select("_text", "_label", F.xxhash64(id, "_text").alias("_order")).toArrow().sort_by("_order")
    )
    return fit(rows["_text"].to_pylist(), rows["_label"].to_pylist())


def predicted(docs: DataFrame, text: str, model: Model | None) -> DataFrame:
    """``docs`` with lang_pred, score and trusted; these replace columns of their names."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = ("lang_pred", "score", "trusted")
    rows = docs.drop(*[c for c in names if c in docs.columns])
    kept = rows.columns
    rows = rows.withColumn("_letters", letters(F.col(text)))
    schema = rows.drop("_letters").withColumns(
        {"lang_pred": F.lit(""), "score": F.lit(0.0), "trusted": F.lit(True)}
    ).schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            written = batch.column(batch.schema.get_field_index("_letters"))
            found = []
            for value, has_letters in zip(texts, written):
                if known is None or not has_letters.as_py():
                    found.append((UNKNOWN, 0.0))
                else:
                    content = value.as_py()
                    found.append(known.predict(content.encode() if isinstance(content, str) else content))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(batch.schema.get_field_index(c)) for c in kept],
                    pa.array([x for x, _ in found], pa.string()),
                    pa.array([s for _, s in found], pa.float64()),
                    pa.array([known is not None and s >= known.trusted for _, s in found], pa.bool_()),
                ],
                names=schema.fieldNames(),
            )

    return rows.mapInArrow(add, schema)
