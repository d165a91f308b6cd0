"""Benchmark decontamination with a generalised suffix automaton.

The automaton of all benchmark items, over words, tells at each word of a document how long
a run of words ending there also stands in some item.  A run of 13 words or more marks its
last 13 as hit; an item of fewer words marks the place where it stands whole.  One pass over
the words of a text finds all of it, whatever the number of items.

The items travel to the tasks in blocks of a bounded number of words, one pass
over the documents per block, and each pass adds to the hits of the passes before it.

Defined results: null and empty texts have no words and no hits; items without words match
nothing; repeated rows and ids each get their own result; an empty benchmark hits nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from claimstream.llm.common import cut

WINDOW = 13
# Words of benchmark text per pass: about 100 MB of automaton in a worker.
BLOCK_WORDS = 200_000
# Lower-case letters, digits and everything beyond ASCII, in lower-cased UTF-8.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


class Automaton:
    """Suffix automaton of several word sequences (Blumer et al.; one state chain per item)."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names: list[str] = []
        sequences = []
        for name, tokens in items:
            if tokens:
                ids = [self.vocabulary.setdefault(t, len(self.vocabulary)) for t in tokens]
                sequences.append(ids)
                self.names.append(name)
                last = 0
                for c in ids:
                    last = self._extend(last, c)
        self._mark(sequences)

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        return len(self.link) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        """A copy of q for the shorter strings that reach it through p."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, c)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c)
        return new

    def _mark(self, sequences: list[list[int]]) -> None:
        """Which items a window state stands for, and which short items end in a state."""
        within: list[set[int]] = [set() for _ in self.link]
        whole: list[list[tuple[int, int]]] = [[] for _ in self.link]
        for i, ids in enumerate(sequences):
            state = 0
            for c in ids:
                state = self.next[state][c]
                if len(ids) >= self.window:
                    within[state].add(i)
            if len(ids) < self.window:
                whole[state].append((len(ids), i))
        self.items_at: list[frozenset[int]] = [frozenset()] * len(self.link)
        self.short_at: list[list[tuple[int, int]]] = whole
        by_length = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        for s in reversed(by_length):
            if self.length[self.link[s]] >= self.window:
                within[self.link[s]] |= within[s]
        for s in by_length:
            up = self.link[s]
            if self.length[s] >= self.window:
                # The window's own state is the highest one that is still long enough.
                self.items_at[s] = (
                    self.items_at[up] if self.length[up] >= self.window else frozenset(within[s])
                )
            self.short_at[s] = whole[s] + self.short_at[up]

    def match(self, tokens: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit spans of word positions and the items that stand in the text."""
        following, link, length, window = self.next, self.link, self.length, self.window
        items_at, short_at = self.items_at, self.short_at
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        state = run = 0
        for at, c in enumerate(map(self.vocabulary.get, tokens)):
            if c is None:
                state = run = 0
                continue
            while state and c not in following[state]:
                state = link[state]
                run = length[state]
            state = following[state].get(c, 0)
            if not state:
                run = 0
                continue
            run += 1
            if run >= window:
                items = items_at[state]
                if items:
                    spans.append((at + 1 - window, at + 1))
                    found |= items
            for size, item in short_at[state]:
                if size <= run:
                    spans.append((at + 1 - size, at + 1))
                    found.add(item)
        return spans, found


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(items: DataFrame, id: str, text: str, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items block by block; only one block is on the driver at a time."""
    block, size = [], 0
    rows = items.select(F.col(id).cast("string").alias("id"), F.col(text).cast("binary").alias("text"))
    for row in rows.orderBy("id", "text").toLocalIterator():
        tokens = words(row["text"])
        block.append((row["id"], tokens))
        size += len(tokens)
        if size >= block_words:
            yield block
            block, size = [], 0
    yield block


def hits(
    docs: DataFrame,
    text: str,
    items: DataFrame,
    item_id: str,
    item_text: str,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with n_words, hit_spans (starts and ends of word runs, in turn), hit_items.

    The result columns replace columns of ``docs`` that have their names.
    """
    context = docs.sparkSession.sparkContext
    none = F.array().cast("array<int>"), F.array().cast("array<string>")
    rows = docs.withColumns(
        {"n_words": F.lit(0).cast("bigint"), "hit_spans": none[0], "hit_items": none[1]}
    )
    schema = StructType(
        [f for f in rows.schema.fields if f.name not in ("n_words", "hit_spans", "hit_items")]
    )
    kept = schema.fieldNames()
    schema = (
        schema.add("n_words", LongType())
        .add("hit_spans", ArrayType(IntegerType()))
        .add("hit_items", ArrayType(StringType()))
    )
    first = True
    for block in _blocks(items, item_id, item_text, block_words):
        if not first:
            rows = cut(rows)
        first = False
        sent = context.broadcast(block)

        def add(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            machine = Automaton(sent.value, window)
            for batch in batches:
                counts, all_spans, all_items = [], [], []
                column = batch.column(batch.schema.get_field_index(text))
                before = batch.column(batch.schema.get_field_index("hit_spans"))
                named = batch.column(batch.schema.get_field_index("hit_items"))
                for i, value in enumerate(column):
                    content = value.as_py()
                    tokens = words(content.encode() if content else None)
                    spans, found = machine.match(tokens)
                    old = before[i].as_py()
                    spans = merged([*spans, *zip(old[::2], old[1::2])])
                    counts.append(len(tokens))
                    all_spans.append([x for span in spans for x in span])
                    all_items.append(sorted({*named[i].as_py(), *[machine.names[j] or "" for j in found]}))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(batch.schema.get_field_index(c)) for c in kept],
                        pa.array(counts, pa.int64()),
                        pa.array(all_spans, pa.list_(pa.int32())),
                        pa.array(all_items, pa.list_(pa.string())),
                    ],
                    names=schema.fieldNames(),
                )

        rows = rows.mapInArrow(add, schema)
    return rows


def judged(marked: DataFrame) -> DataFrame:
    """Adds n_hit, n_items and contaminated: a twentieth of the words or more is hit."""
    zero = F.lit(0).cast("bigint")
    n_hit = F.aggregate(
        F.transform("hit_spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
        zero,
        lambda n, x: n + x,
    )
    return marked.withColumns(
        {"n_hit": n_hit, "n_items": F.size("hit_items").cast("bigint")}
    ).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def without_spans(marked: DataFrame, text: str) -> DataFrame:
    """The text with its hit spans cut out, for a caller that keeps the rest of a document."""

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            spans = batch.column(batch.schema.get_field_index("hit_spans")).to_pylist()
            out = []
            for value, hit in zip(batch.column(at).to_pylist(), spans):
                if value and hit:
                    raw = value.encode()
                    places = [m.span() for m in WORD.finditer(raw.lower())]
                    for a, b in reversed(list(zip(hit[::2], hit[1::2]))):
                        raw = raw[: places[a][0]] + raw[places[b - 1][1] :]
                    value = raw.decode()
                out.append(value)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, pa.string()))

    return marked.mapInArrow(cut_out, marked.schema)
