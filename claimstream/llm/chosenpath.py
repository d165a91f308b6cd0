"""Near copies by a chosen-path set similarity join over word shingles.

Christiani, Pagh: "Set Similarity Search Beyond MinHash", 2017, and the join built on it.  Every
text has ``TOKENS`` minwise tokens.  A tree starts with all texts in its root; a node chooses
one token position, or with a quarter's chance two (1 / 0.8 in the mean), by a hash of
its path, and each text moves on to the children its own tokens there name.  Nodes
of up to ``NODE`` texts are compared exhaustively; larger ones branch again, ``DEPTH`` times at
most, and what is still together then is taken as one cluster.  ``TREES`` independent trees
start with ten branches, so two texts at a similarity of exactly 0.8 meet in a node of the first
level with a probability of 1 - 0.2^10, and after four levels with 1 - 0.42^8, 99.9%.

In the nodes texts are compared by their tokens: pairs that agree in fewer than ``AGREE`` of
64 are told apart (a pair at 0.8 does so once in 30,000).  A node reports a spanning forest of
its alike texts, not their pairs.  The forests of all nodes join into clusters, and a
cluster is settled on the full sets: up to two blocks of ``BLOCK`` texts by one task, all against
all.  A larger cluster is dealt into blocks, each of which is compared in itself and with a few
texts all blocks share; then, only where a cluster is still in parts, block against
block, leaving out two blocks of one part.  So links are exact, no row stands for a pair, and
every task holds two blocks at most.

Texts with the same set are one class throughout, however many documents have it.

Defined results: texts are lower-cased in A-Z; fewer words than a shingle are one shingle; a
text without words, or null, has an empty set and is linked with nothing; rows of one id
keep their own sets; a component is named by its smallest id, null only if all its ids are null.
An empty table gives no rows; other columns are not read.  Shingles are 64-bit hashes, sets are
told apart by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimstream.llm.common import attach, cut
from claimstream.llm.exchange import mix64
from claimstream.llm.graph import components
from claimstream.llm.wordhash import Words, feeds

SHINGLE = 4
# Two sets are alike from this percentage of their union on.
PERCENT = 80
TOKENS, AGREE = 64, 38
TREES, DEPTH = 8, 4
NODE, BLOCK, PIVOTS = 2048, 1536, 4
BLOCK_ELEMENTS = 2_000_000
FEED_BYTES = 1 << 20
# 2^24 bits, two megabytes, whatever the input; more sets than that only make it less selective.
ASKED_BITS = 1 << 24
_C1, _C2, _C3 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_DRAW = np.random.default_rng(11).integers(1, 1 << 63, (TOKENS, 2), dtype=np.uint64) | np.uint64(1)
# The branches of the roots: every fourth tree chooses two positions.
ROOTS = TREES + TREES // 4

DESCRIBED = "high bigint, low bigint, n_shingles bigint, tokens binary, nodes array<bigint>"
ELEMENTS = "high bigint, low bigint, elements binary"


class _Sets:
    """The shingle sets of some texts: ``values`` one text after the other, each in order."""

    def __init__(self, texts: list[bytes | None], n: int):
        words = Words(texts, lower=True)
        h, counts = words.hashes(), words.counts
        sizes = np.where(counts > 0, np.maximum(counts - n + 1, 1), 0)
        before, begin = np.cumsum(counts) - counts, np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) + np.repeat(before - begin, sizes)
        end = np.repeat(before + counts, sizes)
        grams = np.zeros(len(at), np.uint64)
        for k in range(n):
            word = h[np.minimum(at + k, len(h) - 1)] if len(h) else h
            grams = np.where(at + k < end, mix64(grams * _C1 + word + np.uint64(k)), grams)
        text = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((grams, text))
        grams, text = grams[order], text[order]
        first = np.ones(len(grams), bool)
        first[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
        self.values, self.sizes = grams[first], np.bincount(text[first], minlength=len(sizes))
        self.some = np.flatnonzero(self.sizes)
        self.begin = np.cumsum(self.sizes) - self.sizes

    def reduced(self, how: np.ufunc, values: np.ndarray, none: int) -> np.ndarray:
        out = np.full(len(self.sizes), none, np.uint64)
        if len(self.some):
            out[self.some] = how.reduceat(values, self.begin[self.some])
        return out

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits that tell sets apart."""
        return tuple(self.reduced(np.add, mix64(self.values ^ c), 0) for c in (_C1, _C2))


def _described(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for rows, texts in feeds(batches, 2, FEED_BYTES):
        sets = _Sets(texts, n)
        high, low = sets.names()
        least = np.stack([sets.reduced(np.minimum, (sets.values ^ b) * a, 0) for a, b in _DRAW], 1)
        tokens = mix64(least)
        branch = np.arange(ROOTS, dtype=np.uint64)
        nodes = mix64(tokens[:, :ROOTS] * _C2 + branch)
        packed = (tokens >> np.uint64(48)).astype(np.uint16)
        offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * ROOTS)
        yield pa.RecordBatch.from_arrays(
            [
                rows.column(0),
                pa.array(high.view(np.int64)),
                pa.array(low.view(np.int64)),
                pa.array(sets.sizes.astype(np.int64)),
                pa.array([row.tobytes() for row in packed], pa.binary()),
                pa.ListArray.from_arrays(offsets, pa.array(nodes.ravel().view(np.int64))),
            ],
            names=[rows.schema.names[0], "high", "low", "n_shingles", "tokens", "nodes"],
        )


def _asked_elements(batches: Iterator[pa.RecordBatch], n: int, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("high", pa.int64()), ("low", pa.int64()), ("elements", pa.binary())])
    sent: set[tuple[int, int]] = set()
    for rows, texts in feeds(batches, 2, FEED_BYTES):
        sets = _Sets(texts, n)
        high, low = (x.view(np.int64) for x in sets.names())
        place = (high ^ rows.column(1).to_numpy()) & (ASKED_BITS - 1)
        wanted = np.flatnonzero(bits[place] & (sets.sizes > 0))
        out = []
        for i in wanted.tolist():
            name = (int(high[i]), int(low[i]))
            if name not in sent:
                sent.add(name)
                out.append((*name, sets.values[sets.begin[i] : sets.begin[i] + sets.sizes[i]].tobytes()))
        if len(sent) > 1_000_000:
            sent.clear()
        if out:
            columns = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by their first column, all rows of a key together, some keys at a time."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        keys = rows.column(0).to_numpy()
        earlier = np.flatnonzero(keys != keys[-1]) if len(keys) else []
        if len(earlier):
            yield rows.slice(0, earlier[-1] + 1)
        held = rows.slice(earlier[-1] + 1) if len(earlier) else rows
    if held is not None and held.num_rows:
        yield held


def _ranges(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    new = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    yield from zip([0, *new.tolist()], [*new.tolist(), len(keys)])


def _forest(alike: np.ndarray) -> list[tuple[int, int]]:
    """(member, first member) for all but the first member of every component."""
    out, open_rows = [], np.ones(len(alike), bool)
    for i in range(len(alike)):
        if not open_rows[i]:
            continue
        open_rows[i] = False
        front = np.array([i])
        while len(front):
            front = np.flatnonzero(alike[front].any(0) & open_rows)
            open_rows[front] = False
            out += [(j, i) for j in front.tolist()]
    return out


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*edges) if edges else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _node_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Alike texts of whole nodes (node, class, n_shingles, tokens), by their tokens."""
    for rows in _whole_keys(batches):
        keys, ids, n = (rows.column(i).to_numpy() for i in range(3))
        tokens = np.frombuffer(b"".join(rows.column(3).to_pylist()), np.uint16).reshape(-1, TOKENS)
        edges = []
        pair = np.flatnonzero(keys[1:] == keys[:-1])
        alone = np.ones(len(pair), bool)  # both neighbours of the pair are other nodes
        alone[1:] &= pair[1:] != pair[:-1] + 1
        alone[:-1] &= pair[1:] != pair[:-1] + 1
        a = pair[alone]
        same = (tokens[a] == tokens[a + 1]).sum(1) >= AGREE
        fits = 100 * np.minimum(n[a], n[a + 1]) >= PERCENT * np.maximum(n[a], n[a + 1])
        hit = a[same & fits]
        edges += zip(ids[hit].tolist(), ids[hit + 1].tolist())
        for start, stop in _ranges(keys):
            if stop - start < 3:
                continue
            own, sizes = tokens[start:stop], n[start:stop]
            agree = np.zeros((stop - start, stop - start), np.uint8)
            for k in range(TOKENS):
                agree += own[:, k, None] == own[None, :, k]
            fits = 100 * np.minimum.outer(sizes, sizes) >= PERCENT * np.maximum.outer(sizes, sizes)
            edges += [(int(ids[start + i]), int(ids[start + j])) for i, j in _forest((agree >= AGREE) & fits)]
        yield _edge_batch(edges)


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(child, class) for members (node, class, tokens) of nodes that branch again."""
    for batch in batches:
        node = batch.column(0).to_numpy().view(np.uint64)
        ids = batch.column(1).to_numpy()
        tokens = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(-1, TOKENS)
        first = mix64(node ^ _C1) % np.uint64(TOKENS)
        second = (first + np.uint64(1) + mix64(node ^ _C2) % np.uint64(TOKENS - 1)) % np.uint64(TOKENS)
        two = (mix64(node ^ _C3) & np.uint64(3)) == 0
        out_nodes, out_ids = [], []
        for position, use in ((first, np.ones(len(node), bool)), (second, two)):
            rows = np.flatnonzero(use)
            token = tokens[rows, position[rows].astype(np.int64)].astype(np.uint64)
            out_nodes.append(mix64(node[rows] * _C2 + (token << np.uint64(8)) + position[rows]))
            out_ids.append(ids[rows])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(out_nodes).view(np.int64)), pa.array(np.concatenate(out_ids))],
            names=["node", "class"],
        )


def _shared_sizes(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of the sets' rows over the elements they share."""
    sizes = np.array([len(s) for s in sets])
    member = np.repeat(np.arange(len(sets)), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, member = values[order], member[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    times = np.diff(np.append(np.flatnonzero(new), len(values)))
    often = np.repeat(times > 1, times)
    column = (np.cumsum(new & often) - 1)[often]
    member = member[often]
    out, width = np.zeros((len(sets), len(sets)), np.float32), 1024
    bounds = np.searchsorted(column, np.arange(0, column[-1] + 1 + width, width)) if len(column) else []
    for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        held = np.zeros((len(sets), width), np.float32)
        held[member[a:b], column[a:b] - k * width] = 1
        out += held @ held.T
    return out.astype(np.int32)


def _exact_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Linked texts of whole groups (group, class, elements), by their full sets."""
    for rows in _whole_keys(batches):
        keys, ids = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        elements, edges = rows.column(2), []
        for start, stop in _ranges(keys):
            sets = [np.frombuffer(e, np.uint64) for e in elements.slice(start, stop - start).to_pylist()]
            sizes = np.array([len(s) for s in sets], np.int32)
            if len(sets) == 2:
                shared = np.intersect1d(*sets, assume_unique=True).size
                if 100 * shared >= PERCENT * (sizes.sum() - shared):
                    edges.append((int(ids[start + 1]), int(ids[start])))
            elif len(sets) > 2:
                shared = _shared_sizes(sets)
                alike = 100 * shared >= PERCENT * (sizes[:, None] + sizes[None, :] - shared)
                edges += [(int(ids[start + i]), int(ids[start + j])) for i, j in _forest(alike)]
        yield _edge_batch(edges)


def _together(rows: DataFrame, key: str, work) -> DataFrame:
    """Edges of a function over the rows, those of one key together; keys are of bounded size.

    Rows are dealt by a hash of the key: after a join on the key itself the planner would take this
    exchange for needless, and then read the join's own by mapper or in split partitions.
    """
    dealt = rows.repartition(F.xxhash64(key)).sortWithinPartitions(key)
    return dealt.mapInArrow(work, "a bigint, b bigint").where("a != b")


def _given(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.col(id), F.xxhash64(id).alias("_id_hash"), F.col(text).cast("binary").alias("_text"))


def described(docs: DataFrame, id: str, text: str, n: int = SHINGLE) -> DataFrame:
    """(id, high, low, n_shingles, tokens, nodes) of every row."""
    given = _given(docs, id, text)
    return given.mapInArrow(
        lambda batches: _described(batches, n), f"`{id}` {given.schema[0].dataType.simpleString()}, {DESCRIBED}"
    )


def clusters(classes: DataFrame, node: int = NODE, depth: int = DEPTH) -> DataFrame:
    """(a, b): a forest over classes (class, n_shingles, tokens, nodes) that may be alike."""
    told = classes.select("class", "n_shingles", "tokens")
    members = classes.where("n_shingles > 0").select(F.explode("nodes").alias("node"), "class")
    found = None
    for level in range(depth):
        members = cut(members)
        sizes = members.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
        placed = cut(attach(members, sizes, "node", "n").where("n > 1"))
        small = placed.where(F.col("n") <= node).join(told, "class")
        edges = cut(_together(small.select("node", "class", "n_shingles", "tokens"), "node", _node_edges))
        found = edges if found is None else found.unionByName(edges)
        large = placed.where(F.col("n") > node)
        if large.isEmpty():
            return found
        if level + 1 < depth:
            told_large = large.join(told, "class").select("node", "class", "tokens")
            members = told_large.mapInArrow(_children, "node bigint, class bigint")
    lowest = large.groupBy("node").agg(F.min("class").alias("b"), F.count("*").alias("n"))
    stars = attach(large.select("node", F.col("class").alias("a")), lowest, "node", "n").select("a", "b")
    return found.unionByName(cut(stars.where("a != b")))


def _bits(asked: DataFrame) -> np.ndarray:
    """The fixed-size bitmap of the rows whose sets are wanted."""
    bit = asked.select((F.col("bit") + 1).alias("bit"))
    parts = bit.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    out = np.zeros(ASKED_BITS, bool)
    for bucket, bits in parts.collect():
        start = (bucket - 1) * len(bits) * 8
        out[start : start + len(bits) * 8] = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").view(bool)
    return out


def settled(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """(node, component) of the classes that are linked, from clusters (cluster, class, n_shingles, elements).

    A component is named by one of its classes, which may be left out.
    """
    sizes = members.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("elements_n"))
    blocks = F.ceil(F.greatest(F.col("n") / block, F.col("elements_n") / BLOCK_ELEMENTS))
    counted = cut(sizes.select("cluster", "n", blocks.alias("blocks")))
    large = counted.where("blocks > 2")
    if large.isEmpty():
        return _named(members)
    # At most one cluster for every two blocks of texts or elements.
    small = members.join(F.broadcast(large.select("cluster")), "cluster", "left_anti")
    return _named(small).unionByName(components(_large_edges(members, large, block), "a", "b"))


def _named(members: DataFrame) -> DataFrame:
    """Clusters of one task: its edges all end in the first member of their component."""
    edges = _together(members.select("cluster", "class", "elements"), "cluster", _exact_edges)
    return cut(edges.select(F.col("a").alias("node"), F.col("b").alias("component")))


def _large_edges(members: DataFrame, large: DataFrame, block: int) -> DataFrame:
    """(a, b): enough of the links in the large clusters."""
    drawn = F.xxhash64("class")
    held = cut(attach(members.drop("n_shingles"), large, "cluster", "n").where("blocks is not null"))
    group = F.xxhash64("cluster", F.col("slot"))
    dealt = held.select("cluster", F.pmod(drawn, "blocks").alias("slot"), "class", "elements")
    first = Window.partitionBy("cluster").orderBy(drawn, "class")
    shared = held.select("cluster", "blocks", "class", F.row_number().over(first).alias("rank")).where(F.col("rank") <= PIVOTS)
    shared = held.select("class", "elements").join(shared.drop("rank"), "class")
    copies = shared.select(
        "cluster", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("slot"), F.pmod(drawn, "blocks").alias("home"), "class", "elements"
    ).where("slot != home").drop("home")
    both = dealt.unionByName(copies).select(group.alias("group"), "class", "elements")
    found = cut(_together(both, "group", _exact_edges))

    # Where a cluster is still in parts: blocks of one large part each, and of small parts.
    joined = components(found, "a", "b")
    parts = held.select("cluster", "class").join(joined, F.col("class") == F.col("node"), "left")
    parts = cut(parts.select("cluster", "class", F.coalesce("component", "class").alias("part")))
    sized = cut(parts.groupBy("cluster", "part").agg(F.count("*").alias("n_part")))
    loose = F.sum(F.when(F.col("n_part") < block, F.col("n_part")).otherwise(0))
    open_clusters = sized.groupBy("cluster").agg(F.count("*").alias("parts"), loose.alias("loose")).where("parts > 1")
    sized = sized.join(open_clusters, "cluster")
    own = F.col("n_part") >= block
    many = F.ceil(F.when(own, F.col("n_part")).otherwise(F.col("loose")) / block)
    slots = sized.select("cluster", "part", own.alias("own"), many.alias("many"))
    slot = F.when(F.col("own"), F.pmod(F.xxhash64("class"), "many")).otherwise(F.pmod(F.xxhash64("part"), "many"))
    whose = F.when(F.col("own"), F.col("part"))
    assigned = cut(
        parts.join(slots, ["cluster", "part"]).select(
            "cluster", "class", whose.alias("whose"), F.xxhash64("cluster", whose, slot).alias("block")
        )
    )
    listed = cut(assigned.select("cluster", "block", "whose").distinct())
    one = listed.select("cluster", F.col("block").alias("block_a"), F.col("whose").alias("whose_a"))
    two = listed.select("cluster", F.col("block").alias("block_b"), F.col("whose").alias("whose_b"))
    apart = (F.col("block_a") < F.col("block_b")) & ~F.coalesce(F.col("whose_a") == F.col("whose_b"), F.lit(False))
    itself = (F.col("block_a") == F.col("block_b")) & F.col("whose_a").isNull()
    tasks = one.join(two, "cluster").where(apart | itself)
    tasks = tasks.select(F.xxhash64("block_a", "block_b").alias("group"), F.explode(F.array_distinct(F.array("block_a", "block_b"))).alias("block"))
    needed = cut(assigned.select("class", "block").join(tasks, "block").select("group", "class"))
    met = needed.join(held.select("class", "elements"), "class").select("group", "class", "elements")
    return found.unionByName(cut(_together(met, "group", _exact_edges)))


def near_copies(
    docs: DataFrame, id: str, text: str, n: int = SHINGLE, node: int = NODE, block: int = BLOCK, depth: int = DEPTH
) -> DataFrame:
    """(id, n_shingles, component_id) of every row."""
    rows = cut(described(docs, id, text, n))
    first = F.struct(F.col(id).isNull(), F.col(id).alias("id"))
    same = rows.where("n_shingles > 0").groupBy("high", "low").agg(
        F.min(first).alias("first"),
        F.count("*").alias("n_rows"),
        *[F.first(c).alias(c) for c in ("n_shingles", "tokens", "nodes")],
    )
    classes = cut(same.withColumn("class", F.monotonically_increasing_id()))
    near = cut(components(clusters(classes, node, depth), "a", "b"))
    asked = classes.join(near, F.col("class") == F.col("node")).select(
        "class", "high", "low", "n_shingles", "first", F.col("component").alias("cluster")
    )
    place = F.col("high").bitwiseXOR(F.xxhash64("first.id")).bitwiseAND(F.lit(ASKED_BITS - 1))
    bits = _bits(asked.select(place.alias("bit")))
    sets = _given(docs, id, text).mapInArrow(lambda batches: _asked_elements(batches, n, bits), ELEMENTS)
    sets = sets.groupBy("high", "low").agg(F.first("elements").alias("elements"))
    members = cut(asked.drop("first").join(sets, ["high", "low"]).select("cluster", "class", "n_shingles", "elements"))
    linked = settled(members, block)
    joined = classes.join(linked, F.col("class") == F.col("node"), "left").select(
        "high", "low", "first", "n_rows", F.coalesce("component", "class").alias("component")
    )
    named = joined.groupBy("component").agg(F.min("first").alias("_kept"))
    key = F.struct("high", "low")
    of_class = joined.join(named, "component").select(key.alias("_set"), "n_rows", F.col("_kept.id").alias("_named"))
    keyed = rows.select(id, "n_shingles", F.when(F.col("n_shingles") > 0, key).alias("_set"))
    placed = attach(keyed, of_class, "_set", "n_rows")
    return placed.select(
        id, "n_shingles", F.when(F.col("_set").isNull(), F.col(id)).otherwise(F.col("_named")).alias("component_id")
    )
