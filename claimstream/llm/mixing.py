"""Mixing sources to target weights by a min-cost flow.

A document may belong to several sources.  Documents are aggregated by their membership
pattern; a flow network routes each pattern's words to the quotas of its sources, where the
r-th use of a word costs r - 1, so that repetition is convex: no word is used twice while an
unused one would do.  A pattern of one source that no other pattern shares gives what its
source should give; that needs no flow, and any number of such sources stays in tables.
The other patterns make a network with one node per pattern and source that is solved on
the driver; the number of patterns of several sources is checked first.  What a pattern must
give is then taken from its documents in a seeded order: every document as many full times as
fits, and the rest from the first documents of that order, up to the nearest whole document.

The place where the order of a pattern with over a thousandth of the rows is cut is found by
refining a prefix of the order key, 256 bins at a time, so no task and no driver sees more
than bin sums; those patterns number under a thousand.  Other patterns are put in order each.

Defined results: null texts and texts without words have size 0 and are taken 0 times; a
null source is a source of its own, the last one; a document of no source is taken 0 times;
rows of one id go together in the order; an empty table gives no rows; reruns agree,
whatever the partitioning.
"""

from __future__ import annotations

import math
from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimstream.llm.common import HEAVY_KEYS, cut, split_words

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
SEED = 42
# The flow is solved on the driver: more patterns of several sources are refused, not sampled.
MAX_PATTERNS = 4096
_DIGITS, _LEVELS = 2, 4


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(split_words(text)), F.lit(0)).cast("bigint")


def order_key(id: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit("null"))))


def targets(sizes: dict, share: float = SHARE, repeats: int = REPEATS, weights=WEIGHTS) -> dict:
    """Words each source should give: by weight, never above ``repeats`` times its size.

    What a full source cannot give is reshared among the others by weight.
    """
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, spent, heavy = share * sum(sizes.values()), 0, sum(weight.values())
    out = {}
    for s in sorted(names, key=lambda s: (repeats * sizes[s] / weight[s], s is None, s or "")):
        level = (total - spent) / heavy
        out[s] = min(float(repeats * sizes[s]), level * weight[s])
        if repeats * sizes[s] / weight[s] <= level:
            spent += repeats * sizes[s]
            heavy -= weight[s]
        if not heavy:
            break
    for s in names:
        out.setdefault(s, 0.0)
    return out


def route(supply: dict, quota: dict, repeats: int = REPEATS) -> dict:
    """Words every pattern gives, by successive cheapest paths.

    ``supply`` maps a pattern (a tuple of sources) to its words.  The paths run from the
    start over a pattern and a source to the end; flow may be taken back on the way.
    """
    nodes = ["start", "end", *[("p", p) for p in supply], *[("s", s) for s in quota]]
    at = {n: i for i, n in enumerate(nodes)}
    head: list[list[int]] = [[] for _ in nodes]
    to, room, cost = [], [], []

    def arc(a: int, b: int, capacity: float, price: int) -> None:
        for x, y, c, w in ((a, b, capacity, price), (b, a, 0.0, -price)):
            head[x].append(len(to))
            to.append(y)
            room.append(c)
            cost.append(w)

    for p, words in supply.items():
        for r in range(repeats):
            arc(0, at["p", p], float(words), r)
        for s in p:
            arc(at["p", p], at["s", s], math.inf, 0)
    for s, words in quota.items():
        arc(at["s", s], 1, words, 0)
    while True:
        price = [math.inf] * len(nodes)
        price[0], via, waiting = 0, [-1] * len(nodes), deque([0])
        queued = [False] * len(nodes)
        while waiting:
            a = waiting.popleft()
            queued[a] = False
            for e in head[a]:
                if room[e] > 1e-6 and price[a] + cost[e] < price[to[e]]:
                    price[to[e]] = price[a] + cost[e]
                    via[to[e]] = e
                    if not queued[to[e]]:
                        queued[to[e]] = True
                        waiting.append(to[e])
        if price[1] == math.inf:
            break
        path, n = [], 1
        while n:
            path.append(via[n])
            n = to[via[n] ^ 1]
        push = min(room[e] for e in path)
        for e in path:
            room[e] -= push
            room[e ^ 1] += push
    given = dict.fromkeys(supply, 0.0)
    for e in head[0]:
        given[nodes[to[e]][1]] += room[e ^ 1]
    return given


def quotas(sources: DataFrame, share: float = SHARE, repeats: int = REPEATS, weights=WEIGHTS) -> DataFrame:
    """(source, source_size, target) of (source, source_size): ``targets`` for any number of sources.

    The level is raised until no further source is full; each step is one sum over the sources.
    """
    placed = cut(
        sources.orderBy(F.col("source").asc_nulls_last()).withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", 33)
    # One row per partition of the sort.
    counts = sorted(placed.groupBy(part.alias("part")).count().collect())
    starts, before = [], 0
    for r in counts:
        starts.append((r["part"], before))
        before += r["count"]
    offsets = sources.sparkSession.createDataFrame(starts, "_part bigint, _before bigint")
    index = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before")
    weight = F.get(F.array(*map(F.lit, weights)), (index % len(weights)).cast("int"))
    weighed = cut(
        placed.join(F.broadcast(offsets), part == F.col("_part")).select(
            "source", "source_size", weight.alias("_weight")
        )
    )
    ratio = repeats * F.col("source_size") / F.col("_weight")
    sums = [F.coalesce(F.sum(c), F.lit(0)) for c in ("source_size", "_weight")]
    total, heavy = weighed.agg(*sums).first()
    full, level = 0, share * total / heavy if heavy else math.inf
    while level < math.inf:
        size, weight_full = weighed.where(ratio <= level).agg(*sums).first()
        if weight_full == full:
            break
        full = weight_full
        level = (share * total - repeats * size) / (heavy - full) if heavy > full else math.inf
    whole = (repeats * F.col("source_size")).cast("double")
    target = F.when(ratio <= level, whole).otherwise(F.least(whole, level * F.col("_weight")))
    return weighed.select("source", "source_size", target.alias("target"))


def _given(patterns: DataFrame, quota: DataFrame) -> DataFrame:
    """Words that every pattern gives: (pattern, words, n, given, source_size, target).

    The last two are those of a pattern's only source.
    """
    spark = patterns.sparkSession
    source = F.get("_members", F.lit(0))
    several = patterns.where(F.size("_members") > 1).limit(MAX_PATTERNS + 1).collect()
    if len(several) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} patterns of several sources; name fewer sources")
    names = {m for r in several for m in r["_members"]}
    shared = F.broadcast(spark.createDataFrame([(m,) for m in names], "_shared string"))
    in_flow = source.eqNullSafe(F.col("_shared"))
    single = patterns.where(F.size("_members") <= 1)
    found = several + single.where(F.size("_members") == 1).join(shared, in_flow, "left_semi").collect()
    limits = quota.join(shared, F.col("source").eqNullSafe(F.col("_shared")), "left_semi").collect()
    routed = route(
        {tuple(r["_members"]): r["words"] for r in found}, {r["source"]: r["target"] for r in limits}
    )
    flow = spark.createDataFrame(
        [(r["pattern"], float(routed[tuple(r["_members"])])) for r in found], "pattern string, _routed double"
    )
    return (
        patterns.join(quota, (F.size("_members") == 1) & source.eqNullSafe(F.col("source")), "left")
        .join(F.broadcast(flow), "pattern", "left")
        .select(
            "pattern",
            "words",
            "n",
            F.coalesce("_routed", "target", F.lit(0.0)).alias("given"),
            "source_size",
            "target",
        )
    )


def _cuts(sized: DataFrame, heavy: DataFrame) -> DataFrame:
    """Where the order of each of the ``heavy`` patterns is cut: with ``_at`` and ``_rest`` from there."""
    spark, rows = sized.sparkSession, heavy.collect()
    plan = {r["pattern"]: [r["_full"], "", r["_rest"]] for r in rows}
    for level in range(_LEVELS):
        length = _DIGITS * (level + 1)
        cuts = spark.createDataFrame(
            [(p, at) for p, (_, at, _) in plan.items()], "pattern string, _at string"
        )
        bins = (
            sized.join(F.broadcast(cuts), "pattern")
            .where(F.substring("_key", 1, length - _DIGITS) == F.col("_at"))
            .groupBy("pattern", F.substring("_key", 1, length).alias("bin"))
            .agg(F.sum("size").alias("words"))
        )
        for r in sorted(bins.collect()):
            full, at, rest = plan[r["pattern"]]
            if len(at) == length:
                continue
            if rest < r["words"]:
                plan[r["pattern"]] = [full, r["bin"], rest]
            else:
                plan[r["pattern"]][2] = rest - r["words"]
        for p, (full, at, rest) in plan.items():
            if len(at) < length:  # everything before the end is taken
                plan[p] = [full, at + "g" * _DIGITS, rest]
    return spark.createDataFrame(
        [(r["pattern"], *plan[r["pattern"]], r["source_size"], r["target"]) for r in rows],
        "pattern string, _full int, _at string, _rest double, source_size bigint, target double",
    )


def mixed(
    docs: DataFrame, id: str, size: Column, members: Column, seed: int = SEED, whole: bool = False
) -> tuple[DataFrame, DataFrame]:
    """How often each document is used, and (source, source_size, target) of every source.

    The rows are (id, size, pattern, source_size, target, copies), with the size and target of the
    document's source if it has a single one.  ``members`` is an array of source names, null for
    an unnamed source.  ``pattern`` is the array in JSON.  With ``whole`` the rows
    have all columns of the documents, read once more, in a struct ``document``.
    """
    none = F.array().cast("array<string>")
    described = [
        F.col(id),
        size.alias("size"),
        F.to_json(F.array_sort(F.array_distinct(F.coalesce(members, none)))).alias("pattern"),
        order_key(F.col(id), seed).alias("_key"),
    ]
    sized = cut(docs.select(*described))
    patterns = cut(
        sized.groupBy("pattern")
        .agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        .withColumn("_members", F.from_json("pattern", "array<string>"))
    )
    listed = patterns.select(F.explode("_members").alias("source"), "words")
    quota = cut(quotas(cut(listed.groupBy("source").agg(F.sum("words").alias("source_size")))))
    words, given = F.col("words"), F.col("given")
    full = F.when(words > 0, F.least(F.floor(given / words + 1e-9), F.lit(REPEATS))).otherwise(REPEATS)
    plan = cut(
        _given(patterns, quota)
        .withColumn("_full", full.cast("int"))
        .withColumn("_rest", F.greatest(F.lit(0.0), F.round(given - F.col("_full") * words, 3)))
        .drop("words", "given")
    )
    heavy_from = (plan.agg(F.sum("n")).first()[0] or 0) / HEAVY_KEYS
    cuts = F.broadcast(_cuts(sized, plan.where(F.col("n") > heavy_from)))
    light = plan.where(F.col("n") <= heavy_from).drop("n")
    final = docs.select(*described, F.struct("*").alias("document")) if whole else sized
    placed = final.join(cuts, "pattern").withColumn("_bin", F.substring("_key", 1, _DIGITS * _LEVELS))
    clear = placed.where("_bin != _at").withColumn("_more", F.col("_bin") < F.col("_at"))
    order = Window.partitionBy("pattern").orderBy("_key", id)
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    taken = 2 * upto - F.col("size") <= 2 * F.col("_rest")
    edge = placed.where("_bin = _at").withColumn("_more", taken)
    rows = clear.unionByName(edge).drop("_at", "_bin")
    if not light.isEmpty():
        few = final.join(cuts.select("pattern"), "pattern", "left_anti").join(light, "pattern")
        rows = rows.unionByName(few.withColumn("_more", taken))
    copies = F.col("_full") + F.col("_more").cast("int")
    rows = rows.select(
        id,
        "size",
        "pattern",
        "source_size",
        "target",
        F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).alias("copies"),
        *(["document"] if whole else []),
    )
    return rows, quota


def mix(
    docs: DataFrame, id: str, size: Column, members: Column, seed: int = SEED, whole: bool = False
) -> tuple[DataFrame, dict, dict]:
    """``mixed`` for sources few enough for the driver: the rows without size and target of the
    source, and two dicts with each source's words and its target."""
    rows, quota = mixed(docs, id, size, members, seed, whole)
    found = quota.collect()
    sizes = {r["source"]: r["source_size"] for r in found}
    return rows.drop("source_size", "target"), sizes, {r["source"]: r["target"] for r in found}
