import random

import pytest
from pyspark.sql import functions as F

from claimstream.operators.dgim import dgim, dgim_buckets, dgim_state, window_ends
from claimstream.operators.positions import packed_streams, window_counts, with_positions
from claimstream.session import cut


class SlowHistogram:
    """The textbook method, one bit at a time: a list of (size, time), newest first."""

    def __init__(self, window):
        self.window, self.now, self.buckets = window, 0, []

    def add(self, bit):
        self.now += 1
        if self.buckets and self.buckets[-1][1] <= self.now - self.window:
            self.buckets.pop()
        if bit:
            self.buckets.insert(0, (1, self.now))
            size = 1
            while True:
                same = [i for i, b in enumerate(self.buckets) if b[0] == size]
                if len(same) < 3:
                    break
                newer, older = same[-2], same[-1]
                self.buckets[newer] = (2 * size, self.buckets[newer][1])
                del self.buckets[older]
                size *= 2
        return sum(size for size, _ in self.buckets)


def streams(seed, lengths):
    draw = random.Random(seed)
    out = []
    for key, n in lengths.items():
        density = draw.choice([0.02, 0.3, 0.5, 0.9, 1.0])
        for i in range(n):
            if i % 400 == 0:
                density = draw.choice([0.0, 0.05, 0.4, 0.8, 1.0])
            out.append((key, i, int(draw.random() < density)))
    return out


def slow(rows, window):
    machines, seen, out = {}, {}, {}
    for key, i, bit in sorted(rows):
        machine = machines.setdefault(key, SlowHistogram(window))
        history = seen.setdefault(key, [])
        history.append(bit)
        out[key, i] = (len(history), sum(history[-window:]), machine.add(bit))
    return out, machines


def frame(spark, rows):
    draw = random.Random(1)
    rows = list(rows)
    draw.shuffle(rows)
    return spark.createDataFrame(rows, "key string, i bigint, bit int")


def as_dict(df):
    return {(r.key, r.i): (r.pos, r.exact, r.estimate) for r in df.collect()}


@pytest.mark.parametrize("window,chunk,fan", [(1000, 65536, 256), (50, 64, 3), (37, 37, 4), (1, 300, 2)])
def test_estimates_equal_the_serial_method(spark, window, chunk, fan):
    rows = streams(window, {"a": 2500, "b": 130, "c": 1})
    expected, _ = slow(rows, window)
    got = as_dict(dgim(frame(spark, rows), ["key"], ["i"], "bit", window, chunk_rows=chunk, fan=fan))
    assert got == expected
    for _, exact, estimate in got.values():
        assert exact <= estimate < max(2 * exact, 1)


def test_state_continues_and_buckets_match(spark):
    window = 60
    rows = streams(5, {"a": 700, "b": 90})
    expected, machines = slow(rows, window)
    got, state = {}, None
    for low, high in [(0, 20), (20, 25), (25, 400), (400, 700)]:
        part = frame(spark, [r for r in rows if low <= r[1] < high])
        result = dgim(part, ["key"], ["i"], "bit", window, state=state, chunk_rows=64, fan=2).checkpoint()
        got.update(as_dict(result))
        state = dgim_state(result, ["key"], "bit", window, state).checkpoint()
    assert got == expected
    for r in dgim_buckets(state, ["key"], window).collect():
        machine = machines[r.key]
        assert r.stream_position == machine.now
        assert [(b["size"], b["ts"]) for b in r.buckets] == machine.buckets
        assert r.total_ones == sum(size for size, _ in machine.buckets)


def test_positions_and_exact_counts_over_many_chunks(spark):
    rows = streams(9, {"a": 900, None: 40})
    df = frame(spark, rows)
    placed = with_positions(df, ["key"], ["i"])
    assert all(r.pos == r.i + 1 for r in placed.collect())
    counted = window_counts(placed, ["key"], "bit", 30, chunk_rows=45)
    bits = {(k, i): b for k, i, b in rows}
    assert counted.count() == 940
    for r in counted.collect():
        assert r.exact == sum(bits[r.key, j] for j in range(max(0, r.i - 29), r.i + 1))


def test_all_ones_then_silence(spark):
    rows = [("k", i, int(i < 1500)) for i in range(2600)]
    got = as_dict(dgim(frame(spark, rows), ["key"], ["i"], "bit", 1000))
    pos, exact, estimate = got["k", 1400]
    assert exact == 1000 and 1000 <= estimate < 2000
    assert got["k", 2599][1:] == (0, 0)


def test_columns_come_back_unchanged_in_any_time_zone(spark):
    rows = spark.range(300).select(
        F.timestamp_micros(F.col("id") * 60_000_000).alias("key"),
        "id",
        F.timestamp_micros(F.lit(10**15) + F.col("id")).alias("ts"),
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("maybe"),
        (F.col("id") % 2).alias("bit"),
    ).withColumn("key", F.date_trunc("hour", "key"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        result = dgim(rows, ["key"], ["ts", "id"], "bit", 20, chunk_rows=25, fan=2)
        assert sorted(map(tuple, result.select(rows.columns).collect()), key=lambda r: r[1]) == [
            tuple(r) for r in rows.orderBy("id").collect()
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_small_chunks_share_a_call(spark):
    """Chunks far smaller than usual are grouped many to a call of a worker, in every step."""
    rows = spark.range(400).select(F.lit("k").alias("k"), "id", (F.col("id") % 3 == 0).cast("int").alias("bit"))
    found = dgim(rows, ["k"], ["id"], "bit", window=4, chunk_rows=4, fan=3)
    calls = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FlatMap" in line]
    assert calls and all("_pack" in line for line in calls)
    assert all(r.exact == sum(i % 3 == 0 for i in range(max(0, r.id - 3), r.id + 1)) for r in found.collect())


def test_window_ends_equal_the_state_after_every_row(spark):
    """Streams of one row up to many chunks, a null key, small Arrow batches, state carried on."""
    draw, keys, window, chunk_rows = random.Random(15), ["a", "b"], 7, 9
    sizes = {("x", 1): 400, ("x", None): 1, (None, 1): 30, (None, None): 18, ("y", 2): 9}
    state = {
        name: spark.createDataFrame(
            [], "a string, b int, pos bigint, overhang bigint, recent array<int>"
        )
        for name in ("rows", "ends")
    }
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "23")
    try:
        for batch in range(3):
            rows = [
                (*key, batch * 1000 + i, int(draw.random() < [0.9, 0.3, 0.6][batch]))
                for key, n in sizes.items()
                for i in range(n if batch < 2 else n // 4)
            ]
            draw.shuffle(rows)
            df = spark.createDataFrame(rows, "a string, b int, t int, bit int").repartition(3)
            counted = cut(dgim(df, keys, ["t"], "bit", window, state["rows"], chunk_rows, fan=3))
            state["rows"] = cut(dgim_state(counted, keys, "bit", window, state["rows"]))
            pieces = cut(packed_streams(df, keys, ["t"], "bit"))
            assert pieces.agg(F.sum("_n"), F.sum("_ones")).first() == (len(rows), sum(r[3] for r in rows))
            ends = window_ends(pieces, keys, window, state["ends"], chunk_rows, fan=3)
            newest = {r[:2]: tuple(r) for r in state["ends"].collect()} | {r[:2]: tuple(r) for r in ends.collect()}
            assert newest == {r[:2]: tuple(r) for r in state["rows"].collect()}
            state["ends"] = spark.createDataFrame(list(newest.values()), state["ends"].schema)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
