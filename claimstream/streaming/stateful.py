"""The sliding-window count as a keyed stateful operator of the streaming query itself.

``jobs.positives_in_window`` keeps its state in tables and splits a stream of any length over many
tasks.  Here the state of a stream lives in the query's own checkpoint, so there is nothing to write
or compact between batches; in turn the rows a batch has of one stream are worked on by one
task.  Use it where streams are many and a rate limit bounds the batch, the other where one
stream may fill it.  Both give the numbers of the batch operator.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from claimstream.functions import scored as S
from claimstream.operators.dgim import continued
from claimstream.operators import scored as ops
from claimstream.sources.sinks import write_batch

# Of each stream: rows so far, the overhang of the estimate, the bits of the last window, the estimate.
STATE = "pos bigint, overhang bigint, recent binary, estimate bigint"


def window_counts(
    messages: DataFrame, keys: Sequence[str], order: Sequence[str], window: int = 1000, idle_ms: int | None = None
) -> DataFrame:
    """(keys, pos, exact, estimate) at the end of every stream that a batch has rows of.

    A batch's rows of a stream are put in the order of ``order``; from batch to batch they must
    arrive in it.  A stream without rows for ``idle_ms`` of processing time is forgotten and counts from
    the start when it comes back.
    """
    keys, order = list(keys), list(order)
    bit = S.positive_bit(F.col("predicted_label")).alias("is_positive")
    bits = ops.parse_scored(messages, [*keys, *order]).select(*keys, *order, bit)
    names = ("pos", "exact", "estimate")
    result = StructType([*[messages.schema[k] for k in keys], *[StructField(n, LongType()) for n in names]])

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        pos, overhang, recent, _ = state.get if state.exists else (0, 0, b"", 0)
        rows = pd.concat(list(batches)).sort_values(order)
        new = rows["is_positive"].to_numpy().astype(np.int32)
        known = np.frombuffer(recent, np.uint8).astype(np.int32)
        exact, estimate = continued(known, new, overhang, window)
        pos += len(new)
        kept = np.concatenate([known, new])[-window:].astype(np.uint8).tobytes()
        state.update((pos, int(estimate[-1] - exact[-1]), kept, int(estimate[-1])))
        if idle_ms is not None:
            state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame([(*key, pos, int(exact[-1]), int(estimate[-1]))], columns=[*keys, *names])

    timeout = GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return bits.groupBy(*keys).applyInPandasWithState(advance, result, STATE, "update", timeout)


def write_window_counts(counts: DataFrame, out: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Write the counts of each batch under batch_id=<n>; a batch that runs again replaces its own."""
    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: write_batch(batch, out, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
