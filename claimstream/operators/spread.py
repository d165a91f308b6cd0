"""Skew-safe building blocks: a key may hold a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 256


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; the right copies of the keys go."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys]
    )
    # A semi join has no right columns; dropping names that are not there does nothing.
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def spread_lookup(
    big: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_by: str,
    salts: int = SALTS,
) -> DataFrame:
    """Inner-join ``lookup`` onto ``big`` when some keys of ``big`` are very frequent.

    Null keys match each other.

    Rows of ``big`` are cut into ``salts`` slices per key by a hash of ``spread_by``.
    The lookup rows are copied only to the (key, slice) pairs that occur, so a rare key
    costs one copy and a frequent key is joined by up to ``salts`` tasks.
    """
    sliced = big.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
    occurring = sliced.select(*keys, "_salt").distinct()
    copies = same_keys(occurring, lookup, keys)
    return same_keys(sliced, copies, [*keys, "_salt"]).drop("_salt")
