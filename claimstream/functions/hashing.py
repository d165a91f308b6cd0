"""Hashes with a plain definition: the leading hex digits of an md5."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 7
HASH_RANGE = 16**HEX_DIGITS

# Fixed value: a prime above the hash range; a * h + b stays below 2^61.
PRIME = 2147483647


def small_hash(value: Column) -> Column:
    """A 28-bit number from the md5 of a string."""
    return F.conv(F.substring(F.md5(value), 1, HEX_DIGITS), 16, 10).cast("bigint")


def priority(value: Column, seed: int) -> Column:
    """A seeded random-looking order key that depends on the row id only."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), value.cast("string")))


def permutation(i: int) -> tuple[int, int]:
    """Factor and offset of the i-th hash permutation x -> (a x + b) mod PRIME."""

    def draw(name: str) -> int:
        return int(hashlib.md5(f"{name}{i}".encode()).hexdigest()[:15], 16)

    return 1 + draw("a") % (PRIME - 1), draw("b") % PRIME
