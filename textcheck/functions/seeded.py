"""Hash columns in place of random numbers.

``rand(seed)`` depends on how rows are spread over partitions; a hash of
(seed, key) gives each row the same value in any plan and after any retry.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60


def seeded_digest(seed: int, *parts: Column) -> Column:
    """md5 of ``seed:part:part…`` as hex text."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def hex_number(digest: Column, start: int, length: int) -> Column:
    """``length`` (<= 15) hex digits of a digest as BIGINT."""
    return F.conv(F.substring(digest, start, length), 16, 10).cast("bigint")


def seeded_hash(seed: int, *parts: Column) -> Column:
    """Uniform 60-bit number of (seed, parts)."""
    return hex_number(seeded_digest(seed, *parts), 1, HASH_BITS // 4)
