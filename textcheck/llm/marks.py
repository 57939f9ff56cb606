"""Sets of numbers as bitmaps, so that rows with long texts are picked where they lie."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textcheck.session import materialise

#: Bits of a sieve for each number in it, and at most, so that it is bounded in memory.
BITS_EACH, MOST_BITS, BITMAP_BITS = 8, 1 << 26, 1 << 15


def _bitmaps(places: DataFrame) -> DataFrame:
    """(bucket, bits): the column ``place`` (from 0), BITMAP_BITS places in a row."""
    # The functions count from 1.
    at = F.col("place") + 1
    return materialise(places.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")))


def _marked(rows: DataFrame, bitmaps: DataFrame, place: Column) -> DataFrame:
    """The ``rows`` whose ``place`` has its bit."""
    at = F.bitmap_bit_position(place + 1).cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), at % 8 + 1))
    return rows.join(bitmaps, F.bitmap_bucket_number(place + 1) == F.col("bucket")).where(bit > 0).select(
        *[rows[f"`{c}`"] for c in rows.columns])


def with_numbers(rows: DataFrame, numbers: DataFrame, number: str) -> DataFrame:
    """The ``rows`` whose ``number`` is among ``numbers``, a frame of that column, without nulls.

    For dense numbers from 0, as of ``monotonically_increasing_id``: a bit for each number from the
    first to the last of a partition. Spark sends the bitmaps to the rows while they are small."""
    return _marked(rows, _bitmaps(numbers.select(F.col(number).alias("place"))), F.col(f"`{number}`"))


def sieved(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The ``rows`` whose ``key`` may be among ``keys``, a frame of one column: all that are, and
    about one in BITS_EACH of the others. An exact join has to follow; it shuffles fewer rows."""
    size = BITMAP_BITS * max(1, -(-min(BITS_EACH * keys.count(), MOST_BITS) // BITMAP_BITS))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(size))
    bitmaps = _bitmaps(keys.select(place(F.col(f"`{keys.columns[0]}`")).alias("place")))
    return _marked(rows, F.broadcast(bitmaps), place(F.col(f"`{key}`")))
