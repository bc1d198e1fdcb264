"""Rows that may have a partner with equal values.

An 8-byte hash of the compared values is counted, combined before the shuffle.  The
hashes met twice set bits of a bitmap of ``SLOTS`` slots; it is broadcast, its size
being bound by ``SLOTS`` whatever the data (16 MiB), and rows whose bit is not set are
dropped where they lie.  What is left holds every repeated row, and as many single ones
as the bitmap is full: most rows of a table of mostly single rows are never shuffled
with their values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 27         # a power of two
_BITS = 15              # a bucket of the bitmap functions has 2^15 bits


def _slot(cols: Sequence[str]) -> Column:
    """0 to SLOTS - 1.  Written without nullable steps: a join key that could be null
    would be tested once more, with all that the compared columns are made of."""
    return F.xxhash64(*(F.col(f"`{c}`") for c in cols)).bitwiseAND(F.lit(SLOTS - 1))


def repeated_slots(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(bucket, bits) of the hashes that occur more than once: at most SLOTS / 32,768
    rows of 4 KiB."""
    twice = (df.groupBy(F.xxhash64(*(F.col(f"`{c}`") for c in cols)).alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
             .where(F.col("_n") > 1).select(F.col("_h").bitwiseAND(F.lit(SLOTS - 1)).alias("_slot")))
    return (twice.groupBy(F.shiftright("_slot", _BITS).alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.col("_slot").bitwiseAND(F.lit((1 << _BITS) - 1))).alias("_bits")))


def maybe_repeated(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``df`` without rows that have no partner for sure; ``cols`` (all by default) are
    compared, a null being equal to a null."""
    cols = list(cols or df.columns)
    probed = df.withColumn("_slot", _slot(cols))
    met = probed.join(F.broadcast(repeated_slots(df, cols)), F.shiftright("_slot", _BITS) == F.col("_bucket"))
    at = F.col("_slot").bitwiseAND(F.lit((1 << _BITS) - 1))
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(at, 3).cast("int") + 1, 1)), 16, 10).cast("int")
    # a power of two stands for the bit; the lowest bit comes first
    return met.where(byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0).select(*(F.col(f"`{c}`") for c in df.columns))
