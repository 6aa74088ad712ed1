"""Blocked Bloom filters built and tested with SQL functions.

A hash picks one block of 32,768 bits and two bits inside it. A filter over n hashes
takes 16 bits for each, up to ``MAX_BLOCKS`` blocks of 4 KB, so the broadcast never
exceeds 16 MB. Beyond that size a filter lets more hashes pass by mistake, which costs
work and never a result, as every use is followed by an exact step.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32768
MAX_BLOCKS = 4096


def block_count(n: int) -> int:
    """Power of two of blocks that gives 16 bits to each of ``n`` hashes, within the bound."""
    return min(MAX_BLOCKS, 1 << max(0, (16 * max(n, 1) - 1) // BLOCK_BITS).bit_length())


def block_of(h: Column, blocks: int) -> Column:
    return h.bitwiseAND(F.lit(blocks - 1).cast("long")).cast("int")


def bits_of(h: Column) -> Column:
    """The two bits of a hash inside its block."""
    mask = F.lit(BLOCK_BITS - 1).cast("long")
    return F.array(F.shiftrightunsigned(h, 16).bitwiseAND(mask), F.shiftrightunsigned(h, 40).bitwiseAND(mask))


def bitmaps(cells: DataFrame) -> DataFrame:
    """(block, bit) rows to one bitmap for each block: column ``bits``, 4 KB."""
    return cells.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def filter_of(hashes: DataFrame, h: str, blocks: int) -> DataFrame:
    """Filter that holds the hashes in column ``h``."""
    return bitmaps(hashes.select(block_of(F.col(h), blocks).alias("block"), F.explode(bits_of(F.col(h))).alias("bit")))


def repeated_filter(hashes: DataFrame, h: str, blocks: int) -> DataFrame:
    """Filter of bits that were hit more than once: a hash that occurs twice has both of its bits in it.

    Hits are summed in each task before the shuffle, so a frequent hash sends a row per task.
    """
    bits = F.explode(F.array_distinct(bits_of(F.col(h))))
    hits = hashes.select(block_of(F.col(h), blocks).alias("block"), bits.alias("bit")).groupBy("block", "bit").count()
    return bitmaps(hits.filter(F.col("count") > 1))


def _bit_set(bits: Column, bit: Column) -> Column:
    byte = F.substring(bits, (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.pmod(F.floor(value / F.pow(F.lit(2), bit % 8)), F.lit(2)) == 1


def might_hold(df: DataFrame, h: str, blocks_of: DataFrame, blocks: int, name: str) -> DataFrame:
    """Add boolean ``name``: whether the filter may hold the hash in column ``h``. No shuffle."""
    held = blocks_of.select(F.col("block").alias("_block"), F.col("bits").alias("_bits"))
    both = bits_of(F.col(h))
    return (
        df.withColumn("_block", block_of(F.col(h), blocks)).join(F.broadcast(held), "_block", "left")
        .withColumn(name, F.coalesce(_bit_set(F.col("_bits"), both[0]) & _bit_set(F.col("_bits"), both[1]), F.lit(False)))
        .drop("_block", "_bits")
    )


class LocalFilter:
    """The same filter as one numpy array of at most 16 MB, for use inside tasks."""

    def __init__(self, blocks_of: DataFrame, blocks: int):
        self.blocks = blocks
        self.bytes = np.zeros((blocks, BLOCK_BITS // 8), dtype=np.uint8)
        for row in blocks_of.collect():  # at most MAX_BLOCKS rows of 4 KB
            self.bytes[row["block"]] = np.frombuffer(row["bits"], dtype=np.uint8)

    def might_hold(self, h: np.ndarray) -> np.ndarray:
        """``h``: int64 or uint64 hashes."""
        u = h.view(np.uint64)
        block = (u & np.uint64(self.blocks - 1)).astype(np.int64)
        found = np.ones(len(u), dtype=bool)
        for shift in (16, 40):
            bit = ((u >> np.uint64(shift)) & np.uint64(BLOCK_BITS - 1)).astype(np.int64)
            found &= (self.bytes[block, bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
        return found
