"""A Bloom filter of keys, to tell rows that may match a large key set from rows that cannot.

The filter is a table of blocks. A key's hash names its block and the few bits that it sets there, so
a row meets one block, by a broadcast join, and tests its bits with built-in functions. Keys
are shuffled to their blocks as hashes of 8 bytes, so that what is shuffled grows with the keys and not with
the number of tasks that read them; how large the blocks get together is fixed by their number.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32_768  # of a bitmap aggregate
_WORD_BITS = 32  # kept in a bigint each, so a block takes twice its bits' bytes
_POSITION_BITS = 15
_PER_HASH = 4  # positions in 64 bits
_BLOCK, _WORDS, _HASH = "__bloom_block", "__bloom_words", "__bloom_hash"


@dataclass(frozen=True)
class BloomFilter:
    """`frame` holds a row per block that has any key."""

    frame: DataFrame
    blocks: int
    hashes: int

    def maybe(self, rows: DataFrame, key: str) -> DataFrame:
        """The rows whose key may be in the set, and all whose key is."""
        return self._probed(rows, key, "inner").filter(self._hit(key)).select(*rows.columns)

    def never(self, rows: DataFrame, key: str) -> DataFrame:
        """The other rows: their key is not in the set, or NULL."""
        hit = F.coalesce(self._hit(key), F.lit(False))
        return self._probed(rows, key, "left").filter(~hit).select(*rows.columns)

    def _probed(self, rows: DataFrame, key: str, how: str) -> DataFrame:
        return rows.withColumn(_BLOCK, _block(_hash(key), self.blocks)).join(F.broadcast(self.frame), _BLOCK, how)

    def _hit(self, key: str) -> Column:
        bits = []
        for at in _positions(_hash(key), self.hashes):
            # The bitmap's byte, within a word that has the first byte highest, and the byte's bit.
            shift = F.lit(24) - (at.bitwiseAND(24)) + at.bitwiseAND(7)
            word = F.get(F.col(_WORDS), F.shiftright(at, 5))
            bits.append(F.getbit(word, shift) == 1)
        return F.col(key).isNotNull() & reduce(Column.__and__, bits)


def _hash(key: str) -> Column:
    """What stands for a key; its block and bits follow from it."""
    return F.xxhash64(key)


def _block(hashed: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), hashed), F.lit(blocks)).cast("int")


def _positions(hashed: Column, hashes: int) -> list[Column]:
    found = []
    for i in range(hashes):
        bits = F.xxhash64(F.lit(f"bits {i // _PER_HASH}"), hashed)
        moved = F.shiftrightunsigned(bits, _POSITION_BITS * (i % _PER_HASH))
        found.append(moved.bitwiseAND(BLOCK_BITS - 1).cast("int"))
    return found


def size_for(keys: int, max_bits: int, bits_per_key: int = 16) -> tuple[int, int] | None:
    """(blocks, hashes) for a number of keys; None where `max_bits` are too few to tell rows apart."""
    blocks = min(max_bits, max(BLOCK_BITS, keys * bits_per_key)) // BLOCK_BITS
    per_key = blocks * BLOCK_BITS / max(1, keys)
    if per_key < 1.5:  # about half of all rows would pass, or there is no block
        return None
    return blocks, max(1, min(2 * _PER_HASH, round(math.log(2) * per_key)))


def bloom_filter(keys: DataFrame, key: str, blocks: int, hashes: int) -> BloomFilter:
    """The filter of the non-NULL values of `key`."""
    hashed = keys.filter(F.col(key).isNotNull()).select(_hash(key).alias(_HASH))
    positions = F.explode(F.array(*_positions(F.col(_HASH), hashes))).alias("position")
    maps = (
        hashed.repartition(_block(F.col(_HASH), blocks))
        .select(_block(F.col(_HASH), blocks).alias(_BLOCK), positions)
        .groupBy(_BLOCK)
        .agg(F.bitmap_construct_agg(F.col("position")).alias("bitmap"))
    )

    def word(i: Column) -> Column:
        return F.conv(F.hex(F.substring(F.col("bitmap"), 1 + 4 * i, F.lit(4))), 16, 10).cast("bigint")

    words = F.transform(F.sequence(F.lit(0), F.lit(BLOCK_BITS // _WORD_BITS - 1)), word)
    return BloomFilter(maps.select(_BLOCK, words.alias(_WORDS)), blocks, hashes)
