"""Blocked Bloom filters of keys, one per group, as ordinary rows.

A filter is cut into blocks of 512 bits; a key sets ``BITS`` bits of the one block its hash names, so a
test reads one row. Blocks are built by a map-side combined ``bit_or`` and tested in a join on
(group, block): both are spread over the cluster however many keys a group has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
BLOCK_BITS = 64 * WORDS
BITS = 4
BITS_PER_KEY = 16  # with four bits, about one strange key in 400 is taken for a known one

_WORDS = [f"w{i}" for i in range(WORDS)]


def blocks_for(keys: int) -> int:
    """Blocks of a filter for so many keys; a power of two."""
    needed = -(-max(1, keys) * BITS_PER_KEY // BLOCK_BITS)
    return 1 << (needed - 1).bit_length()


def _block(key: Column, blocks: Column) -> Column:
    return F.xxhash64(key).bitwiseAND(blocks - 1)


def _bits(key: Column) -> list[Column]:
    """Positions of a key's bits within its block."""
    other = F.xxhash64(key, F.lit(1))
    return [F.shiftrightunsigned(other, 9 * i).bitwiseAND(BLOCK_BITS - 1).cast("int") for i in range(BITS)]


def _masks(key: Column) -> list[Column]:
    """The key's bits in every word of its block."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")

    def word(w: int) -> Column:
        return reduce(
            lambda a, b: a.bitwiseOR(b),
            [
                F.when(F.shiftright(p, 6) == w, F.call_function("shiftleft", one, p.bitwiseAND(63))).otherwise(zero)
                for p in _bits(key)
            ],
        )

    return [word(w) for w in range(WORDS)]


def build_filters(keys: DataFrame, key: str, groups: list[str], blocks: str) -> DataFrame:
    """``groups, block, w0 .. w7`` of the keys of every group; ``blocks`` names the column with its size."""
    placed = keys.select(
        *groups, _block(F.col(key), F.col(blocks)).alias("block"), *[m.alias(w) for m, w in zip(_masks(F.col(key)), _WORDS)]
    )
    return placed.groupBy(*groups, "block").agg(*[F.bit_or(w).alias(w) for w in _WORDS])


def may_hold(keys: DataFrame, key: str, filters: DataFrame, group: str, blocks: str) -> DataFrame:
    """The rows of ``keys`` (one per key and ``group`` in question) whose filter has all the key's bits.

    A key that is in its group always stays.
    """
    asked = keys.withColumn("_block", _block(F.col(key), F.col(blocks)))
    stored = filters.select(F.col(group).alias("_group"), F.col("block").alias("_at"), *_WORDS)
    met = asked.join(stored, (F.col(group) == F.col("_group")) & (F.col("_block") == F.col("_at")))
    held = [F.col(w).bitwiseAND(m) == m for w, m in zip(_WORDS, _masks(F.col(key)))]
    return met.where(reduce(lambda a, b: a & b, held)).select(*keys.columns)
