"""A filter over the keys that a table holds, so that new keys are known as new without reading the table.

The filter is a blocked Bloom filter made of rows: a key belongs to one block, a bitmap of
``BLOCK_BITS`` bits, and sets ``PROBES`` bits there. A key with a bit unset is not held for sure; one
with all of them set may be, and has to be looked for in the table. The filter is a frame
(``blocks``, ``block``, ``bits``), built, merged and probed by grouping and joining on the block, so it may be as large
as it needs to be: about two bytes a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.operators.dedup import first_of_each
from meterflow.operators.lookup import lookup_join

# Fixed value: the bits of one of Spark's bitmaps.
BLOCK_BITS = 32_768
# With 16 bits and four probes a key, about one new key in 400 has to be looked for.
BITS_PER_KEY, PROBES = 16, 4
# A filter with more of its bits set is to be built anew, with more blocks.
FULL = 0.5
COLUMNS = ("blocks", "block", "bits")


def blocks_for(n_keys: int) -> int:
    """Blocks for so many keys, with room to double."""
    return max(1, -(-2 * n_keys * BITS_PER_KEY // BLOCK_BITS))


def _block(keys: Sequence[str], blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), *keys), blocks)


def _places(keys: Sequence[str]) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i + 1), *keys), F.lit(BLOCK_BITS)) for i in range(PROBES)]


def key_filter(rows: DataFrame, keys: Sequence[str], blocks: int) -> DataFrame:
    """The filter of the keys of ``rows``; repeated keys are the same bits. No rows give an empty filter.

    Bitmaps are filled before the shuffle, so what moves is a bitmap per task and block at most.
    """
    width = F.lit(blocks).cast("bigint")
    bits = rows.select(_block(keys, width).alias("block"), F.explode(F.array(*_places(keys))).alias("place"))
    filled = bits.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits"))
    return filled.select(width.alias("blocks"), "block", "bits")


def merged(filters: DataFrame) -> DataFrame:
    """One row per block of several filters of the same width put together."""
    return filters.groupBy("blocks", "block").agg(F.bitmap_or_agg("bits").alias("bits")).select(*COLUMNS)


def fill_share(held: DataFrame, blocks: int) -> Column:
    """Share of the bits that are set, an aggregate over a merged filter."""
    return F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)) / (blocks * BLOCK_BITS)


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


def with_maybe_held(rows: DataFrame, held: DataFrame, keys: Sequence[str], blocks: int) -> DataFrame:
    """``rows`` with ``_maybe``: false where the key is not in the merged filter ``held`` for sure."""
    placed = rows.withColumn("_block", _block(keys, F.lit(blocks).cast("bigint")))
    bits = held.select(F.col("block").alias("_block"), F.col("bits").alias("_bits"))
    found = F.lit(True)
    for place in _places(keys):
        found &= _is_set(F.col("_bits"), place)
    joined = lookup_join(placed, bits, "_block", "left")
    return joined.select(*rows.columns, F.coalesce(found, F.lit(False)).alias("_maybe"))


def split_by_filter(new: DataFrame, key: str, held: DataFrame, blocks: int) -> tuple[DataFrame, DataFrame]:
    """One row of ``new`` per key: those whose key isn't held for sure, and those whose key may be.

    A key of NULL is never held, as in an anti-join.
    """
    probed = with_maybe_held(first_of_each(new, [key]), held, [key], blocks)
    maybe = F.col("_maybe") & F.col(key).isNotNull()
    return probed.filter(~maybe).drop("_maybe"), probed.filter(maybe).drop("_maybe")


def insert_missing_filtered(
    new: DataFrame, target: DataFrame, key: str, held: DataFrame, blocks: int
) -> tuple[DataFrame, DataFrame]:
    """Rows of ``new`` whose key ``target`` lacks, one per key, in two frames: those the filter knows, and the others.

    The first needs no row of ``target``; only the second, of keys that may be held, is joined with it.
    """
    unheld, unsure = split_by_filter(new, key, held, blocks)
    return unheld, unsure.join(target.select(key), key, "left_anti").select(*new.columns)
