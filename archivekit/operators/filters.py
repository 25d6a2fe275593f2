"""A set of keys as bitmaps of bounded size, probed while rows stream by."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from archivekit.params import Params

#: Bits of one bitmap, as `bitmap_construct_agg` builds them (4 kB).
BITMAP = 32_768
#: Bits for each key: one key in 32 that is not in the set seems to be.
BITS_PER_KEY = 32


def _place(columns: Sequence[str], bitmaps: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(bitmaps * BITMAP))


def key_bitmaps(keys: DataFrame, columns: Sequence[str], params: Params = Params()) -> tuple[DataFrame, int]:
    """(bitmap number, bits) of the hashes of `keys`, a stored table, and how many bitmaps there are.

    The number grows with the keys up to `params.bitmaps` (64 MB by default), so that
    every executor can hold them all. Beyond that more other keys seem to be in the set;
    none that is in it is ever missed.
    """
    wanted = -(-keys.count() * BITS_PER_KEY // BITMAP)
    bitmaps = min(params.bitmaps, 1 << max(0, wanted - 1).bit_length())
    place = _place(columns, bitmaps)
    numbered = keys.select(F.floor(place / BITMAP).cast("int").alias("_bitmap"), (place % BITMAP).alias("_bit"))
    return numbered.groupBy("_bitmap").agg(F.bitmap_construct_agg("_bit").alias("_bits")), bitmaps


def with_may_hold(rows: DataFrame, keyed: tuple[DataFrame, int], columns: Sequence[str], name: str) -> DataFrame:
    """Add `name`: false where the row's key is certainly not in the set."""
    bits, bitmaps = keyed
    place = _place(columns, bitmaps)
    placed = rows.withColumns({"_bitmap": F.floor(place / BITMAP).cast("int"), "_bit": (place % BITMAP).cast("int")})
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    hit = F.coalesce(F.getbit(byte, F.col("_bit") % 8) == 1, F.lit(False))
    return placed.join(F.broadcast(bits), "_bitmap", "left").withColumn(name, hit).drop("_bitmap", "_bit", "_bits")
