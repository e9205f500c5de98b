"""A bitmap of keys of one fixed size, to leave out rows before they move."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 22  # 2^22 bits, half a megabyte, whatever the number of keys
_PART = 15  # bits of a place within one of the bitmap's rows, 4 KB each


def _place(columns: Sequence[str], bits: int) -> Column:
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << bits) - 1))


def key_bitmap(keys: DataFrame, columns: Sequence[str], bits: int = BITS) -> DataFrame:
    """(__part, __bits): at most 2^(bits - 15) rows of 4 KB that say which hashes occur."""
    place = _place(columns, bits)
    return keys.groupBy(F.shiftright(place, _PART).alias("__part")).agg(
        F.bitmap_construct_agg(place.bitwiseAND(F.lit((1 << _PART) - 1))).alias("__bits"))


def may_contain(df: DataFrame, bitmap: DataFrame, columns: Sequence[str], bits: int = BITS) -> DataFrame:
    """The rows whose key is in the bitmap, and a few whose hash only is. The columns have the types
    of those that the bitmap was made of."""
    place = _place(columns, bits)
    inside = place.bitwiseAND(F.lit((1 << _PART) - 1)).cast("int")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(inside / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return (df.join(F.broadcast(bitmap), F.shiftright(place, _PART) == F.col("__part"))
            .where(F.getbit(byte.cast("long"), inside % 8) == 1).drop("__part", "__bits"))
