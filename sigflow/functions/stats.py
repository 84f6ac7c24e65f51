"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of one bitmap of Spark's bitmap functions.
BITMAP_BITS = 32768


def slot_bitmap(slot: Column) -> Column:
    """Aggregate: the slots (0 ... 32767, null ignored) of a group as a bitmap of 4 KB."""
    return F.bitmap_construct_agg(F.bitmap_bit_position(slot + 1))
