"""Bitmaps of bounded size that tell tasks which values are of interest."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Marks:
    """A bitmap that tells tasks which longs are of interest.  A stray bit only
    means something that is taken for one of them for nothing."""

    def __init__(self, bits: int):
        self.bits, self.map = bits, np.zeros(1 << (bits - 3), np.uint8)

    def slots(self, x: np.ndarray) -> np.ndarray:
        return (x.view(np.uint64) >> np.uint64(64 - self.bits)).astype(np.int64)

    def has(self, x: np.ndarray) -> np.ndarray:
        slot = self.slots(x)
        return (self.map[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


#: Most bits of a bitmap, 256 MB.  Where there are more values than fit, stray bits
#: grow common, and with them what is taken for nothing.
MOST_BITS = 31


def bitmap(values: DataFrame, column: str, room: int = 64):
    """Marks of the longs in a column of a kept table, for all tasks, with about
    ``room`` bits a value: as many times fewer of other values are stray."""
    bits = max(15, min(MOST_BITS, (room * values.count()).bit_length()))
    slot = F.shiftrightunsigned(F.col(column), 64 - bits) + 1  # Spark's buckets start at one
    parts = values.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    marks = Marks(bits)
    for r in parts.repartition(1 + (len(marks.map) >> 25)).toLocalIterator():  # a job for every 32 MB
        at = (r.bucket - 1) * 4096
        marks.map[at : at + 4096] = np.frombuffer(bytes(r.bits), np.uint8)
    return values.sparkSession.sparkContext.broadcast(marks)
