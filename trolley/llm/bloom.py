"""Bloom filters of bounded size, gathered by Spark and looked up in tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 28  # 32 MB
BITS_PER_ITEM = 16
SLOT_BITS = 1 << 15
PROBES = 3


class Bloom:
    """A bit array in which every added hash has its bits set."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 8 - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for shift in probe_shifts(len(self.bits) * 8):
            at = (hashes >> np.uint64(shift)) & self.mask
            found &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def probe_shifts(bits: int) -> list[int]:
    """The hash's bits are used from the top in PROBES windows, which overlap where 64 bits are too few."""
    room = 64 - (bits.bit_length() - 1)
    return [room * k // (PROBES - 1) for k in range(PROBES)]


def bloom_of(items: DataFrame, hashed: Column) -> Bloom:
    """A filter over a 64-bit hash of the items. Set bits are gathered into bitmaps by Spark, and only those reach the
    driver: at most MOST_BITS bits however many items there are. A filter too full lets more through, never less."""
    wanted = max(items.count() * BITS_PER_ITEM, SLOT_BITS)
    bits = min(MOST_BITS, 1 << (wanted - 1).bit_length())
    places = F.array(*[F.shiftrightunsigned(hashed, s).bitwiseAND(F.lit(bits - 1)) for s in probe_shifts(bits)])
    at = items.select(F.explode(places).alias("at"))
    # bitmap_construct_agg takes positions below 32,768, the bits of one slot.
    slots = at.groupBy(F.shiftright("at", 15).alias("slot")).agg(
        F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit(SLOT_BITS - 1))).alias("bitmap")
    )
    whole = np.zeros(bits // 8, np.uint8)
    for slot, bitmap in slots.collect():  # at most MOST_BITS bits
        whole[slot * (SLOT_BITS // 8) :][: SLOT_BITS // 8] = np.frombuffer(bitmap, np.uint8)
    return Bloom(whole)
