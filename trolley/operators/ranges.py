"""Which parts of a key's range some rows occupy, as a filter that file statistics can use."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICES = 128
Ranges = list[tuple[int, int]]


def occupied_ranges(
    df: DataFrame, key: str, slices: int = SLICES, bounds: tuple[int | None, int | None] | None = None
) -> Ranges:
    """At most ``slices + 1`` disjoint closed ranges of a BIGINT key that hold all of its values in ``df``.

    The whole range is cut into equal slices and each is shrunk to the values in it, so a stray value costs a range of
    its own and does not widen the others; ranges that nearly touch are one. Slices are the key's upper bits, which
    cannot overflow. ``bounds``: the smallest and largest key where the caller knows them.
    """
    low, high = bounds or df.agg(F.min(key), F.max(key)).first()
    if low is None:
        return []
    shift = max(0, (high - low).bit_length() - (slices.bit_length() - 1))
    found = (
        df.where(F.col(key).isNotNull())
        .groupBy(F.shiftright(F.col(key).cast("bigint"), shift).alias("_slice"))
        .agg(F.min(key), F.max(key))
        .collect()
    )
    return joined(sorted((row[1], row[2]) for row in found), (1 << shift) // 4)


def joined(ranges: Ranges, gap: int) -> Ranges:
    """The same ranges, those no more than ``gap`` apart as one. They come in order."""
    out: Ranges = []
    for low, high in ranges:
        if out and low - out[-1][1] <= gap:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def in_ranges(key: str, ranges: Ranges) -> Column:
    return reduce(Column.__or__, [F.col(key).between(a, b) for a, b in ranges], F.lit(False))
