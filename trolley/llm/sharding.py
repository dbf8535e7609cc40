"""Sharding by histogram sort.

Rows are ordered by a key of 32 hex digits: the first half of the text's md5, so that equal texts lie together, then
that of the id's. Splitters are found by counting, not by sorting: a round counts the exact bytes and rows below
every candidate boundary (the next digits of the key), takes the nearest candidate for each splitter, and goes deeper
only where none is within the tolerance. Then all rows are exchanged once, by range.

Each shard is cut into ``parts`` ranges of bounded size, so a shard's positions are numbered range by range; the
histogram already knows how many rows lie below each. A group of copies is split only when leaving it whole would put a
splitter out of tolerance.
"""

from __future__ import annotations

import json
from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import materialise

KEY_DIGITS = 32
FIRST_DIGITS = 3
MAX_PROBES = 262_144
RANGE_BYTES = 1 << 30  # one task's share of a shard
RANGE_TOLERANCE = 0.25
LAST = "g"  # above every hex digit


def row_bytes() -> Column:
    """UTF-8 bytes of the text (null: none) plus 16 for the rest of the row."""
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("bigint")


def sort_key() -> Column:
    def digest(value: Column) -> Column:
        return F.substring(F.md5(F.coalesce(value.cast("string"), F.lit("")).cast("binary")), 1, KEY_DIGITS // 2)

    return F.concat(digest(F.col("text")), digest(F.col("doc_id")))


class _Open:
    """A bucket of the key space whose inside may hold splitters, with what lies below it."""

    def __init__(self, prefix: str, end: str, size: int, rows: int, targets: list[int]):
        self.prefix, self.end, self.size, self.rows, self.targets = prefix, end, size, rows, targets


def find_splitters(keyed: DataFrame, total: int, shards: int, parts: int, tolerance: float) -> list[tuple[str, int]]:
    """The boundaries that cut ``(_key, _size)``, ``total`` bytes, into ``shards`` times ``parts`` pieces of near equal
    bytes, each with the number of rows below it.

    ``tolerance`` is the accepted miss of a boundary between shards, as a part of a shard; within shards
    RANGE_TOLERANCE of a piece will do. Where rows are too long for it, the nearest boundary between two keys is taken.
    The driver holds the counts of a round: a few for each piece, at least MAX_PROBES.
    """
    pieces = shards * parts
    found: dict[int, tuple[str, int]] = {}
    opened = [_Open("", LAST, 0, 0, list(range(1, pieces)))] if total else []
    depth = 0
    while opened:
        step = FIRST_DIGITS if not depth else max(1, int(log(MAX_PROBES / len(opened), 16)))
        deeper = min(KEY_DIGITS, depth + step)
        inside = F.substring("_key", 1, depth).isin([o.prefix for o in opened]) if depth else F.lit(True)
        counted = (
            keyed.where(inside)
            .groupBy(F.substring("_key", 1, deeper).alias("prefix"))
            .agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("rows"))
            .collect()
        )
        children: dict[str, list] = {}
        for row in sorted(counted, key=lambda r: r["prefix"]):
            children.setdefault(row["prefix"][:depth], []).append(row)
        following = []
        for bucket in opened:
            edges = [(bucket.size, bucket.rows, "")]
            own = children[bucket.prefix]
            for row in own:
                edges.append((edges[-1][0] + row["size"], edges[-1][1] + row["rows"], ""))
            names = [row["prefix"] for row in own] + [bucket.end]
            edges = [(size, rows, name) for (size, rows, _), name in zip(edges, names, strict=True)]
            k, again = 0, {}
            for i in bucket.targets:
                target = i * total / pieces
                while edges[k + 1][0] < target:
                    k += 1
                size, rows, name = min(edges[k], edges[k + 1], key=lambda e: (abs(e[0] - target), e[0]))
                accepted = tolerance * total / shards if i % parts == 0 else RANGE_TOLERANCE * total / pieces
                if abs(size - target) <= accepted or deeper == KEY_DIGITS or own[k]["rows"] == 1:
                    found[i] = (name, rows)
                else:
                    again.setdefault(k, []).append(i)
            for k, targets in again.items():
                following.append(_Open(names[k], names[k + 1], edges[k][0], edges[k][1], targets))
        opened, depth = following, deeper
    return [found[i] for i in sorted(found)]


def range_of(key: Column, cuts: list[str]) -> Column:
    """Number of cuts at or below ``key``: cuts are looked up by the key's first digits, then compared one by one."""
    base, lists, below = [], [], 0
    by_start: dict[str, list[str]] = {}
    for cut in cuts:
        by_start.setdefault(cut[:FIRST_DIGITS], []).append(cut)
    for i in range(16**FIRST_DIGITS):
        own = by_start.get(f"{i:0{FIRST_DIGITS}x}", [])
        base.append(below)
        lists.append(own)
        below += len(own)
    lookup = [{"b": b, "c": c} for b, c in zip(base, lists, strict=True)]
    looked_up = F.from_json(F.lit(json.dumps(lookup)), "array<struct<b:int,c:array<string>>>")  # folded to a literal
    entry = looked_up[F.conv(F.substring(key, 1, FIRST_DIGITS), 16, 10).cast("int")]
    return entry["b"] + F.size(F.filter(entry["c"], lambda cut: cut <= key))


def shard(documents: DataFrame, shards: int = 40, tolerance: float = 0.002) -> DataFrame:
    """All rows and columns of ``documents`` with ``size``, ``shard`` (0 to shards - 1, near equal bytes) and ``slot``
    (position within the shard in key order, gapless from 0); these replace columns of the same name.

    Null text: no bytes, sorted as an empty text. Null doc_id: sorted as an empty id. Rows alike in text and id have
    the same key, so they share a shard and have neighbouring slots in any order; every other tie is
    decided by the key. Rows too long for equal shares leave shards as near as their edges allow, possibly empty.
    Empty table: empty result.
    """
    keyed = materialise(documents.select(sort_key().alias("_key"), row_bytes().alias("_size")), "shard-keys")
    total = keyed.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0]
    parts = max(1, ceil(total / shards / RANGE_BYTES))
    cuts = find_splitters(keyed, total, shards, parts, tolerance)
    starts = [0, *(rows for _, rows in cuts)]
    first = [starts[i - i % parts] for i in range(len(starts))]
    offsets = F.from_json(F.lit(json.dumps([a - b for a, b in zip(starts, first, strict=True)])), "array<bigint>")
    ranged = documents.withColumn("_key", sort_key()).withColumn("size", row_bytes())
    ranged = ranged.withColumn("_range", range_of(F.col("_key"), [name for name, _ in cuts]))
    within = F.row_number().over(Window.partitionBy("_range").orderBy("_key"))
    return (
        ranged.withColumn("slot", (within - 1 + offsets[F.col("_range")]).cast("bigint"))
        .withColumn("shard", F.floor(F.col("_range") / parts).cast("int"))
        .drop("_key", "_range")
    )
