"""SimHash near-dedup by a binary trie self-join.

Fingerprints are 64-bit; copies of one fingerprint are one trie entry. The trie is cut below its top bits into
subtries, a subtrie of too many entries into several of a bounded size. A pair of subtries is one row of Spark's
work: it starts with the bits in which their tops differ, walks both subtries together, adds up differing bits and
drops a pair of nodes as soon as they exceed the error budget. The pairs of subtries whose tops differ by more
are never made.

A dense group of near copies has a number of links that grows with the square of its size. A pair of subtries
therefore returns only what its links connect: each entry with the smallest entry it is connected to.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from trolley.llm.common import materialise, row_key
from trolley.llm.components import star_forest

BITS = 64
SHINGLE_WORDS = 4
HASH_SEED = 42
SLICE = 65_536  # shingles whose bits are counted at once
MOST_ENTRIES = 65_536  # of a subtrie; twice that many 8-byte entries go into one row
FRONTIER = 500_000  # node pairs held at once while walking


def fingerprint(text: str | None) -> int:
    """Bits set in over half of the shingles' hashes, as a signed 64-bit integer; no words: zero."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    width = min(SHINGLE_WORDS, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    count, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for k in range(0, len(first), SLICE):
        spans = zip(first[k : k + SLICE], last[k : k + SLICE], strict=True)
        hashes = np.fromiter((digest(joined[i:j], HASH_SEED) for i, j in spans), np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int32)
    packed = np.packbits(2 * count > len(first), bitorder="little")
    return int(packed.view("<i8")[0])


@F.pandas_udf(LongType())
def fingerprint_udf(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def hex_digits(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


class Levels:
    """A binary trie over sorted distinct entries, level by level from ``depth``: where each node starts, its number
    of entries and its two children (-1: none)."""

    def __init__(self, entries: np.ndarray, depth: int):
        n = len(entries)
        self.size, self.left, self.right, self.start = [], [], [], []
        nodes = np.zeros(1, np.int64)
        for level in range(depth, BITS + 1):
            self.start.append(nodes)
            self.size.append(np.diff(np.append(nodes, n)))
            if level == BITS or (self.size[-1] == 1).all():
                break  # pairs of single entries are settled without walking on
            prefix = entries >> np.uint64(BITS - 1 - level)
            begins = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]]))
            parent = np.searchsorted(nodes, begins, side="right") - 1
            bit = (prefix[begins] & np.uint64(1)).astype(bool)
            for children, side in ((self.left, ~bit), (self.right, bit)):
                of = np.full(len(nodes), -1, np.int32)
                of[parent[side]] = np.flatnonzero(side)
                children.append(of)
            nodes = begins


def connect(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Union the pairs (i, j) in place: ``label`` points each entry to the smallest one it is connected to."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        np.minimum.at(label, np.maximum(a[apart], b[apart]), np.minimum(a[apart], b[apart]))
        while (label[label] != label).any():
            label[:] = label[label]


def linked(a: np.ndarray, b: np.ndarray, depth: int, errors: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """What the links between two subtries connect: entries and, for each, the smallest entry it is connected to.

    ``a`` and ``b`` are the same set, or have none in common. Their tops, ``depth`` bits, differ in ``errors`` bits.
    """
    same = len(a) == len(b) and bool((a == b).all())
    entries = a if same else np.concatenate([a, b])
    entries = entries[order := np.argsort(entries, kind="stable")]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    place_a, place_b = (place, place) if same else (place[: len(a)], place[len(a) :])
    label = np.arange(len(entries))
    trie_a = Levels(a, depth)
    trie_b = trie_a if same else Levels(b, depth)
    last_a, last_b = len(trie_a.start) - 1, len(trie_b.start) - 1
    zero = np.zeros(1, np.int32)
    stack = [(0, zero, zero, np.full(1, errors, np.int8))]
    while stack:
        level, x, y, e = stack.pop()
        # A trie whose nodes are all single ends early: its nodes are then entries, in the other's deeper levels too.
        size_a, size_b = trie_a.size[min(level, last_a)][x], trie_b.size[min(level, last_b)][y]
        single = (size_a == 1) & (size_b == 1)
        if single.any():
            i = trie_a.start[min(level, last_a)][x[single]]
            j = trie_b.start[min(level, last_b)][y[single]]
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            i, j = i[near], j[near]
            if same:
                i, j = i[i != j], j[i != j]
            if len(i):
                connect(label, place_a[i], place_b[j])
            x, y, e = x[~single], y[~single], e[~single]
        if not len(x):
            continue
        xs, ys = children(trie_a, a, x, level, depth), children(trie_b, b, y, level, depth)
        twice = (x == y) if same else np.zeros(len(x), bool)  # a node with itself: its halves meet once
        grown = []
        for s in (0, 1):
            for t in (0, 1):
                worse = e + np.int8(s != t)
                keep = (xs[s] >= 0) & (ys[t] >= 0) & (worse <= budget)
                if s > t:
                    keep &= ~twice
                grown.append((xs[s][keep], ys[t][keep], worse[keep]))
        x, y, e = (np.concatenate(part) for part in zip(*grown, strict=True))
        for k in range(0, len(x), FRONTIER):
            stack.append((level + 1, x[k : k + FRONTIER], y[k : k + FRONTIER], e[k : k + FRONTIER]))
    moved = np.flatnonzero(label != np.arange(len(label)))
    return entries[moved], entries[label[moved]]


def children(trie: Levels, entries: np.ndarray, nodes: np.ndarray, level: int, depth: int) -> list[np.ndarray]:
    """The nodes' children by bit. Below the last level every node is one entry and has itself on one side."""
    if level < len(trie.left):
        return [trie.left[level][nodes], trie.right[level][nodes]]
    at = entries[trie.start[-1][nodes]]
    bit = (at >> np.uint64(BITS - 1 - depth - level)) & np.uint64(1)
    return [np.where(bit == side, nodes, -1).astype(np.int32) for side in (0, 1)]


def subtrie_pairs(prints: DataFrame, depth: int, budget: int) -> DataFrame:
    """Pairs of subtries with at most ``budget`` differing bits at the top: ``a, b`` (entries), ``errors``."""
    top = F.shiftrightunsigned("print", BITS - depth)
    counts = prints.groupBy(top.alias("top")).agg(F.count(F.lit(1)).alias("n"))
    cut = materialise(counts.select("top", F.ceil(F.col("n") / MOST_ENTRIES).cast("int").alias("pieces")), "tops")
    # Oversized tops: at most one for MOST_ENTRIES rows, 16 bytes each.
    oversized = F.broadcast(cut.where("pieces > 1"))
    piece = F.pmod(F.xxhash64("print"), F.coalesce("pieces", F.lit(1))).cast("int")
    subtries = (
        prints.withColumn("top", top)
        .join(oversized, "top", "left")
        .groupBy("top", piece.alias("piece"))
        .agg(F.collect_list("print").alias("entries"))
    )
    subtries = materialise(subtries, "subtries")

    masks = [m for m in range(1 << depth) if m.bit_count() <= budget]
    names = subtries.select("top", "piece")
    to = F.explode(F.from_json(F.lit(str(masks)), "array<bigint>"))  # a folded literal, whatever its length
    first = names.select(F.col("top").alias("t1"), F.col("piece").alias("p1"), to.alias("mask"))
    first = first.withColumn("t2", F.col("t1").bitwiseXOR(F.col("mask"))).where("t2 >= t1")
    second = names.select(F.col("top").alias("t2"), F.col("piece").alias("p2"))
    pairs = first.join(second, "t2").where("t1 < t2 or p1 <= p2").withColumn("errors", F.bit_count("mask"))
    pairs = materialise(pairs.select("t1", "p1", "t2", "p2", "errors"), "pairs")

    # A row of both sides is up to 1 MB: few rows a task, dealt out evenly.
    tasks = max(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil(pairs.count() / 16))
    ids = ["t1", "p1", "t2", "p2"]
    sides = []
    for side, name in ((1, "a"), (2, "b")):
        own = subtries.select(
            F.col("top").alias(f"t{side}"), F.col("piece").alias(f"p{side}"), F.col("entries").alias(name)
        )
        sides.append(pairs.join(own, [f"t{side}", f"p{side}"]).select(*ids, "errors", name).repartition(tasks, *ids))
    return sides[0].join(sides[1].drop("errors"), ids).select("errors", "a", "b")


def links(prints: DataFrame, budget: int = 4) -> DataFrame:
    """Links that connect exactly the fingerprints of ``prints`` (one distinct column, print) that a chain of links of
    at most ``budget`` differing bits connects: ``a, b``, at most one row for an entry and pair of subtries."""
    depth = max(5, ceil(log2(max(1, prints.count()) * 2 / MOST_ENTRIES)))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for errors, a, b in zip(batch["errors"], batch["a"], batch["b"], strict=True):
                a, b = (np.sort(np.asarray(v, np.int64).view(np.uint64)) for v in (a, b))
                entry, least = linked(a, b, depth, errors, budget)
                if len(entry):
                    yield pd.DataFrame({"a": entry.view(np.int64), "b": least.view(np.int64)})

    return subtrie_pairs(prints, depth, budget).mapInPandas(walk, "a bigint, b bigint")


def near_duplicates(documents: DataFrame, budget: int = 4) -> DataFrame:
    """``doc_id, row_key, print, component, component_id`` for every row: ``common.row_key``, the 64-bit fingerprint, the
    smallest fingerprint that a chain of links of at most ``budget`` differing bits reaches, and the smallest doc_id
    among all documents it reaches.

    Null, empty and blank texts have fingerprint 0 and link like any other. A null doc_id never is a component's id
    unless all its ids are null: then that is null. Repeated rows each get a row. Very long texts are hashed whole, 65,536
    shingles at a time. Empty table: empty result. Other
    columns are ignored. Ties need no rule: the result does not depend on the order of anything.
    """
    docs = documents.select("doc_id", row_key().alias("row_key"), fingerprint_udf(F.col("text")).alias("print"))
    docs = materialise(docs, "prints")  # texts are read once
    prints = materialise(docs.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-prints")
    stars = star_forest(links(prints.select("print"), budget))

    labelled = prints.join(stars.select(F.col("a").alias("print"), "b"), "print", "left")
    labelled = labelled.withColumn("component", F.coalesce("b", "print"))
    of_component = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    of_print = labelled.join(of_component, "component").select("print", "component", "component_id")
    # A print may have a third of all documents: adaptive execution splits that side of the join.
    return docs.join(of_print, "print").select("doc_id", "row_key", "print", "component", "component_id")


def deduplicate(documents: DataFrame, budget: int = 4) -> DataFrame:
    """One row of ``documents`` for each group of near duplicates: that of the smallest doc_id (null last), among rows
    of one id the smallest row key; of rows alike in both, any one. All columns stay."""
    groups = near_duplicates(documents, budget)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key"))  # combines in the map tasks
    kept = groups.groupBy("component").agg(first.alias("first")).select(F.col("first.row_key").alias("_row_key"))
    keyed = documents.withColumn("_row_key", row_key())
    return keyed.join(kept, "_row_key", "left_semi").dropDuplicates(["_row_key"]).select(*documents.columns)
