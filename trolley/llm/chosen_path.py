"""MinHash near-dedup by a chosen-path set similarity join.

A document's set holds its distinct word shingles; equal sets are one. In a tree, a set follows the branches that its
minwise tokens choose: two sets take the same branch where a random minwise token of both is the same, which similar
sets do with their similarity as probability. Nodes branch until they are small, and small nodes are compared
exhaustively: first by sketches of 128 minwise values, then, for what may be similar, by the full sets. Several
independent trees bring the recall to its target.

Dense groups do not fall apart by branching, and their links grow with the square of their size. So a first tree links
what is easy, with the nodes that stay large dealt into random blocks; from then on a node all of whose sets are
connected is done, and only links between what is not connected yet are looked for. A node that no branching makes small
is compared in pairs of blocks, so that nothing is dropped. What is returned for a group is what connects it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import floor, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.llm.bloom import Bloom, bloom_of
from trolley.llm.common import materialise, row_key
from trolley.llm.components import star_forest
from trolley.llm.simhash import connect

SKETCH = 128  # minwise values whose low 16 bits estimate a similarity
TOKENS = 32  # of them, in full, choose branches
SLICE = 1 << 16  # shingles whose minwise values are made at once
KNOWN_WORDS = 400_000
PAIRS = 1 << 14  # sketches compared at once


@dataclass(frozen=True)
class Plan:
    """How trees are grown. A root branch reads ``root_tokens``; a step reads so many tokens and makes so many branches
    of a set: about 1 / 0.85 to the power of the tokens, so that a pair at the threshold keeps about one common node.

    A pair at the threshold shares a root branch of one tree with probability 0.72, and of none of the nine later trees
    with 0.00001.
    """

    words: int = 3
    percent: int = 85
    trees: int = 10
    root_tokens: int = 2
    leaf: int = 4096  # sets of a node that is compared exhaustively
    leaf_shingles: int = 2_000_000
    steps: tuple[tuple[int, int], ...] = ((2, 1), (2, 2), (4, 2), (8, 3))
    seed: int = 42

    @property
    def least_equal(self) -> int:
        """Equal sketch values below which a pair is not looked at: one at the threshold has fewer in about one of
        70,000 cases (4.2 standard deviations)."""
        p = self.percent / 100
        return floor(SKETCH * p - 4.2 * sqrt(SKETCH * p * (1 - p)))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: bytes, known: WordHashes, width: int) -> np.ndarray:
    """The distinct shingles' 64-bit hashes, sorted. Fewer words than a shingle has: the whole sequence; none: none."""
    words = text.lower().split()
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), len(words))] if words else [], np.uint64)
    hashed = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    last = len(words) - width + 1
    mixed = hashed[:last].copy()
    for k in range(1, width):
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed += hashed[k : last + k]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def minwise(sets: list[np.ndarray], seed: int) -> np.ndarray:
    """SKETCH minwise values of each set; none may be empty."""
    odd, add = np.random.default_rng(seed).integers(0, 1 << 63, (2, SKETCH), np.uint64)
    odd = odd * np.uint64(2) + np.uint64(1)
    out = np.empty((len(sets), SKETCH), np.uint64)
    ends = np.cumsum([len(s) for s in sets])
    at = 0
    while at < len(sets):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + SLICE, side="right")))
        values = np.concatenate(sets[at:stop])
        starts = np.concatenate([[0], ends[at : stop - 1] - before])
        for k in range(SKETCH):
            out[at:stop, k] = np.minimum.reduceat(values * odd[k] + add[k], starts)
        at = stop
    return out


def signatures(documents: DataFrame, plan: Plan) -> DataFrame:
    """``doc_id, row_key, n, set_key, sketch, tokens`` of every document: the last three null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            sets = [shingle_set(t.as_py() or b"", known, plan.words) for t in batch.column("text")]
            sizes = np.array([len(s) for s in sets], np.int64)
            values = minwise([s for s in sets if len(s)], plan.seed)
            full = np.zeros((len(sets), SKETCH), np.uint64)
            full[sizes > 0] = values
            tokens = pa.array(full[:, :TOKENS].ravel().view(np.int64))
            offsets = pa.array(np.arange(0, len(sets) * TOKENS + 1, TOKENS), pa.int32())
            low = (full & np.uint64(0xFFFF)).astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row_key"),
                    pa.array(sizes),
                    pa.array([xxhash.xxh3_128_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([row.tobytes() if n else None for row, n in zip(low, sizes, strict=True)], pa.binary()),
                    pa.ListArray.from_arrays(offsets, tokens),
                ],
                names=["doc_id", "row_key", "n", "set_key", "sketch", "tokens"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    bare = documents.select("doc_id", row_key().alias("row_key"), F.col("text").cast("binary").alias("text"))
    columns = "row_key string, n bigint, set_key binary, sketch binary, tokens array<bigint>"
    return materialise(bare.mapInArrow(run, f"doc_id {kind}, {columns}"), "signatures")


def distinct_sets(signed: DataFrame) -> DataFrame:
    """``rep, set_key, least, row_key, n, sketch, tokens``: every set once, numbered, with its smallest doc_id and one
    row that has it."""
    grouped = signed.where("n > 0").groupBy("set_key")
    any_of = [F.first(c).alias(c) for c in ("row_key", "n", "sketch", "tokens")]  # alike in all, but for the row key
    sets = grouped.agg(F.min("doc_id").alias("least"), *any_of)
    return materialise(sets.withColumn("rep", F.monotonically_increasing_id()), "sets")


def shared_nodes(frontier: DataFrame) -> DataFrame:
    """Rows ``node, rep, color, n`` of nodes that hold sets of several colors, with the node's ``size`` and ``weight``."""
    sizes = frontier.groupBy("node").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"), F.min("color").alias("c0"), F.max("color").alias("c1")
    )
    sizes = materialise(sizes.where("c0 < c1").select("node", "size", "weight"), "nodes")
    return materialise(frontier.join(sizes, "node"), "frontier")


def roots(sets: DataFrame, trees: range, tokens: int) -> DataFrame:
    """The first branch of every set in every tree."""
    at = [
        F.xxhash64(F.lit(t), *[F.get("tokens", F.lit((t * tokens + k) % TOKENS)) for k in range(tokens)]) for t in trees
    ]
    return sets.select(F.explode(F.array(*at)).alias("node"), "rep", "color", "n")


def children(rows: DataFrame, sets: DataFrame, tokens: int, branches: int) -> DataFrame:
    """The rows' next branches: which tokens are read is drawn for the node, what they are for the set."""

    def branch(b: int) -> Column:
        drawn = [F.pmod(F.xxhash64("node", F.lit(b), F.lit(k)), F.lit(TOKENS)).cast("int") for k in range(tokens)]
        return F.xxhash64("node", F.lit(b), *[F.get("tokens", i) for i in drawn])

    joined = rows.drop("size", "weight").join(sets.select("rep", "tokens"), "rep")
    grown = joined.withColumn("node", F.explode(F.array(*[branch(b) for b in range(branches)])))
    return grown.select("node", "rep", "color", "n")


def pieces(plan: Plan) -> Column:
    """Into how many blocks of about half a leaf a node's sets go."""
    half = F.greatest(F.col("size") * 2 / plan.leaf, F.col("weight") * 2 / plan.leaf_shingles)
    return F.ceil(half)


def random_blocks(rows: DataFrame, plan: Plan) -> DataFrame:
    """Two random divisions of each node: neighbours in one connect the blocks of the other."""
    blocks = [F.xxhash64("node", F.lit(d), F.pmod(F.xxhash64("rep", F.lit(d)), pieces(plan))) for d in (0, 1)]
    return rows.withColumn("node", F.explode(F.array(*blocks))).select("node", "rep", "color", "n")


def block_pairs(rows: DataFrame, plan: Plan) -> DataFrame:
    """Every pair of blocks of a node, but for those of a single color. A color of many sets has blocks of its own."""
    of_color = rows.groupBy("node", "color").agg(F.count(F.lit(1)).alias("_c"), F.sum("n").alias("_w"))
    own = F.ceil(F.greatest(F.col("_c") * 2 / plan.leaf, F.col("_w") * 2 / plan.leaf_shingles))
    spread = F.xxhash64("color", F.pmod(F.xxhash64("rep"), own))
    together = F.xxhash64(F.pmod(F.xxhash64("color"), pieces(plan)))
    rows = rows.join(of_color, ["node", "color"])
    rows = materialise(rows.withColumn("piece", F.when(own > 1, spread).otherwise(together)), "pieces")
    found = rows.groupBy("node", "piece").agg(F.min("color").alias("c0"), F.max("color").alias("c1"))
    p = found.select("node", *[F.col(c).alias(f"p_{c}") for c in ("piece", "c0", "c1")])
    q = found.select("node", *[F.col(c).alias(f"q_{c}") for c in ("piece", "c0", "c1")])
    pairs = p.join(q, "node").where("p_piece <= q_piece and least(p_c0, q_c0) < greatest(p_c1, q_c1)")
    pairs = pairs.select("node", F.array_distinct(F.array("p_piece", "q_piece")).alias("both"))
    members = pairs.select("node", F.xxhash64("node", "both").alias("_pair"), F.explode("both").alias("piece"))
    members = materialise(members, "block-pairs")
    return rows.join(members, ["node", "piece"]).select(F.col("_pair").alias("node"), "rep", "color", "n")


def leaves(sets: DataFrame, trees: range, plan: Plan, first: bool) -> tuple[DataFrame, bool]:
    """``node, rep, color, n`` of all nodes to be compared exhaustively, and whether any had to be cut into blocks.

    The ``first`` tree deals nodes that are too large into random blocks at once; later ones branch on.
    """
    small = (F.col("size") <= plan.leaf) & (F.col("weight") <= plan.leaf_shingles)
    found, frontier = [], roots(sets, trees, plan.root_tokens)
    for step in (*(() if first else plan.steps), None):
        rows = shared_nodes(frontier)
        found.append(rows.where(small).select("node", "rep", "color", "n"))
        rows = rows.where(~small)
        if rows.isEmpty():
            return reduce(DataFrame.unionByName, found), False
        if step is not None:
            frontier = children(rows, sets, *step)
    found.append((random_blocks if first else block_pairs)(rows, plan))
    return reduce(DataFrame.unionByName, found), True


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The batches, regrouped so that rows of one key, which follow each other, are never apart."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        keys = table.column(key).to_numpy()
        last = int(np.flatnonzero(keys == keys[-1])[0])
        if last:
            yield table.slice(0, last)
        held = table.slice(last)
    if held is not None:
        yield held


def candidate_pairs(
    node: np.ndarray, n: np.ndarray, color: np.ndarray, sketch: np.ndarray, plan: Plan
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one node, of different colors, that may be similar. Rows are sorted by node and n."""
    ends = np.append(np.flatnonzero(node[1:] != node[:-1]) + 1, len(node))
    end = ends[np.searchsorted(ends, np.arange(len(node)), side="right")]
    active, d, found = np.arange(len(node)), 1, []
    while len(active):
        active = active[active + d < end[active]]
        active = active[n[active + d] * plan.percent <= n[active] * 100]  # sizes only grow from here
        i = active[color[active] != color[active + d]]
        for k in range(0, len(i), PAIRS):
            part = i[k : k + PAIRS]
            equal = (sketch[part] == sketch[part + d]).sum(axis=1)
            found.append(np.stack([part, part + d])[:, equal >= plan.least_equal])
        d += 1
    both = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return both[0], both[1]


def clusters(nodes: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """``cluster, rep, color, n``: within each node, what pairs that may be similar connect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "node"):
            node, rep, color, n = (table.column(c).to_numpy() for c in ("node", "rep", "color", "n"))
            packed = b"".join(table.column("sketch").to_pylist())
            sketch = np.frombuffer(packed, "<u2").reshape(-1, SKETCH)
            i, j = candidate_pairs(node, n, color, sketch, plan)
            label = np.arange(len(node))
            connect(label, i, j)
            met = np.unique(np.concatenate([i, j]))
            columns = [node[met], rep[label[met]], rep[met], color[met], n[met]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "top", "rep", "color", "n"])

    rows = nodes.join(sets.select("rep", "sketch"), "rep").repartition("node").sortWithinPartitions("node", "n")
    found = rows.mapInArrow(run, "node bigint, top bigint, rep bigint, color bigint, n bigint")
    found = found.select(F.xxhash64("node", "top").alias("cluster"), "rep", "color", "n")
    return materialise(found, "clusters")


def full_sets(documents: DataFrame, wanted: DataFrame, plan: Plan) -> DataFrame:
    """``rep, shingles`` (packed hashes) of the sets ``wanted`` (rep, row_key), from one pass over the texts. A Bloom
    filter of the wanted rows keeps other texts' shingles from being made and shuffled."""
    shared = documents.sparkSession.sparkContext.broadcast(bloom_of(wanted, F.xxhash64("row_key")).bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bloom = WordHashes(), Bloom(shared.value)
        for batch in batches:
            hits = np.flatnonzero(bloom.has(batch.column("hash").to_numpy().view(np.uint64)))
            batch = batch.take(pa.array(hits))
            sets = [shingle_set(t.as_py() or b"", known, plan.words).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key"), pa.array(sets, pa.binary())], names=["row_key", "shingles"]
            )

    keyed = documents.select(row_key().alias("row_key"), F.col("text").cast("binary").alias("text"))
    keyed = keyed.select("row_key", F.xxhash64("row_key").alias("hash"), "text")
    made = keyed.mapInArrow(run, "row_key string, shingles binary").dropDuplicates(["row_key"])
    out = materialise(wanted.join(made, "row_key").select("rep", "shingles"), "full-sets")
    shared.unpersist()
    return out


def connected(sets: list[np.ndarray], color: np.ndarray, percent: int) -> np.ndarray:
    """For each set, the first one that links and colors connect it to. Sets come sorted by size."""
    label = np.unique(color, return_index=True)[1][np.unique(color, return_inverse=True)[1]]
    size = np.array([len(s) for s in sets], np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    number = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mark = np.zeros(int(number.max()) + 1, np.uint8)
    for i in range(len(sets) - 1):
        stop = int(np.searchsorted(size, size[i] * 100 // percent, side="right"))
        others = np.arange(i + 1, stop)
        if not len(others) or (label[others] == label[i]).all():
            continue
        mark[number[starts[i] : ends[i]]] = 1
        hits = mark[number[starts[i + 1] : ends[stop - 1]]]
        both = np.add.reduceat(hits, starts[others] - starts[i + 1], dtype=np.int64)
        mark[number[starts[i] : ends[i]]] = 0
        near = others[100 * both >= percent * (size[i] + size[others] - both)]
        connect(label, np.full(len(near), i), near)
    return label


def verified(found: DataFrame, full: DataFrame, plan: Plan) -> DataFrame:
    """Links ``a, b`` that connect exactly what links of full sets, and colors, connect within a cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cluster"):
            key, rep, color = (table.column(c).to_numpy() for c in ("cluster", "rep", "color"))
            cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
            shingles = table.column("shingles")
            a, b = [], []
            for start, end in zip(cuts, cuts[1:]):
                sets = [np.frombuffer(s.as_py(), np.uint64) for s in shingles.slice(start, end - start)]
                label = connected(sets, color[start:end], plan.percent)
                moved = np.flatnonzero(label != np.arange(len(label)))
                a.append(rep[start + moved])
                b.append(rep[start + label[moved]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (a, b)], names=["a", "b"])

    rows = found.join(full, "rep").repartition("cluster").sortWithinPartitions("cluster", "n")
    return rows.select("cluster", "rep", "color", "shingles").mapInArrow(run, "a bigint, b bigint")


def similar_sets(documents: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """``(a, b)``: every set with a similar one, but for the first of its component, with that first one."""

    def phase(colored: DataFrame, nodes: DataFrame, known: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        found = clusters(nodes, colored, plan)
        wanted = found.select("rep").distinct()
        if known is not None:
            wanted = wanted.join(known.select("rep"), "rep", "left_anti")
        full = full_sets(documents, materialise(wanted.join(sets.select("rep", "row_key"), "rep"), "wanted"), plan)
        full = full if known is None else known.unionByName(full)
        return materialise(verified(found, full, plan), "links"), full

    own = sets.withColumn("color", F.col("rep"))
    nodes, blocks = leaves(own, range(1), plan, True)
    links, full = phase(own, nodes, None)
    # Sets of one color must be connected; that all connected ones have one color matters only where blocks were cut.
    roots_of = star_forest(links) if blocks else links
    colors = roots_of.groupBy(F.col("a").alias("rep")).agg(F.min("b").alias("color"))
    colored = sets.join(colors, "rep", "left").withColumn("color", F.coalesce("color", "rep"))
    colored = materialise(colored.drop("row_key", "set_key", "least"), "colored")
    nodes, _ = leaves(colored, range(1, plan.trees), plan, False)
    more, _ = phase(colored, nodes, full)
    return star_forest(links.unionByName(more))


def near_duplicates(documents: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row: the size of the set, the smallest doc_id that a chain of
    links of at least ``percent`` per cent similarity reaches, and whether that is the row's own.

    Null, empty and blank texts have an empty set and link with nothing. A null doc_id is never a component's id unless
    all its ids are null: then that is null, and kept is true. Repeated rows each get a row and share a set. Very long
    texts are sets like others; a node of such sets ends its branching earlier. Empty table: empty result. Other columns
    are ignored, whatever their names. Ties need no rule. Shingles are compared by 64-bit hashes.
    """
    signed = signatures(documents, plan)
    sets = distinct_sets(signed)
    stars = similar_sets(documents, sets, plan).select(F.col("a").alias("rep"), "b")
    labelled = sets.join(stars, "rep", "left").select(
        "set_key", "least", F.coalesce("b", "rep").alias("component")
    )
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    of_set = labelled.join(least, "component").select("set_key", "component_id", F.lit(True).alias("_met"))
    # A set may be that of a third of all documents: adaptive execution splits that side of the join.
    rows = signed.select("doc_id", "n", "set_key").join(of_set, "set_key", "left")
    component = F.when(F.col("_met"), F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
