"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item's windows (13 consecutive words; an item of fewer words is one window) are sets of word shingles.
A document contains a window only if it contains all its shingles, so of each window's shingles, ordered by rarity in
the corpus, a prefix of one is enough to find every document that may contain it: all but (needed - 1) of them, with
all needed. Documents' shingles meet these prefixes; a candidate must leave room for the whole window before and
after the shingle's position (positional and length bounds), and is then compared word by word.

Documents are never shuffled or multiplied: their shingles are generated and probed in one stage, against blocks of
at most BLOCK_WINDOWS windows that are broadcast in turn. A frequent passage costs one row for each occurrence.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import ascii_lower, materialise, row_key

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW_WORDS = 13
SHINGLE_WORDS = 3
BLOCK_WINDOWS = 100_000  # a window is about 150 bytes: 15 MB a block


def words(text: Column) -> Column:
    """Lower-cased (A-Z) runs of letters, digits and anything beyond ASCII; a null text has none."""
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def shingles(words_column: str, width: int) -> Column:
    """Hashes of all runs of ``width`` words, in order."""
    n = F.size(words_column)

    def at(i: Column) -> Column:
        return F.xxhash64(*(F.get(words_column, i + k) for k in range(width)))

    return F.when(n >= width, F.transform(F.sequence(F.lit(0), n - width), at)).otherwise(
        F.array().cast("array<bigint>")
    )


def item_windows(benchmark: DataFrame) -> DataFrame:
    """``window`` (words), ``window_id`` and the ``item_id`` it comes from; a window once for each item."""
    items = benchmark.select("item_id", words(F.col("text")).alias("_words")).where(F.size("_words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("_words") - WINDOW_WORDS, F.lit(0)))
    cut = items.select("item_id", "_words", F.explode(starts).alias("_at"))
    cut = cut.select("item_id", F.slice("_words", F.col("_at") + 1, WINDOW_WORDS).alias("window"))
    return cut.withColumn("window_id", F.md5(F.array_join("window", " ").cast("binary"))).distinct()


def _blocks(df: DataFrame, rows: int, key: str) -> list[DataFrame]:
    """``df`` in parts of about BLOCK_WINDOWS rows, to be broadcast one at a time."""
    n = max(1, ceil(rows / BLOCK_WINDOWS))
    if n == 1:
        return [F.broadcast(df)]
    return [F.broadcast(df.where(F.pmod(F.hash(key), F.lit(n)) == i)) for i in range(n)]


def _tokenised(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", row_key().alias("row_key"), words(F.col("text")).alias("words"))


def _generated(tokenised: DataFrame, width: int) -> DataFrame:
    # The outer form keeps Spark from filtering on the generated array's size below, where it is made word by word.
    return tokenised.withColumn("hashes", shingles("words", width)).select(
        "row_key", "words", F.posexplode_outer("hashes").alias("position", "hash")
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def window_hits(documents: DataFrame, windows: DataFrame) -> DataFrame:
    """Where windows occur: ``row_key, window_id, start, end`` (word positions, end exclusive).

    ``windows`` has distinct ``window_id, window``.
    """
    width = F.least(F.size("window"), F.lit(SHINGLE_WORDS))
    sized = materialise(windows.withColumn("width", width), "windows")
    counts = {r["width"]: r["count"] for r in sized.groupBy("width").count().collect()}  # at most SHINGLE_WORDS rows
    tokenised = _tokenised(documents)
    found = []
    for width, rows in sorted(counts.items()):
        own = sized.where(F.col("width") == width)
        own = own.withColumn("hashes", shingles("window", width))
        own = own.select("window_id", "window", F.posexplode("hashes").alias("offset", "hash"))
        own = materialise(own, "window-shingles")

        # Rarity: how often the corpus has each shingle of the benchmark. Counts combine in the scanning tasks.
        needed = own.select("hash").distinct()
        met = [
            _generated(tokenised, width).select("hash").join(block, "hash")
            for block in _blocks(needed, rows * WINDOW_WORDS, "hash")
        ]
        frequency = _union(met).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
        ranked = own.join(frequency, "hash", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        rarest = F.min_by(F.struct("hash", "offset"), F.struct("n", "hash", "offset"))
        prefix = ranked.groupBy("window_id").agg(rarest.alias("p"), F.first("window").alias("window"))
        # A window with a shingle the corpus lacks cannot occur.
        absent = ranked.groupBy("window_id").agg(F.min("n").alias("least")).where("least > 0").select("window_id")
        prefix = prefix.join(absent, "window_id").select("window_id", "window", "p.hash", "p.offset")
        prefix = materialise(prefix, "prefixes")

        start, size = F.col("position") - F.col("offset"), F.size("window")
        for block in _blocks(prefix, prefix.count(), "hash"):
            candidates = _generated(tokenised, width).join(block, "hash")
            bounded = candidates.where((start >= 0) & (start + size <= F.size("words")))
            exact = bounded.where(F.slice("words", start + 1, size) == F.col("window"))
            found.append(exact.select("row_key", "window_id", start.alias("start"), (start + size).alias("end")))
    if not found:
        columns = (F.lit("").alias("window_id"), F.lit(0).alias("start"), F.lit(0).alias("end"))
        return tokenised.select("row_key", *columns).where(F.lit(False))
    return _union(found)


def covered(spans: str) -> Column:
    """Words in the union of an array of (start, end)."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))

    def add(a: Column, s: Column) -> Column:
        new = F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["end"]))
        return F.struct((a["n"] + new).alias("n"), F.greatest(a["end"], s["end"]).alias("end"))

    return F.aggregate(F.array_sort(spans), zero, add, lambda a: a["n"])


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for every row of ``documents``: ``doc_id, row_key, n_words, n_hit, n_items, item_ids``
    (strings, sorted) and ``contaminated``: words in occurring windows make up a twentieth of all, and are
    more than none.

    Null and empty texts have no words and are never hit; a benchmark row without words has no window. Null doc_id: a
    row like any other. A benchmark row with null item_id hits words but is not listed; a repeated item_id is listed
    once. Repeated rows each get a row. A very long text is one row, whose words are in the memory of its task. Empty tables: nothing is hit. Other columns are ignored.
    """
    windows = materialise(item_windows(benchmark), "item-windows")
    hits = window_hits(documents, windows.select("window_id", "window").dropDuplicates(["window_id"]))
    # Both sets combine in the scanning tasks; they are bounded by the document's length and the benchmark.
    by_document = hits.groupBy("row_key").agg(
        F.collect_set(F.struct("start", "end")).alias("spans"), F.collect_set("window_id").alias("window_ids")
    )
    by_document = materialise(by_document, "hit-documents")
    items = by_document.select("row_key", F.explode("window_ids").alias("window_id"))
    items = items.join(windows.select("window_id", F.col("item_id").cast("string").alias("item_id")), "window_id")
    items = items.groupBy("row_key").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))

    base = _tokenised(documents).select("doc_id", "row_key", F.size("words").cast("bigint").alias("n_words"))
    base = base.join(by_document.select("row_key", covered("spans").alias("n_hit")), "row_key", "left")
    base = base.join(items, "row_key", "left")
    hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return base.select(
        "doc_id",
        "row_key",
        "n_words",
        hit.alias("n_hit"),
        F.size(ids).cast("bigint").alias("n_items"),
        ids.alias("item_ids"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are not contaminated, with all their columns."""
    found = contamination(documents, benchmark).where("contaminated").select(F.col("row_key").alias("_row_key"))
    keyed = documents.withColumn("_row_key", row_key())
    return keyed.join(found.distinct(), "_row_key", "left_anti").select(*documents.columns)
