"""Mixing sources to target weights.

Every document gets a hash-random key, documents are ordered by it within their source, prefix sums of their word
counts are taken, and each source is cut at its exact budget. A budget beyond the source's size takes the source
once or more as a whole and the cut from the next epoch.

Hot sources: the key's first hex digits deal a source's documents over slots, about as many slots as the square root
of the row count. Slots are summed with map-side combine, a source's slots are summed up in order, and each slot
numbers its own documents, so no task holds more than a slot's rows or a source's slots.
"""

from __future__ import annotations

from math import log, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import before_each, materialise

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def random_key(seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def source_targets(sources: DataFrame, weights: tuple[int, ...], most_epochs: int) -> DataFrame:
    """Add ``target`` to a table of ``(_none, _source, source_size)``.

    Sources in code point order, null last, weigh ``weights`` in turn and share the total size by weight. A target
    stops at ``most_epochs`` times its source's size; the excess is shared again among the others until none is
    above. Each round is one aggregate over the table of sources and returns one row.
    """
    cap = F.col("source_size") * most_epochs
    order = [F.col("_none"), F.col("_source")]
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    weighed = materialise(before_each(sources, order, F.lit(1), "_rank").withColumn("_weight", turn), "sources")
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, full = 0.0, -1
    share = left = 1
    while True:
        capped = (cap <= F.col("_weight") * level) if full >= 0 else F.lit(False)
        counts = weighed.agg(
            F.count_if(capped).alias("full"),
            F.coalesce(F.sum(F.when(capped, cap)), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~capped, F.col("_weight"))), F.lit(0)).alias("open"),
        ).first()
        if counts["full"] == full or not counts["open"]:
            break
        full, share, left = counts["full"], total - counts["taken"], counts["open"]
        level = share / left
    target = F.when(capped, cap.cast("double")).otherwise(F.col("_weight") * F.lit(float(share)) / F.lit(float(left)))
    return weighed.withColumn("target", target)


def mix(documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most_epochs: int = 3, seed: int = 5) -> DataFrame:
    """All rows and columns of ``documents`` with ``size``, ``source_size``, ``target`` (of its source) and ``taken``:
    how many of its words the mix takes, repeats counted; these replace columns of the same name.

    The document on which a source's cut falls is taken up to the cut, so a source's taken words are its rounded
    target. Null source: a source of its own, last in order. Null or empty text: size 0, takes 0. Null doc_id: keyed
    like an empty id. Ties of the key are ordered by doc_id, size and a hash of the text; rows alike in all of these
    are interchangeable. Repeated rows each count. A very long text may be taken in part, up to the cut. Empty table: empty
    result.
    """
    documents = documents.drop("size", "source_size", "target", "taken")
    keyed = documents.withColumns(
        {
            "_none": F.col("source").isNull(),
            "_source": F.coalesce("source", F.lit("")),
            "size": word_count(F.col("text")),
            "_key": random_key(seed),
        }
    )
    counted = materialise(keyed.select("_none", "_source", "size", "_key"), "sizes")
    digits = max(1, round(log(sqrt(max(counted.count(), 1)), 16)))
    slot = F.substring("_key", 1, digits)

    slots = counted.groupBy("_none", "_source", slot.alias("_slot")).agg(F.sum("size").alias("_words"))
    slots = materialise(slots, "slots")
    sources = slots.groupBy("_none", "_source").agg(F.sum("_words").alias("source_size"))
    targets = source_targets(sources, weights, most_epochs)
    earlier = Window.partitionBy("_none", "_source").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slots.withColumn("_start", F.coalesce(F.sum("_words").over(earlier), F.lit(0))).drop("_words")
    starts = starts.join(targets, ["_none", "_source"]).drop("_rank", "_weight")

    by_slot = Window.partitionBy("_none", "_source", "_slot").orderBy("_key", "doc_id", "size", "_tie")
    within = F.coalesce(F.sum("size").over(by_slot.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = keyed.withColumns({"_slot": slot, "_tie": F.xxhash64("text")}).withColumn("_within", within)
    placed = placed.join(starts, ["_none", "_source", "_slot"])

    budget = F.round("target").cast("bigint")
    epochs = F.coalesce(F.try_divide(budget, F.col("source_size")).cast("bigint"), F.lit(0))
    rest = budget - epochs * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_start") - F.col("_within")))
    taken = (epochs * F.col("size") + last).cast("bigint")
    return placed.withColumn("taken", taken).select(*documents.columns, "size", "source_size", "target", "taken")
