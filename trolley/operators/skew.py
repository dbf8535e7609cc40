"""Joins and ordered windows that stay balanced when one key holds a large share of the rows.

The operators split their input by the keys that have more than ``min_rows`` rows, and never more than MOST_HOT_KEYS
keys are hot, whatever the data looks like. That is what makes broadcasting them, or the dimension rows that belong to
them, safe: 40 MB if such a row takes 2 kB. Every other key is small against a shuffle partition, so the ordinary
shuffle plan is balanced for it. No row is dropped on either side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.workspace import Workspace

HOT_KEY_ROWS = 1_000_000
MOST_HOT_KEYS = 20_000


def slots_for(rows: int, min_rows: int) -> int:
    """So many slots that one holds an eighth of ``min_rows`` ordinary rows: at most 160,000 for ``find_hot_keys``."""
    return max(1024, 8 * rows // max(1, min_rows))


def find_hot_keys(df: DataFrame, key: str, ws: Workspace, min_rows: int = HOT_KEY_ROWS) -> DataFrame | None:
    """Keys with more than ``min_rows`` rows, or None when there are none (the usual case).

    The limit rises with the table, so that there are never more than MOST_HOT_KEYS hot keys: from 2 * 10^10 rows on, a
    key is hot with more than its 20,000th of the rows. Reads one column. Keys are counted by slots of their hash first: a
    task sends a number for each slot, not one for each key, and only keys of a slot with more than ``min_rows`` rows,
    if there is one, are counted themselves. A table of at most ``min_rows`` rows cannot hold one; its row count comes
    from file metadata.
    """
    rows = df.count()
    min_rows = max(min_rows, rows // MOST_HOT_KEYS)
    if rows <= min_rows:
        return None
    n = F.count(F.lit(1)).alias("_n")
    keys = df.select(key).where(F.col(key).isNotNull())
    slot = F.pmod(F.xxhash64(key), F.lit(slots_for(rows, min_rows))).cast("int").alias("_slot")
    full = ws.materialise(keys.groupBy(slot).agg(n).where(F.col("_n") > min_rows).select("_slot"), "hot-slots")
    if full.isEmpty():  # at most rows / min_rows of them
        return None
    few = keys.withColumn("_slot", slot).join(F.broadcast(full), "_slot", "left_semi")
    counts = few.groupBy(key).agg(n)
    hot = ws.materialise(counts.where(F.col("_n") > min_rows).select(key), "hot-keys")
    return None if hot.isEmpty() else hot


def split_by_hot(df: DataFrame, key: str, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(cold, hot)`` rows of ``df``; a null key counts as cold."""
    keys = F.broadcast(hot.withColumnRenamed(hot.columns[0], key))
    return df.join(keys, key, "left_anti"), df.join(keys, key, "left_semi")


def rows_of_hot_keys(dim: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """The dimension rows hot keys need, for broadcast: as many as there are hot keys, since ``key`` is unique."""
    return F.broadcast(split_by_hot(dim, key, hot)[1])


def join_dimension(big: DataFrame, dim: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Inner join to a dimension with at most one row per key.

    Cold keys take the plan Spark picks. Rows of hot keys stay where they are and meet a broadcast of only the
    dimension rows those keys need.
    """
    if hot is None:
        return big.join(dim, key)
    cold_rows, hot_rows = split_by_hot(big, key, hot)
    return cold_rows.join(dim, key).unionByName(hot_rows.join(rows_of_hot_keys(dim, key, hot), key))


@dataclass(frozen=True)
class Numbering:
    """What to add per row, within its key in the given order: its position and, where named, two more columns."""

    key: str
    order_by: list[str]
    position: str
    total: str | None = None
    previous: str | None = None
    previous_of: str | None = None


def number_rows(df: DataFrame, how: Numbering, hot: DataFrame | None, ws: Workspace) -> DataFrame:
    """``number_cold`` for ordinary keys, ``number_hot`` for the others."""
    if hot is None:
        return number_cold(df, how)
    cold_rows, hot_rows = split_by_hot(df, how.key, hot)
    return number_cold(cold_rows, how).unionByName(number_hot(hot_rows, how, ws))


def number_cold(df: DataFrame, how: Numbering) -> DataFrame:
    """Plain windows: one shuffle by key, for keys that fit in a task."""
    ordered = Window.partitionBy(how.key).orderBy(*how.order_by)
    added: dict[str, Column] = {how.position: F.row_number().over(ordered).cast("bigint")}
    if how.total:
        added[how.total] = F.count(F.lit(1)).over(Window.partitionBy(how.key))
    if how.previous:
        added[how.previous] = F.lag(how.previous_of).over(ordered)
    return df.withColumns(added)


def number_hot(df: DataFrame, how: Numbering, ws: Workspace) -> DataFrame:
    """The same numbers for keys too large for one task.

    Rows are range-partitioned on the ordering, so one key spreads over many tasks. Each task numbers its own slice,
    and slices are shifted by the row counts of earlier slices: one small row per (key, task).

    ``df`` should be a scan without shuffles: then a lost task that runs again assigns the same tie-breaking ids.
    """
    # The last sort column separates rows that agree on the whole ordering, so copies of one row spread as well.
    sliced = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(how.key, *how.order_by, "_tie")
        .withColumn("_slice", F.spark_partition_id())
    )
    # Slice numbers must be the same for the counts and for the rows, so they are written once and read twice.
    sliced = ws.materialise(sliced, "slices")

    last = F.max(how.previous_of) if how.previous else F.lit(None)
    slices = sliced.groupBy(how.key, "_slice").agg(F.count(F.lit(1)).alias("_n"), last.alias("_last"))
    by_slice = Window.partitionBy(how.key).orderBy("_slice")
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    shifts = slices.select(
        how.key,
        "_slice",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.lag("_last").over(by_slice).alias("_carried"),
        F.sum("_n").over(Window.partitionBy(how.key)).alias("_total"),
    )

    within = Window.partitionBy(how.key, "_slice").orderBy(*how.order_by, "_tie")
    numbered = sliced.withColumn("_position", F.row_number().over(within))
    if how.previous:
        numbered = numbered.withColumn("_previous", F.lag(how.previous_of).over(within))
    shifted = numbered.join(shifts, [how.key, "_slice"])
    added = {how.position: F.col("_position") + F.col("_before")}
    if how.total:
        added[how.total] = F.col("_total")
    if how.previous:
        added[how.previous] = F.when(F.col("_position") > 1, F.col("_previous")).otherwise(F.col("_carried"))
    return shifted.withColumns(added).select(*df.columns, *added)
