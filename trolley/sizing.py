"""Shuffle sizing from the size of the input."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps
from math import ceil

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARTITION_BYTES = 256 * 1024 * 1024
# Beyond this many, partitions grow to MOST_BYTES first: the bookkeeping of map tasks x partitions costs more than a
# partition that spills. They never grow beyond it.
MANY_PARTITIONS = 50_000
MOST_BYTES = 1024 * 1024 * 1024
# Compressed columnar input against rows in a shuffle.
EXPANSION = 4
# An order item as sorts and joins hold it, with its texts, and what a task that sorts such rows is given of them.
ROW_BYTES = 256
SORTED_BYTES = 64 * 1024 * 1024
BUCKETED_SCANS = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files below ``paths``; lists them, reads none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def partitions_for(size: int) -> int:
    expanded = size * EXPANSION
    return max(1, min(ceil(expanded / PARTITION_BYTES), max(MANY_PARTITIONS, ceil(expanded / MOST_BYTES))))


def buckets_for(rows: int) -> int:
    """Buckets of a table of so many order items. File sizes would tell little: a row takes 15 bytes in Parquet."""
    decoded = rows * ROW_BYTES
    return max(1, min(ceil(decoded / SORTED_BYTES), max(MANY_PARTITIONS, ceil(decoded / MOST_BYTES))))


def scan_by_bucket(spark: SparkSession) -> None:
    """Read bucketed tables a bucket a task even where no step needs it, unless the session says otherwise: a bucket fits
    a task, the files that a split packs hold rows for many."""
    if spark.conf.get(BUCKETED_SCANS, None) is None:
        spark.conf.set(BUCKETED_SCANS, False)


def size_shuffles(spark: SparkSession, size: int) -> int:
    """Make sure this session's shuffles of ``size`` input bytes start with partitions that fit a task.

    Only raises the number, never lowers what the session was configured with; adaptive execution merges what turns
    out small; returns the number in effect. At 100 TB of input the default of 200 would leave terabytes to one task.
    """
    current = int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get(SHUFFLE_PARTITIONS))
    wanted = partitions_for(size)
    if wanted > current:
        spark.conf.set(INITIAL_PARTITIONS, wanted)
    return max(wanted, current)


@contextmanager
def shuffle_partitions(spark: SparkSession, n: int) -> Iterator[None]:
    """Run with exactly ``n`` partitions per shuffle, then restore the session's settings."""
    before = {name: spark.conf.get(name, None) for name in (SHUFFLE_PARTITIONS, INITIAL_PARTITIONS)}
    try:
        for name in before:
            spark.conf.set(name, n)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What runs within leaves no shuffle files: they go when its query ends. Otherwise they stay until the driver
    happens to collect garbage, and every step of a job adds its own."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    try:
        spark.conf.set(FREE_SHUFFLES, True)
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def frees_shuffles(step: Callable) -> Callable:
    """A step (session first) that runs under ``shuffles_freed``."""

    @wraps(step)
    def run(spark: SparkSession, *args, **kwargs):
        with shuffles_freed(spark):
            return step(spark, *args, **kwargs)

    return run
