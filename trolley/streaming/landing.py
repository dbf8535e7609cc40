"""Incremental ingest of a landing directory.

Each run takes the files it has not seen (available-now) and stops. Output goes to one ``batch_id=<n>`` directory
per micro-batch, overwritten when a micro-batch is replayed after a failure, so every row lands exactly once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.operators.clean import clean_orders_by_order, drop_null_keys, type_columns
from trolley.operators.ranges import in_ranges, occupied_ranges
from trolley.schema import CLEAN_SCHEMA, DEDUP_KEYS, OUTPUT_COLUMNS
from trolley.sinks.files import exists
from trolley.sinks.serving import CO_PARTITION, settings
from trolley.sizing import shuffles_freed, size_shuffles
from trolley.sources.staged import read_staged_orders

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def read_landing_stream(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Names and sizes of new Parquet and CSV files below ``path``: columns ``path, length``. Contents are read by the batch reader, so
    a stream takes whatever mix of formats and column types a batch takes.

    ``max_files`` or ``max_bytes`` bounds one micro-batch, so a large backlog is worked off in steps that each
    commit. ``archive`` moves files there once they have been consumed.
    """
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", "*.{parquet,csv}")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path).select("path", "length")


def _run(stream: DataFrame, out: str, handle: Callable[[DataFrame, int], None]) -> None:
    def each(files: DataFrame, batch_id: int) -> None:
        # Names only, at most max_files of them. An empty micro-batch has none.
        if listed := files.collect():
            size_shuffles(files.sparkSession, sum(row.length for row in listed))
            with shuffles_freed(files.sparkSession):
                handle(read_staged_orders(files.sparkSession, [row.path for row in listed]), batch_id)

    # The progress log lives inside the output it describes, so the two cannot be mixed up between runs.
    query = stream.writeStream.option("checkpointLocation", f"{out}/_progress").trigger(availableNow=True)
    query.foreachBatch(each).start().awaitTermination()


def ingest_stream(stream: DataFrame, out: str, ingested_at: Column | None = None) -> None:
    """Clean each micro-batch and append it. Repeats across micro-batches are kept, as in the batch append."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        clean_orders_by_order(batch, ingested_at)[0].write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    _run(stream, out, handle)


def dedup_stream(stream: DataFrame, out: str, ingested_at: Column | None = None) -> None:
    """Clean each micro-batch and append only keys that no earlier micro-batch delivered.

    The written table is the state: it needs no watermark, which this data has no event time for, and it grows on
    disk instead of in executors. Beside it a summary holds the order ranges of every micro-batch (see
    ``occupied_ranges``); of the earlier folders only those are opened whose ranges meet those of a new one, and in those
    only the files that may hold its orders. A new one is dealt out by order once: that shuffle serves its own copies
    and the comparison with earlier keys, so its rows are neither shuffled nor written a second time.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        target = f"{out}/batch_id={batch_id}"
        cleaned = clean_orders_by_order(batch, ingested_at)[0]
        # Which orders there are does not change by cleaning out copies: the ranges need no shuffle of the rows.
        ranges = occupied_ranges(drop_null_keys(type_columns(batch)), "order_id")
        fresh = unseen(cleaned, out, batch_id, ranges) if batch_id else cleaned
        # A join on the whole key keeps the layout by order.
        with settings(spark, {CO_PARTITION: False}):
            fresh.sortWithinPartitions(*DEDUP_KEYS).write.mode("overwrite").parquet(target)
        kept = spark.createDataFrame([(batch_id, *r) for r in ranges], SUMMARY)
        kept.coalesce(1).write.mode("overwrite").parquet(f"{out}/_ranges/batch_id={batch_id}")

    _run(stream, out, handle)


SUMMARY = "batch bigint, low bigint, high bigint"


def earlier_batches(spark: SparkSession, out: str, batch_id: int, ranges: list[tuple[int, int]]) -> list[int]:
    """Earlier micro-batches that may hold orders of the ranges."""
    if not exists(spark, f"{out}/_ranges"):
        return []
    summary = spark.read.schema(SUMMARY).option("recursiveFileLookup", True).parquet(f"{out}/_ranges")
    own = spark.createDataFrame(ranges, "from_id bigint, to_id bigint")
    # At most 129 ranges for each micro-batch and for this one.
    met = summary.where(F.col("batch") < batch_id).join(F.broadcast(own), F.expr("low <= to_id AND high >= from_id"))
    return sorted(row.batch for row in met.select("batch").distinct().collect())


def unseen(rows: DataFrame, out: str, batch_id: int, ranges: list[tuple[int, int]]) -> DataFrame:
    """Those of ``rows``, one per key, whose key no earlier micro-batch holds."""
    spark = rows.sparkSession
    folders = [f"{out}/batch_id={b}" for b in earlier_batches(spark, out, batch_id, ranges)]
    if not folders:
        return rows
    seen = spark.read.schema(CLEAN_SCHEMA).parquet(*folders).where(in_ranges("order_id", ranges))
    return rows.join(seen.select(*DEDUP_KEYS), DEDUP_KEYS, "left_anti").select(*rows.columns)


def read_stream_output(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(f"{CLEAN_SCHEMA}, batch_id int").parquet(out).select(*OUTPUT_COLUMNS)


def stateful_dedup(stream: DataFrame) -> DataFrame:
    """Keys seen once per stream, kept in the state store. For bounded streams: this state never expires."""
    return stream.dropDuplicates(DEDUP_KEYS)
