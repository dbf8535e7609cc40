"""The batch stages as callables: ingest -> stage -> load, and the three in a row.

Each may be repeated after it stopped half way. A stage run names its load and lists the files it read; loading under
that name replaces what an earlier attempt left, and then notes the files as consumed, so that no later stage run reads
them even if they cannot be deleted.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trolley.operators.clean import clean_orders, clean_orders_by_order  # noqa: F401 (the first for callers)
from trolley.operators.flatten import flatten_orders
from trolley.sinks.files import exists, land_batch, remove, write_processed
from trolley.sinks.serving import (
    FILES,
    LOAD,
    TABLE,
    append,
    bucket_count,
    create_serving_objects,
    is_recorded,
    loads_of,
    record_files,
)
from trolley.sinks.upkeep import finish_merge
from trolley.sizing import buckets_for, frees_shuffles, input_bytes, scan_by_bucket, size_shuffles
from trolley.sources.payloads import CORRUPT, payload_rejects, read_payloads
from trolley.sources.staged import NoStagedFiles, read_staged_orders, staged_files
from trolley.sources.tables import LARGE, read_processed, read_serving, sibling


@dataclass(frozen=True)
class Locations:
    """Where one deployment keeps its data; every path is on a file system all executors reach.

    ``buckets`` of the serving table are fixed when it is created; left out, they fit the first load.
    """

    payloads: str
    raw: str
    processed: str
    warehouse: str
    database: str = "analytics"
    buckets: int | None = None

    @property
    def table(self) -> str:
        return f"{self.database}.{TABLE}"

    @property
    def manifest(self) -> str:
        """The files behind the processed dataset, and the name of its load."""
        return f"{self.processed.rstrip('/')}.files"

    @property
    def dealt(self) -> str:
        """Into how many buckets the rows of the processed dataset are dealt out."""
        return f"{self.processed.rstrip('/')}.dealt"

    @property
    def rejects(self) -> str:
        return f"{self.raw.rstrip('/')}.rejects"


@frees_shuffles
def ingest(
    spark: SparkSession, at: Locations, batch: str, fmt: str = "parquet", multi_line: bool = False
) -> dict[str, int]:
    """Flatten the payloads into one landing batch.

    Returns what the write itself saw: ``rows_written``, the order documents read (``orders``), the orders the parseable
    payloads declare (``declared_orders``) and the payloads that are none (``bad_payloads``). Those are kept, with their
    text and file, in ``rejects/batch=<batch>``; a second pass over the payloads is made only if there are any.
    """
    size_shuffles(spark, input_bytes(spark, [at.payloads]))
    seen = Observation()
    counted = read_payloads(spark, at.payloads, multi_line, keep_corrupt=True).observe(
        seen,
        F.coalesce(F.sum(F.greatest(F.size("orders"), F.lit(0))), F.lit(0)).alias("orders"),
        F.coalesce(F.sum("total_orders"), F.lit(0)).alias("declared_orders"),
        F.count(CORRUPT).alias("bad_payloads"),
    )
    landed = land_batch(flatten_orders(counted), at.raw, batch, fmt) | seen.get
    rejects = f"{at.rejects}/batch={batch}"
    if landed["bad_payloads"]:
        payload_rejects(spark, at.payloads, multi_line).write.mode("overwrite").parquet(rejects)
    else:
        remove(spark, [rejects])  # of an earlier attempt
    return landed


@dataclass(frozen=True)
class Staged:
    """What a stage run cleaned: the rows it kept, exactly the files it read, and the name of the load to come."""

    rows: int
    files: list[str]
    load_id: str


@frees_shuffles
def stage(spark: SparkSession, at: Locations, ingested_at: Column | None = None) -> Staged:
    """Clean everything staged that no load has consumed, and overwrite the processed dataset."""
    files = staged_files(spark, at.raw)
    consumed = f"{at.database}.{FILES}"
    if spark.catalog.tableExists(consumed):
        # The same path with another time or length is another file.
        files = files.join(spark.table(consumed), ["path", "modified", "length"], "left_anti")
    load_id = uuid.uuid4().hex
    remove(spark, [at.processed])
    files.withColumn(LOAD, F.lit(load_id)).write.mode("overwrite").parquet(at.manifest)
    listed = _manifest(spark, at).select("path", "length").collect()  # what planning the scan holds on the driver anyway
    if not listed:
        raise NoStagedFiles(f"no staged orders files found in {at.raw}, but for what is loaded already")
    paths = [row.path for row in listed]
    size_shuffles(spark, sum(row.length for row in listed))
    raw = read_staged_orders(spark, paths)
    if spark.catalog.tableExists(at.table):
        buckets = bucket_count(spark, at.table)
    else:
        buckets = at.buckets or max(buckets_for(raw.count()), spark.sparkContext.defaultParallelism)
    cleaned, dealt = clean_orders_by_order(raw, ingested_at, buckets)
    noted = spark.createDataFrame([(load_id, buckets if dealt else None)], DEALT).coalesce(1)
    noted.write.mode("overwrite").parquet(at.dealt)
    return Staged(write_processed(cleaned, at.processed), paths, load_id)


DEALT = f"{LOAD} string, buckets int"


def _dealt(spark: SparkSession, at: Locations, load_id: str) -> int | None:
    """Into how many buckets a stage run dealt the processed dataset out, if it did."""
    if not exists(spark, at.dealt):
        return None
    noted = spark.read.schema(DEALT).parquet(at.dealt).where(F.col(LOAD) == load_id).first()
    return noted and noted.buckets


def _manifest(spark: SparkSession, at: Locations) -> DataFrame:
    return spark.read.schema(f"path string, modified timestamp, length bigint, {LOAD} string").parquet(at.manifest)


def staged_before(spark: SparkSession, at: Locations) -> Staged | None:
    """What a stage run left that was not cleaned up, because the run stopped or could not delete."""
    if not exists(spark, at.manifest) or not exists(spark, f"{at.processed}/_SUCCESS"):
        return None
    listed = _manifest(spark, at).select("path", LOAD).collect()
    if not listed:
        return None
    rows = read_processed(spark, at.processed).count()
    return Staged(rows, [row.path for row in listed], listed[0][LOAD])


@frees_shuffles
def load(spark: SparkSession, at: Locations, idempotent: bool = False) -> int:
    """Write the processed dataset to the serving table as one load and note its files as consumed; returns its rows.

    Repeated, it replaces itself. ``idempotent`` leaves out keys that other loads hold. Empty input adds nothing.
    """
    processed = read_processed(spark, at.processed)
    size = input_bytes(spark, [at.processed])
    size_shuffles(spark, size)
    files = _manifest(spark, at) if exists(spark, at.manifest) else None
    load_id = files and files.first()[LOAD]
    dealt = load_id and _dealt(spark, at, load_id)
    buckets = at.buckets or dealt or max(buckets_for(processed.count()), spark.sparkContext.defaultParallelism)
    create_serving_objects(spark, at.database, at.warehouse, buckets)
    if files is None:
        return append(processed, at.table, idempotent)
    finish_merge(spark, at.table)
    if is_recorded(spark, at.table, load_id) and load_id not in loads_of(spark, at.table) | loads_of(
        spark, sibling(at.table, LARGE)
    ):
        return 0  # merged with others since, or without rows
    added = append(processed, at.table, idempotent, load_id=load_id, dealt=dealt)
    record_files(files, at.table, load_id)
    return added


def served(spark: SparkSession, at: Locations) -> DataFrame:
    """Everything loaded so far, for the dashboard queries."""
    scan_by_bucket(spark)
    return read_serving(spark, at.table)


def cleanup(spark: SparkSession, at: Locations, staged: Staged) -> list[str]:
    """Delete the files one stage run read, then the processed dataset; returns what could not be deleted.

    A file that landed after that run was planned is not in its list and stays for the next one.
    """
    return remove(spark, staged.files) + remove(spark, [at.processed, at.manifest, at.dealt])


def run(
    spark: SparkSession,
    at: Locations,
    ingested_at: Column | None = None,
    idempotent: bool = False,
    keep_files: bool = False,
) -> int:
    """Stage, load, and only then clean up what was loaded; returns the rows added.

    A run that stopped after its stage is finished first. Files that cannot be deleted, or that are to be kept
    (``keep_files``), are not loaded again.
    """
    added = 0
    if left := staged_before(spark, at):
        if not is_recorded(spark, at.table, left.load_id):
            added = load(spark, at, idempotent)
        _clean(spark, at, left, keep_files)
        try:
            staged = stage(spark, at, ingested_at)
        except NoStagedFiles:
            return added
    else:
        staged = stage(spark, at, ingested_at)
    added += load(spark, at, idempotent)
    _clean(spark, at, staged, keep_files)
    return added


def _clean(spark: SparkSession, at: Locations, staged: Staged, keep_files: bool) -> list[str]:
    return remove(spark, [at.processed, at.manifest, at.dealt]) if keep_files else cleanup(spark, at, staged)
