"""Landing directory, processed directory and result marts."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trolley.schema import ORDER_COLUMNS

LANDING_FORMATS = ("parquet", "csv")
# Quotes inside a field are doubled; a field may hold line breaks, so a file is read by one task and stays short.
CSV_OPTIONS = {"header": True, "escape": '"'}
CSV_FILE_ROWS = 1_000_000


class EmptyBatch(ValueError):
    """A batch produced no product rows."""


def land_batch(items: DataFrame, raw_path: str, batch: str, fmt: str = "parquet") -> dict[str, int]:
    """Write one flattened batch to ``raw_path/batch=<batch>`` and return its row count.

    The directory belongs to the batch, so running a batch again replaces it. The count comes from the write itself;
    the plan runs once. Rows go to a hidden directory first and take the batch's place when there are any: a batch
    without rows is an error and leaves an earlier one alone.
    """
    if fmt not in LANDING_FORMATS:
        raise ValueError(f"landing format must be one of {LANDING_FORMATS}, not {fmt!r}")
    spark = items.sparkSession
    path, fresh = f"{raw_path}/batch={batch}", f"{raw_path}/_incoming-{uuid.uuid4().hex}"
    seen = Observation()
    written = items.select(*ORDER_COLUMNS).observe(seen, F.count(F.lit(1)).alias("rows_written"))
    if fmt == "csv":
        written.write.options(**CSV_OPTIONS, maxRecordsPerFile=CSV_FILE_ROWS).csv(fresh)
    else:
        written.write.format(fmt).save(fresh)
    if not seen.get["rows_written"]:
        remove(spark, [fresh])
        raise EmptyBatch("the payload holds no product rows")
    replace(spark, fresh, path)
    return dict(seen.get)


def write_processed(clean: DataFrame, path: str) -> int:
    """Overwrite the processed dataset; returns the row count observed during the write."""
    seen = Observation()
    clean.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def replace(spark: SparkSession, fresh: str, path: str) -> None:
    """Move a written directory to its place. What stood there steps aside first and goes last, so that at every moment
    one of the two is whole."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(fresh), hadoop.Path(path)
    aside = hadoop.Path(target.getParent(), f"_old-{uuid.uuid4().hex}")
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    replaced = files.exists(target)
    if replaced and not _renamed(files, target, aside):
        raise OSError(f"could not move {path} aside")
    if not _renamed(files, source, target):
        if replaced:
            _renamed(files, aside, target)
        raise OSError(f"could not move {fresh} to {path}")
    if replaced:
        files.delete(aside, True)


def _renamed(files, source, target) -> bool:
    try:
        return files.rename(source, target)
    except Py4JJavaError:
        return False


def remove(spark: SparkSession, paths: list[str], threads: int = 32) -> list[str]:
    """Delete files or directories on whatever file system they live; returns the paths that could not be deleted."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def gone(path: str) -> bool:
        try:
            target = hadoop.Path(path)
            return target.getFileSystem(conf).delete(target, True)
        except Py4JJavaError:
            return False

    with ThreadPoolExecutor(threads) as pool:  # the calls wait for the file system, not for this process
        return [path for path, done in zip(paths, pool.map(gone, paths), strict=True) if not done]
