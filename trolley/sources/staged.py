"""Staged landing files: Parquet and CSV, whichever are there, combined by column name."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.operators.clean import type_columns
from trolley.schema import LANDED_TYPES, ORDER_COLUMNS, TEXT_SCHEMA
from trolley.sinks.files import CSV_OPTIONS


FOOTER_THREADS = 32


class NoStagedFiles(FileNotFoundError):
    """The landing directory holds no Parquet and no CSV file."""


Paths = str | list[str]  # a directory, or files


def _listed(path: Paths) -> list[str]:
    return [path] if isinstance(path, str) else path


def list_files(spark: SparkSession, path: Paths, pattern: str) -> DataFrame:
    """``path, modified, length`` of the files below a directory, on any file system; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(_listed(path))
    )
    return files.select("path", F.col("modificationTime").alias("modified"), "length")


def has_files(spark: SparkSession, path: Paths, pattern: str) -> bool:
    try:
        return not list_files(spark, path, pattern).isEmpty()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def staged_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, modified, length`` of what is staged in either format."""
    try:
        return list_files(spark, path, "*.{parquet,csv}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise NoStagedFiles(f"no staged orders files found in {path}") from e
        raise


def _files_by_types(spark: SparkSession, path: Paths) -> list[list[str]]:
    """Parquet files grouped by the column types in their footers; no rows are read.

    Tasks read the footers where Arrow knows the file system. Elsewhere Spark's own file system classes do, which only the
    driver can call: with some footers at a time, each a few kilobytes.
    """

    # Nested so that it is shipped by value: executors need not have this package installed.
    def footer_types(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            types = []
            for file in paths:
                scheme, _, inner = file.partition(":")
                inner = quote(re.sub("^/+", "///", inner) if scheme == "file" else inner)
                try:
                    fs, inner = pafs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}:{inner}")
                    footer = pq.read_schema(inner, filesystem=fs)
                    types.append(";".join(sorted(f"{column.name}:{column.type}" for column in footer)))
                except (pa.ArrowInvalid, OSError):  # not a scheme of Arrow's, or its library is not here
                    types.append(None)
            yield pa.RecordBatch.from_pydict({"path": paths, "types": pa.array(types, pa.string())})

    footers = list_files(spark, path, "*.parquet").select("path").mapInArrow(footer_types, "path string, types string")
    files: dict[str, list[str]] = defaultdict(list)
    others = []
    for row in footers.collect():  # one short row per file, what planning the scan holds on the driver anyway
        if row.types is None:
            others.append(row.path)
        else:
            files[row.types].append(row.path)
    with ThreadPoolExecutor(FOOTER_THREADS) as pool:  # the calls wait for the file system
        for file, types in zip(others, pool.map(lambda f: _footer_types(spark, f), others), strict=True):
            files[types].append(file)
    return list(files.values())


def _footer_types(spark: SparkSession, file: str) -> str:
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        columns = reader.getFooter().getFileMetaData().getSchema().getColumns()
        return ";".join(sorted(column.toString() for column in columns))
    finally:
        reader.close()


def read_staged_parquet(spark: SparkSession, path: Paths) -> DataFrame:
    """Parquet batches whose footers need not agree.

    A writer that lets nulls turn integers into doubles leaves files no single scan can read. Spark first compares
    all footers; only when they disagree do the files fall into groups, one scan each, brought
    to the landed types.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    try:
        scans = [reader.option("mergeSchema", True).parquet(*_listed(path))]
    except (Py4JJavaError, PySparkException) as e:
        if "CANNOT_MERGE_SCHEMAS" not in str(e):
            raise
        scans = [spark.read.parquet(*files) for files in _files_by_types(spark, path)]
    return reduce(DataFrame.unionByName, [type_columns(scan, LANDED_TYPES) for scan in scans])


def read_staged_csv(spark: SparkSession, path: Paths) -> DataFrame:
    """CSV with a header and empty fields as NULL, read as text: 7.0 in an integer column must survive.

    Quoted fields may hold doubled quotes and line breaks, so a file is read by one task; landing bounds its rows.
    """
    reader = spark.read.options(**CSV_OPTIONS, multiLine=True, nullValue="").schema(TEXT_SCHEMA)
    return reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(_listed(path))


def read_staged_orders(spark: SparkSession, path: Paths) -> DataFrame:
    """All staged rows below a directory or in the given files. No staged file is an error, not an empty result.

    With both formats present the Parquet side is rendered as text, so that no CSV value is lost before cleaning.
    """
    frames = []
    for ending, read in ((".parquet", read_staged_parquet), (".csv", read_staged_csv)):
        if isinstance(path, str):
            if has_files(spark, path, f"*{ending}"):
                frames.append(read(spark, path))
        elif named := [file for file in path if file.endswith(ending)]:  # listed already
            frames.append(read(spark, named))
    if not frames:
        raise NoStagedFiles(f"no staged orders files found in {path}")
    if len(frames) == 1:
        return frames[0]
    return reduce(DataFrame.unionByName, [f.select(*[F.col(c).cast("string") for c in ORDER_COLUMNS]) for f in frames])
