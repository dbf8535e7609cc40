"""Processed directory and serving table scans."""

from pyspark.sql import DataFrame, SparkSession

from trolley.schema import CLEAN_SCHEMA, OUTPUT_COLUMNS
from trolley.sources.staged import has_files


class NoProcessedData(FileNotFoundError):
    """The processed directory does not exist or holds no Parquet file."""


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    if not has_files(spark, path, "*.parquet"):
        raise NoProcessedData(f"no processed Parquet directory found in {path}")
    return spark.read.schema(CLEAN_SCHEMA).parquet(path).select(*OUTPUT_COLUMNS)


LARGE = "orders_large"


def sibling(table: str, name: str) -> str:
    """Another table of the same database."""
    return f"{table.rpartition('.')[0]}.{name}"


def read_loads(spark: SparkSession, table: str) -> DataFrame:
    """The serving table with the orders too large for a bucket, if any, and the load that brought each row.

    Without such orders the plan sees a bucketed table; with them it is a union, which falls back to shuffles.
    """
    rows, large = spark.table(table), sibling(table, LARGE)
    return rows.unionByName(spark.table(large)) if spark.catalog.tableExists(large) else rows


def read_serving(spark: SparkSession, table: str) -> DataFrame:
    """The serving table or view by catalog name: the 16 columns, large orders included."""
    rows = read_loads(spark, table) if table.endswith(".orders_raw") else spark.table(table)
    return rows.select(*OUTPUT_COLUMNS)
