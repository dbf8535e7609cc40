"""Serving database: table and view definitions, clustered and idempotent appends, JDBC."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trolley.operators.clean import deduplicate, format_for_sink
from trolley.operators.filters import VALID_ORDER
from trolley.operators.ranges import Ranges, in_ranges, occupied_ranges
from trolley.operators.skew import HOT_KEY_ROWS, find_hot_keys, split_by_hot
from trolley.schema import CLEAN_TYPES, CLUSTER_KEYS, DEDUP_KEYS, OUTPUT_COLUMNS
from trolley.sources.tables import LARGE, read_loads, sibling
from trolley.workspace import workspace

TABLE = "orders_raw"
VIEW = "orders"
FILES = "orders_files"
LOAD = "load_id"
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
JDBC_BATCH_ROWS = 10_000
SPLIT = "spark.sql.files.maxPartitionBytes"
SPLIT_BYTES = 8 * 1024 * 1024  # of a file for each bucket one task takes one or two


def create_serving_objects(spark: SparkSession, database: str, location: str, buckets: int = 8) -> None:
    """Database, fact table, validity view and the list of files each load consumed, each only when missing.

    The table is bucketed by order, so that steps that group by order need no shuffle of it. The number of buckets is
    fixed with the table: choose it for the size the table will have. Its partitions are the loads, so that a load that
    is repeated replaces what it wrote before.
    """
    columns = ", ".join(f"{name} {ddl}" for name, ddl in CLEAN_TYPES.items())
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.{TABLE} "
        f"({columns}, ingested_at timestamp DEFAULT current_timestamp(), {LOAD} string DEFAULT 'by-hand') "
        f"USING parquet PARTITIONED BY ({LOAD}) LOCATION '{location}/{TABLE}' "
        f"CLUSTERED BY (order_id) SORTED BY ({', '.join(CLUSTER_KEYS)}) INTO {buckets} BUCKETS"
    )
    shown = ", ".join(OUTPUT_COLUMNS)
    spark.sql(
        f"CREATE VIEW IF NOT EXISTS `{database}`.{VIEW} AS "
        f"SELECT {shown} FROM `{database}`.{TABLE} WHERE {VALID_ORDER}"
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.{FILES} "
        f"(path string, modified timestamp, length bigint, {LOAD} string) "
        f"USING parquet PARTITIONED BY ({LOAD}) LOCATION '{location}/{FILES}'"
    )


def clustered(df: DataFrame) -> DataFrame:
    """Range-partition and sort on the table's cluster key, so that row-group statistics skip by order.

    Ranges run over the whole row key: an order that holds a large share of the rows spreads over many files.
    """
    return df.repartitionByRange(*DEDUP_KEYS).sortWithinPartitions(*CLUSTER_KEYS)


def bucket_count(spark: SparkSession, table: str) -> int:
    """Buckets of a table, from its catalog entry."""
    described = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'").first()
    return int(described["data_type"])


@contextmanager
def settings(spark: SparkSession, values: dict[str, object]) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def append(
    df: DataFrame,
    table: str,
    idempotent: bool = False,
    hot_rows: int = HOT_KEY_ROWS,
    load_id: str | None = None,
    dealt: int | None = None,
) -> int:
    """Write one load to the serving table and return its rows.

    A load is a partition: repeated under the same ``load_id``, whole or after it stopped half way, it replaces itself.
    Without an id it is a new load. With ``idempotent`` only keys that no other load holds go in.

    Shuffle and buckets are the same hash, so each load adds one file to each bucket. Rows that lie in files by that hash
    already, ``dealt`` of them, are not shuffled again unless keys are to be compared. Orders of more than ``hot_rows``
    rows would make one bucket too large: they go to a second table without buckets, made when first needed, which
    ``read_serving`` and the view then include.
    """
    spark, load_id = df.sparkSession, load_id or uuid.uuid4().hex
    rows = df.withColumn("ingested_at", F.coalesce("ingested_at", F.current_timestamp())).select(*OUTPUT_COLUMNS)
    # Rows are dealt out by a stage that found no order hot, copies included.
    hot = None if dealt and hot_rows >= HOT_KEY_ROWS else find_hot_keys(rows, "order_id", workspace(spark), hot_rows)
    ordinary, large = (rows, None) if hot is None else split_by_hot(rows, "order_id", hot)
    buckets = bucket_count(spark, table)
    as_they_lie = dealt == buckets and not idempotent
    in_buckets = ordinary if as_they_lie else ordinary.repartition(buckets, "order_id")
    if large is not None:
        _create_large(spark, table)  # before anything is written
    # A join on the whole key keeps the layout by order.
    with settings(spark, {CO_PARTITION: False, OVERWRITE: "dynamic"}):
        if idempotent:
            existing = read_loads(spark, table).where(F.col(LOAD) != load_id)
            ranges = occupied_ranges(rows, "order_id")  # of the rows as they lie, before any shuffle
            in_buckets = new_rows(in_buckets, existing, ranges)
            large = large and new_rows(large, existing, ranges)
        added = _replace_load(large and clustered(large), sibling(table, LARGE), load_id)
        with settings(spark, {SPLIT: SPLIT_BYTES} if as_they_lie else {}):
            return added + _replace_load(in_buckets.sortWithinPartitions(*CLUSTER_KEYS), table, load_id)


def _replace_load(rows: DataFrame | None, table: str, load_id: str) -> int:
    """Make ``rows`` the load's part of a table. Without rows it has none, whatever an earlier attempt wrote."""
    count = 0
    if rows is not None:
        seen = Observation()
        counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.withColumn(LOAD, F.lit(load_id)).write.insertInto(table, overwrite=True)
        count = seen.get["rows"]
    spark = SparkSession.active()
    if not count and spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({LOAD} = '{load_id}')")
    return count


def loads_of(spark: SparkSession, table: str) -> set[str]:
    """The loads whose rows a table holds."""
    if not spark.catalog.tableExists(table):
        return set()
    return {row.partition.removeprefix(f"{LOAD}=") for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def record_files(files: DataFrame, table: str, load_id: str) -> None:
    """Note which files (path, modified, length) a load consumed: from here on it is complete."""
    spark = files.sparkSession
    with settings(spark, {OVERWRITE: "dynamic"}):
        noted = files.select("path", "modified", "length", F.lit(load_id))
        noted.coalesce(1).write.insertInto(sibling(table, FILES), overwrite=True)


def is_recorded(spark: SparkSession, table: str, load_id: str) -> bool:
    files = sibling(table, FILES)
    return spark.catalog.tableExists(files) and not spark.table(files).where(F.col(LOAD) == load_id).isEmpty()


def _create_large(spark: SparkSession, table: str) -> None:
    """The table of large orders, next to the other, and a view over both."""
    large = sibling(table, LARGE)
    if spark.catalog.tableExists(large):
        return
    location = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
    columns = ", ".join(f"{name} {ddl}" for name, ddl in CLEAN_TYPES.items())
    spark.sql(
        f"CREATE TABLE {large} ({columns}, ingested_at timestamp, {LOAD} string) USING parquet "
        f"PARTITIONED BY ({LOAD}) LOCATION '{location.removesuffix(TABLE)}{LARGE}'"
    )
    shown = ", ".join(OUTPUT_COLUMNS)
    spark.sql(
        f"CREATE OR REPLACE VIEW {sibling(table, VIEW)} AS SELECT {shown} FROM {table} WHERE {VALID_ORDER} "
        f"UNION ALL SELECT {shown} FROM {large} WHERE {VALID_ORDER}"
    )


def new_rows(incoming: DataFrame, existing: DataFrame, ranges: Ranges | None = None) -> DataFrame:
    """Incoming rows, one per key, whose key is not in ``existing``.

    Of ``existing`` only the order ranges that ``incoming`` occupies are read; where orders arrive roughly in sequence
    file statistics skip the rest of the history. ``ranges`` are those, where the caller has them from a cheaper plan.
    The kept keys are never null (cleaning rejects those).
    """
    ranges = occupied_ranges(incoming, "order_id") if ranges is None else ranges
    seen = existing.where(in_ranges("order_id", ranges)).select(*DEDUP_KEYS)
    return deduplicate(incoming, DEDUP_KEYS).join(seen, DEDUP_KEYS, "left_anti").select(*incoming.columns)


def write_jdbc(clean: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Append to an external database. Driver class and credentials come in ``properties``.

    Nothing is sent when ``clean`` is empty. Each partition sends its own batches; the append is not atomic, so a
    retried load should go through ``new_rows`` first.
    """
    rows = format_for_sink(clean)
    if not rows.isEmpty():
        rows.write.jdbc(url, table, mode="append", properties={"batchsize": str(JDBC_BATCH_ROWS), **properties})
