"""Upkeep of the serving table: many loads become one, with one file for each bucket.

Every load adds a file to each bucket. Merging rewrites chosen loads, bucket by bucket and without a shuffle, to a place
of their own, notes in a journal what is to be exchanged, and then exchanges the catalog's partitions. Whatever stops
after the journal is written, the next upkeep or load finishes the exchange from it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from trolley.schema import CLUSTER_KEYS, OUTPUT_COLUMNS
from trolley.sinks.files import exists, remove, replace
from trolley.sinks.serving import FILES, LOAD, OVERWRITE, TABLE, loads_of, settings
from trolley.sources.tables import LARGE, sibling

JOURNAL = "orders_upkeep"
# Without this a scan of buckets that nothing above it asks for is split like any other, and a task writes all buckets.
AUTO_BUCKETED = "spark.sql.sources.bucketing.autoBucketedScan.enabled"


def location_of(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").first()
    return described["data_type"].rstrip("/")


def _journal(spark: SparkSession, table: str) -> str:
    return f"{location_of(spark, table).removesuffix(TABLE)}{JOURNAL}"


def merge_loads(spark: SparkSession, table: str, loads: list[str] | None = None) -> str | None:
    """Merge ``loads``, by default all that are complete, into one; returns its name, or None with fewer than two."""
    finish_merge(spark, table)
    complete = {row[LOAD] for row in spark.table(sibling(table, FILES)).select(LOAD).distinct().collect()}
    complete |= {load for load in loads_of(spark, table) if load.startswith("merged-")}
    tables = [t for t in (table, sibling(table, LARGE)) if spark.catalog.tableExists(t)]
    held = {t: loads_of(spark, t) & (complete if loads is None else set(loads)) for t in tables}
    if len(set().union(*held.values())) < 2:
        return None
    merged = f"merged-{uuid.uuid4().hex}"
    exchange = []
    for name, old in held.items():
        if not old:
            continue
        place, scratch = f"{location_of(spark, name)}-{merged}", sibling(table, f"scratch_{uuid.uuid4().hex}")
        spark.sql(f"CREATE TABLE {scratch} LIKE {name} LOCATION '{place}'")
        with settings(spark, {OVERWRITE: "dynamic", AUTO_BUCKETED: False}):
            rows = spark.table(name).where(F.col(LOAD).isin(sorted(old))).select(*OUTPUT_COLUMNS)
            rows = rows.sortWithinPartitions(*CLUSTER_KEYS).withColumn(LOAD, F.lit(merged))
            rows.write.insertInto(scratch, overwrite=True)
        spark.sql(f"DROP TABLE {scratch}")  # its files stay
        exchange += [(name, load, merged, f"{place}/{LOAD}={merged}") for load in sorted(old)]
    journal = _journal(spark, table)
    noted = spark.createDataFrame(exchange, "name string, load string, merged string, place string")
    noted.coalesce(1).write.mode("overwrite").parquet(f"{journal}-new")
    replace(spark, f"{journal}-new", journal)
    finish_merge(spark, table)
    return merged


def finish_merge(spark: SparkSession, table: str) -> None:
    """Carry out what the journal says, if there is one. Every step may be repeated."""
    journal = _journal(spark, table)
    if not exists(spark, journal):
        return
    noted = spark.read.schema("name string, load string, merged string, place string").parquet(journal).collect()
    old = []
    for row in noted:  # one row for each load and table
        spark.sql(f"ALTER TABLE {row.name} DROP IF EXISTS PARTITION ({LOAD} = '{row.load}')")
        old.append(f"{location_of(spark, row.name)}/{LOAD}={row.load}")
    for name, merged, place in {(row.name, row.merged, row.place) for row in noted}:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({LOAD} = '{merged}') LOCATION '{place}'")
    for name in {row.name for row in noted}:
        spark.catalog.refreshTable(name)
    remove(spark, [journal])
    remove(spark, old)
