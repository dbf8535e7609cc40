"""Shuffle sizing and the shared workspace."""

import time

import pytest
from pyspark.sql import functions as F

from trolley import sizing
from trolley.plans import retail
from trolley.workspace import Workspace, workspace


def test_partitions_grow_with_input_and_stay_bounded():
    assert sizing.partitions_for(0) == 1
    assert sizing.partitions_for(64 * 2**20) == 1
    assert sizing.partitions_for(10 * 2**30) == 160
    assert sizing.partitions_for(5 * 2**40) == sizing.MANY_PARTITIONS
    assert sizing.partitions_for(100 * 2**40) == 400 * 2**10


def test_sizing_only_raises(spark, sf_dir):
    size = sizing.input_bytes(spark, [f"{sf_dir}/lineitem.parquet", f"{sf_dir}/orders.parquet"])
    assert size > 10_000
    assert sizing.size_shuffles(spark, size) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get(sizing.INITIAL_PARTITIONS, None) is None
    try:
        assert sizing.size_shuffles(spark, 10 * 2**30) == 160
        assert sizing.size_shuffles(spark, size) == 160 and spark.conf.get(sizing.INITIAL_PARTITIONS) == "160"
    finally:
        spark.conf.unset(sizing.INITIAL_PARTITIONS)


def test_workspace_follows_the_session_setting(spark):
    assert workspace(spark).root.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert workspace(spark) is workspace(spark)


def test_shuffle_partitions_are_restored(spark):
    names = (sizing.SHUFFLE_PARTITIONS, sizing.INITIAL_PARTITIONS)
    before = [spark.conf.get(n, None) for n in names]
    with pytest.raises(KeyError), sizing.shuffle_partitions(spark, 3):
        assert [spark.conf.get(n) for n in names] == ["3", "3"]
        raise KeyError
    assert [spark.conf.get(n, None) for n in names] == before


def test_derived_table_is_made_once_per_source():
    ws, made = Workspace("/shared"), []

    def make(path):
        made.append(path)
        return path

    first = ws.once("t", "a", make)
    assert ws.once("t", "a", make) == first and made == [first]
    assert ws.once("t", "b", make) != first
    ws.forget("a")
    assert ws.once("t", "a", make) != first


def test_a_failure_is_not_remembered():
    ws = Workspace("/shared")

    def fail(path):
        raise RuntimeError

    with pytest.raises(RuntimeError):
        ws.once("t", "a", fail)
    assert ws.once("t", "a", lambda path: path)


def test_closing_a_workspace_leaves_nothing(spark, tmp_path):
    ws = Workspace(f"{tmp_path}/ws")
    path = ws.once("t", "a", lambda p: spark.range(3).write.parquet(p) or p)
    spark.sql(f"CREATE TABLE closed_t USING parquet LOCATION '{path}'")
    ws.tables.append("closed_t")
    ws.close(spark)
    assert not (tmp_path / "ws").exists() and not spark.catalog.tableExists("closed_t")


def test_buckets_follow_the_rows_not_the_bytes_of_their_files():
    """60 times sf0.1 is 0.5 GB of Parquet and 36 million lines."""
    assert sizing.buckets_for(0) == 1
    assert sizing.buckets_for(36_000_000) == 138 and sizing.buckets_for(216_000_000) == 824
    assert sizing.buckets_for(10**13) * sizing.MOST_BYTES >= 10**13 * sizing.ROW_BYTES


def shuffles(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def test_steps_leave_no_shuffle_files(spark, sf_dir, tmp_path):
    """Of a job of many steps only the running one has shuffle files, whenever the driver collects garbage."""
    before = shuffles(spark)
    grouped = spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count()
    assert workspace(spark).materialise(grouped, "freed").count() == 7
    retail.store_fact(spark, sf_dir, f"{tmp_path}/fact-freed")
    for _ in range(50):  # executors delete in the background
        if shuffles(spark) <= before + 1:  # the count above
            break
        time.sleep(0.1)
    assert shuffles(spark) <= before + 1
    assert spark.conf.get(sizing.FREE_SHUFFLES, "false") == "false"
