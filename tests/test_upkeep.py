"""Merging of loads: one file a bucket, the same rows, plans without a shuffle, and exchanges that stop half way."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from rowsets import rows

from trolley.plans import dashboard, increments, jobs
from trolley.schema import OUTPUT_COLUMNS
from trolley.sinks import serving, upkeep
from trolley.sinks.files import land_batch
from trolley.sources.tables import sibling


@pytest.fixture
def at(spark, fact, tmp_path):
    """Five loads; one order is large enough for the second table."""
    name = "keep_" + tmp_path.name.replace("-", "_")
    at = jobs.Locations("", f"{tmp_path}/raw", f"{tmp_path}/processed", f"{tmp_path}/warehouse", name, buckets=4)
    for batch in range(5):
        land_batch(fact.where(F.col("order_id") % 5 == batch), at.raw, str(batch))
        jobs.run(spark, at)
    return at


def _files(spark, table):
    named = spark.table(table).select(F.input_file_name().alias("f")).distinct()
    return sorted(r.f for r in named.collect())


def test_one_file_a_bucket_and_the_same_rows(spark, at):
    before = rows(jobs.served(spark, at))
    assert len(_files(spark, at.table)) > 4
    merged = upkeep.merge_loads(spark, at.table)
    assert serving.loads_of(spark, at.table) == {merged}
    assert len(_files(spark, at.table)) == 4
    assert rows(jobs.served(spark, at)) == before
    assert upkeep.merge_loads(spark, at.table) is None
    plan = dashboard.q13_order_size_distribution(jobs.served(spark, at))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(order_id" not in plan
    left = {p.parent.name for p in Path(at.warehouse, "orders_raw").rglob("*.parquet")}
    assert not left  # the old loads' files are gone


def test_loads_go_on_after_a_merge(spark, fact, at):
    increments.refresh(spark, at)
    upkeep.merge_loads(spark, at.table)
    land_batch(fact.where("order_id % 5 = 0"), at.raw, "again")
    assert jobs.run(spark, at, idempotent=True) == 0
    land_batch(fact.where("order_id % 5 = 0"), at.raw, "more")
    more = jobs.run(spark, at)
    increments.refresh(spark, at)
    assert increments.read_items(spark, at).agg(F.sum("n_items")).first()[0] == fact.count() + more
    assert upkeep.merge_loads(spark, at.table) and jobs.served(spark, at).count() == fact.count() + more


def test_large_orders_are_merged_too(spark, fact, at):
    large = fact.limit(1).drop("add_to_cart_order").withColumn("order_id", F.lit(-1).cast("bigint"))
    for k in range(2):
        lines = large.withColumn("add_to_cart_order", F.explode(F.sequence(F.lit(100 * k + 1), F.lit(100 * k + 50))))
        lines = lines.withColumn("ingested_at", F.current_timestamp()).select(*OUTPUT_COLUMNS)
        serving.append(lines.unionByName(lines.limit(0)), at.table, hot_rows=10, load_id=f"large{k}")
    before = rows(jobs.served(spark, at))
    loads = sorted(serving.loads_of(spark, at.table) | {"large0", "large1"})
    merged = upkeep.merge_loads(spark, at.table, loads)
    assert serving.loads_of(spark, sibling(at.table, "orders_large")) == {merged}
    assert rows(jobs.served(spark, at)) == before


@pytest.mark.parametrize("stops_at", [1, 3, 6])
def test_an_exchange_that_stops_is_finished(spark, fact, at, stops_at, monkeypatch):
    before = rows(jobs.served(spark, at))
    run, calls = type(spark).sql, []

    def stops(self, statement, *args, **kwargs):
        if statement.startswith("ALTER TABLE"):
            calls.append(statement)
            if len(calls) == stops_at:
                raise OSError("stopped")
        return run(self, statement, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", stops)
    with pytest.raises(OSError, match="stopped"):
        upkeep.merge_loads(spark, at.table)
    monkeypatch.undo()
    land_batch(fact.where("order_id % 5 = 0"), at.raw, "again")
    assert jobs.run(spark, at, idempotent=True) == 0  # the next load finishes it first
    assert rows(jobs.served(spark, at)) == before
    assert len([x for x in serving.loads_of(spark, at.table) if x.startswith("merged-")]) == 1
