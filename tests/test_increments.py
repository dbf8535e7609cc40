"""Marts by increment: merged partials equal the queries over the whole table, and a load reads only its own rows."""

import pytest
from pyspark.sql import functions as F
from rowsets import rows

from trolley.plans import dashboard, increments, jobs
from trolley.plans.mart import InconsistentOrders
from trolley.sinks.files import land_batch
from trolley.sources.tables import sibling


@pytest.fixture
def at(tmp_path):
    name = "inc_" + tmp_path.name.replace("-", "_")
    return jobs.Locations("", f"{tmp_path}/raw", f"{tmp_path}/processed", f"{tmp_path}/warehouse", name)


def _load(spark, at, items, batch):
    land_batch(items, at.raw, batch)
    return jobs.run(spark, at)


def test_merged_partials_equal_the_table(spark, fact, at):
    """The loads share orders, users, products and, in the end, whole rows."""
    for batch, some in enumerate(("product_id % 2 = 0", "product_id % 2 = 1", "order_id < 200")):
        _load(spark, at, fact.where(some), str(batch))
        assert len(increments.refresh(spark, at)) == 1
    assert increments.refresh(spark, at) == []
    served = jobs.served(spark, at)
    results = increments.dashboard_from_marts(spark, at)
    assert len(results) == 26
    for name, result in results.items():
        assert rows(result) == rows(dashboard.QUERIES[name](served)), name


def test_only_new_loads_are_read(spark, fact, at, monkeypatch):
    _load(spark, at, fact.where("order_id % 2 = 0"), "a")
    increments.refresh(spark, at)
    _load(spark, at, fact.where("order_id % 2 = 1"), "b")
    read = []
    for kind, (columns, summed) in list(increments.PARTIALS.items()):
        monkeypatch.setitem(increments.PARTIALS, kind, (columns, lambda r, f=summed: read.append(r) or f(r)))
    (load_id,) = increments.refresh(spark, at)
    assert len(read) == 3
    for seen in read:
        files = {f.rpartition("/")[0].rpartition("/")[2] for f in _scanned(seen)}
        assert files == {f"load_id={load_id}"}


def _scanned(df):
    """The files whose rows a plan returns."""
    return {r.f for r in df.select(F.input_file_name().alias("f")).distinct().collect()}


def test_a_replaced_load_replaces_its_partials(spark, fact, at):
    land_batch(fact, at.raw, "a")
    jobs.stage(spark, at)
    jobs.load(spark, at)
    (load_id,) = increments.refresh(spark, at)
    jobs.load(spark, at)
    assert increments.refresh(spark, at, {load_id}) == [load_id]
    assert spark.table(sibling(at.table, "mart_orders")).agg(F.sum("n_items")).first()[0] == fact.count()


def test_orders_that_disagree_are_refused(spark, fact, at):
    _load(spark, at, fact, "a")
    _load(spark, at, fact.limit(1).withColumn("order_dow", F.lit(9).cast("tinyint")), "b")
    increments.refresh(spark, at)
    with pytest.raises(InconsistentOrders):
        increments.read_orders(spark, at)
