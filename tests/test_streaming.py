"""Available-now runs over a landing directory."""

from pathlib import Path

from rowsets import rows
from pyspark.sql import functions as F
from test_clean import feed

from trolley.operators.clean import clean_orders
from trolley.schema import ORDER_COLUMNS, TEXT_SCHEMA
from trolley.sinks.files import CSV_OPTIONS
from trolley.streaming.landing import (
    dedup_stream,
    earlier_batches,
    ingest_stream,
    read_landing_stream,
    read_stream_output,
    stateful_dedup,
    unseen,
)


def _land(spark, raw, name, *order_ids):
    feed(spark, *[{"order_id": str(i)} for i in order_ids]).coalesce(1).write.parquet(f"{raw}/batch={name}")


def _orders(spark, out):
    return sorted(r.order_id for r in read_stream_output(spark, out).collect())


def test_each_run_takes_only_new_files(spark, tmp_path):
    raw, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    _land(spark, raw, "a", 1, 2)
    ingest_stream(read_landing_stream(spark, raw), out)
    assert _orders(spark, out) == [1, 2]
    files = set(Path(out).rglob("*.parquet"))
    ingest_stream(read_landing_stream(spark, raw), out)
    assert set(Path(out).rglob("*.parquet")) == files
    _land(spark, raw, "b", 2, 3)
    ingest_stream(read_landing_stream(spark, raw), out)
    assert _orders(spark, out) == [1, 2, 2, 3]


def test_dedup_across_batches(spark, tmp_path):
    raw, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    _land(spark, raw, "a", 1, 2, 3, 4)
    dedup_stream(read_landing_stream(spark, raw), out)
    assert _orders(spark, out) == [1, 2, 3, 4]
    _land(spark, raw, "b", 1, 2, 3, 4, 4, 5)
    dedup_stream(read_landing_stream(spark, raw), out)
    assert _orders(spark, out) == [1, 2, 3, 4, 5]


def test_dedup_within_one_run_of_many_micro_batches(spark, tmp_path, fact):
    from trolley.plans import retail

    raw, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    feed_rows = retail.dirty_feed(fact)
    feed_rows.repartition(4).write.parquet(f"{raw}/batch=a")
    dedup_stream(read_landing_stream(spark, raw, max_files=1), out)
    assert len(list(Path(out).glob("batch_id=*"))) == 4
    expected = clean_orders(feed_rows).select(*ORDER_COLUMNS)
    assert rows(read_stream_output(spark, out).select(*ORDER_COLUMNS)) == rows(expected)


def test_replayed_micro_batch_lands_once(spark, tmp_path):
    raw, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    _land(spark, raw, "a", 1, 2)
    dedup_stream(read_landing_stream(spark, raw), out)
    _land(spark, raw, "b", 2, 3)
    dedup_stream(read_landing_stream(spark, raw), out)
    # A failure after the write but before the commit leaves the second micro-batch to be run again.
    for name in ("1", ".1.crc"):
        (Path(out) / "_progress" / "commits" / name).unlink()
    dedup_stream(read_landing_stream(spark, raw), out)
    assert _orders(spark, out) == [1, 2, 3]


def test_consumed_files_are_archived(spark, tmp_path):
    raw, out, archive = f"{tmp_path}/raw", f"{tmp_path}/out", f"{tmp_path}/archive"
    spark.conf.set("spark.sql.streaming.fileSource.cleaner.numThreads", "0")
    try:
        for name in "abc":
            _land(spark, raw, name, ord(name))
            ingest_stream(read_landing_stream(spark, raw, archive=archive), out)
    finally:
        spark.conf.unset("spark.sql.streaming.fileSource.cleaner.numThreads")
    assert _orders(spark, out) == [97, 98, 99]
    archived = list(Path(archive).rglob("*.parquet"))
    left = list(Path(raw).rglob("*.parquet"))
    assert archived and len(archived) + len(left) == 3


def test_state_store_dedup(spark, tmp_path):
    raw = f"{tmp_path}/raw"
    _land(spark, raw, "a", 1, 2, 2)
    _land(spark, raw, "b", 2, 3)
    rows_of = spark.readStream.schema(TEXT_SCHEMA).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1)
    stream = stateful_dedup(rows_of.parquet(raw))
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c")
    writer.trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
    result = spark.read.parquet(f"{tmp_path}/out").select(F.col("order_id"))
    assert rows(result) == [("1",), ("2",), ("3",)]


def test_formats_and_types_may_mix(spark, tmp_path):
    raw, out = f"{tmp_path}/raw dir", f"{tmp_path}/out"
    days = "days_since_prior_order"
    items = feed(spark, {"order_id": "1"})
    items.withColumn(days, F.lit(7).cast("bigint")).write.parquet(f"{raw}/batch=a")
    items.withColumns({"order_id": F.lit("2"), days: F.lit(8.0)}).write.parquet(f"{raw}/batch=b")
    dedup_stream(read_landing_stream(spark, raw), out)
    text = feed(spark, {"order_id": "3", "product_name": 'two\nlines of "2%", x'}, {"order_id": "1"})
    text.write.options(**CSV_OPTIONS).csv(f"{raw}/batch=c")
    dedup_stream(read_landing_stream(spark, raw), out)
    found = {r.order_id: (r[days], r.product_name) for r in read_stream_output(spark, out).collect()}
    assert found == {1: (7, "milk"), 2: (8, "milk"), 3: (7, 'two\nlines of "2%", x')}
    assert read_stream_output(spark, out).count() == 3


def test_only_folders_that_may_hold_its_orders_are_opened(spark, tmp_path):
    raw, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    for name, ids in (("a", [1, 2, 3]), ("b", [1000, 2000]), ("c", [5, 10**15]), ("d", [2, 3, 4])):
        _land(spark, raw, name, *ids)
        dedup_stream(read_landing_stream(spark, raw), out)
    assert _orders(spark, out) == [1, 2, 3, 4, 5, 1000, 2000, 10**15]
    assert earlier_batches(spark, out, 4, [(2, 4)]) == [0, 3]
    assert earlier_batches(spark, out, 4, [(1500, 3000), (10**15, 2**63 - 1)]) == [1, 2]
    assert earlier_batches(spark, out, 4, [(6, 900)]) == []
    late = clean_orders(feed(spark, {"order_id": "2000"}, {"order_id": "2001"}))
    plan = unseen(late, out, 4, [(2000, 2001)])
    assert {r.order_id for r in plan.collect()} == {2001}
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "batch_id=1" in text and not any(f"batch_id={b}" in text for b in (0, 2, 3))


def test_extreme_ids_and_an_empty_micro_batch(spark, tmp_path):
    raw, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    ids = [-(2**63), -9 * 10**18, 0, 9 * 10**18, 2**63 - 1]
    for name in "ab":
        _land(spark, raw, name, *ids)
        dedup_stream(read_landing_stream(spark, raw), out)
    feed(spark, {"order_id": None}).write.parquet(f"{raw}/batch=c")
    dedup_stream(read_landing_stream(spark, raw), out)
    assert _orders(spark, out) == ids


def test_streams_are_sized(spark, tmp_path, monkeypatch):
    from trolley.streaming import landing

    seen = []
    monkeypatch.setattr(landing, "size_shuffles", lambda spark, size: seen.append(size))
    raw = f"{tmp_path}/raw"
    _land(spark, raw, "a", 1)
    _land(spark, raw, "b", 2)
    ingest_stream(read_landing_stream(spark, raw), f"{tmp_path}/out")
    assert seen == [sum(p.stat().st_size for p in Path(raw).rglob("*.parquet"))]


def test_earlier_keys_are_compared_order_by_order(spark, tmp_path, fact, monkeypatch):
    """The shuffle that brings the copies of a micro-batch together serves the comparison: nothing is written between."""
    from trolley.plans import retail
    from trolley.streaming import landing
    from trolley.workspace import Workspace

    raw, out, plans, made = f"{tmp_path}/raw", f"{tmp_path}/out", [], []
    real, materialise = landing.unseen, Workspace.materialise

    def noted(rows_of, *args):
        with landing.settings(rows_of.sparkSession, {landing.CO_PARTITION: False}):
            fresh = real(rows_of, *args)
            plans.append(fresh._jdf.queryExecution().executedPlan().toString())
            return fresh

    monkeypatch.setattr(landing, "unseen", noted)
    monkeypatch.setattr(Workspace, "materialise", lambda ws, df, name: made.append(name) or materialise(ws, df, name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for batch, copies in enumerate((False, True)):
            retail.dirty_feed(fact, copies=copies).write.parquet(f"{raw}/batch={batch}")
            dedup_stream(read_landing_stream(spark, raw), out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "micro-batch" not in made
    (text,) = plans
    exchanges = [line for line in text.splitlines() if "Exchange" in line]
    assert len(exchanges) == 2 and all("hashpartitioning(order_id#" in e and "add_to_cart" not in e for e in exchanges)
    expected = clean_orders(retail.dirty_feed(fact)).select(*ORDER_COLUMNS)
    assert rows(read_stream_output(spark, out).select(*ORDER_COLUMNS)) == rows(expected)


def test_large_orders_are_compared_with_earlier_keys(spark, tmp_path, fact, monkeypatch):
    """Orders that take the aggregate over the whole key meet earlier keys as all others do."""
    from functools import partial

    from trolley.operators.clean import clean_orders_by_order
    from trolley.plans import retail
    from trolley.streaming import landing

    raw, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    monkeypatch.setattr(landing, "clean_orders_by_order", partial(clean_orders_by_order, hot_rows=6))
    retail.dirty_feed(fact.where("product_id % 2 = 0")).write.parquet(f"{raw}/batch=0")
    dedup_stream(read_landing_stream(spark, raw), out)
    retail.dirty_feed(fact).write.parquet(f"{raw}/batch=1")
    dedup_stream(read_landing_stream(spark, raw), out)
    expected = clean_orders(retail.dirty_feed(fact)).select(*ORDER_COLUMNS)
    assert rows(read_stream_output(spark, out).select(*ORDER_COLUMNS)) == rows(expected)
