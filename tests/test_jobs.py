"""Landing, staging, loading and the serving objects, end to end on files."""

import json
from pathlib import Path

import pytest
from rowsets import rows
from pyspark.sql import functions as F
from test_clean import feed
from test_flatten import ORDER, PAYLOADS, PRODUCT

from trolley.plans import jobs
from trolley.schema import LANDED_TYPES, ORDER_COLUMNS
from trolley.sinks import serving
from trolley.sinks.files import EmptyBatch, land_batch, remove
from trolley.sources.staged import NoStagedFiles, read_staged_orders
from trolley.sources.tables import NoProcessedData


@pytest.fixture
def at(tmp_path):
    payloads = tmp_path / "payloads"
    payloads.mkdir()
    sized = [{**PRODUCT, "add_to_cart_order": i, "product_id": 100 + i} for i in range(1, 5)]
    whole = PAYLOADS[:1] + [{"total_orders": 1, "orders": [{**ORDER, "order_id": 9, "products": sized}]}]
    (payloads / "p.json").write_text("\n".join(json.dumps(p) for p in whole))
    name = "db_" + tmp_path.name.replace("-", "_")
    return jobs.Locations(str(payloads), f"{tmp_path}/raw", f"{tmp_path}/processed", f"{tmp_path}/warehouse", name)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_end_to_end(spark, at, fmt):
    counts = jobs.ingest(spark, at, "b1", fmt)
    documents = [json.loads(line) for line in Path(at.payloads, "p.json").read_text().splitlines()]
    assert counts == {
        "rows_written": 6,
        "orders": sum(len(d["orders"]) for d in documents),
        "declared_orders": sum(d["total_orders"] for d in documents),
        "bad_payloads": 0,
    }
    assert jobs.run(spark, at) == 6
    table = spark.table(at.table)
    assert table.count() == 6 and table.where("ingested_at IS NULL").count() == 0
    assert spark.table(f"{at.database}.orders").count() == 6


def test_staging_again(spark, at):
    jobs.ingest(spark, at, "b1")
    jobs.ingest(spark, at, "b1")  # the same batch replaces itself
    assert jobs.stage(spark, at).rows == 6
    assert jobs.load(spark, at) == 6
    assert jobs.load(spark, at, idempotent=True) == 6  # a load that is repeated replaces itself
    assert jobs.load(spark, at) == 6
    assert spark.table(at.table).count() == 6
    jobs.cleanup(spark, at, jobs.staged_before(spark, at))
    for idempotent, total in ((True, 6), (False, 12)):  # the same rows delivered anew
        jobs.ingest(spark, at, "b2")
        assert jobs.run(spark, at, idempotent=idempotent) == (0 if idempotent else 6)
        assert spark.table(at.table).count() == total


def test_cleanup_takes_only_what_was_staged(spark, at):
    jobs.ingest(spark, at, "b1")
    staged = jobs.stage(spark, at)
    feed(spark, {"order_id": "77"}).select(*[F.col(c).try_cast(t) for c, t in LANDED_TYPES.items()]).write.parquet(
        f"{at.raw}/batch=b2"
    )
    jobs.load(spark, at)
    assert jobs.cleanup(spark, at, staged) == []
    assert {r.order_id for r in read_staged_orders(spark, at.raw).collect()} == {77}
    assert jobs.run(spark, at) == 1
    with pytest.raises(NoStagedFiles):
        jobs.run(spark, at)
    assert spark.table(at.table).count() == 7


def test_failed_removals_are_reported(spark, tmp_path):
    assert remove(spark, [f"{tmp_path}/missing", "nosuchscheme://x/y"]) == [f"{tmp_path}/missing", "nosuchscheme://x/y"]


def test_guards(spark, at):
    with pytest.raises(NoStagedFiles):
        jobs.stage(spark, at)
    with pytest.raises(NoProcessedData):
        jobs.load(spark, at)
    with pytest.raises(ValueError, match="landing format"):
        jobs.ingest(spark, at, "b1", "orc")


def test_empty_batch_fails(spark, at):
    empty = jobs.read_payloads(spark, at.payloads).where("total_orders < 0")
    with pytest.raises(EmptyBatch):
        land_batch(jobs.flatten_orders(empty), at.raw, "b1")
    with pytest.raises(NoStagedFiles):
        jobs.stage(spark, at)


def test_empty_processed_set_loads_nothing(spark, at):
    feed(spark, {"user_id": None}).write.parquet(f"{at.raw}/batch=x")
    assert jobs.run(spark, at) == 0


def test_mixed_landing(spark, tmp_path):
    """Integer days, double days and text in one directory, as writers that let nulls decide the type leave it."""
    raw = f"{tmp_path}/raw"
    typed = feed(spark, {"order_id": "1"}).select(
        *[F.col(c).cast("bigint") if c.endswith(("_id", "number", "order")) or c in ("order_dow", "order_hour_of_day", "reordered")
          else F.col(c) for c in ORDER_COLUMNS]
    )
    days = "days_since_prior_order"
    typed.withColumn(days, F.lit(7).cast("bigint")).write.parquet(f"{raw}/batch=1")
    typed.withColumns({"order_id": F.lit(2).cast("bigint"), days: F.lit(8.0)}).write.parquet(f"{raw}/batch=2")
    typed.withColumns({"order_id": F.lit(3).cast("bigint"), days: F.lit(None).cast("double")}).write.parquet(f"{raw}/batch=3")
    text = [{"order_id": "4", days: "9.0"}, {"order_id": "5", days: None}, {"order_id": "6", days: "7"},
            {"order_id": "7", days: "junk"}]
    feed(spark, *text).write.option("header", True).csv(f"{raw}/batch=4")
    staged = jobs.clean_orders(read_staged_orders(spark, raw))
    assert {r.order_id: r[days] for r in staged.collect()} == {1: 7, 2: 8, 3: None, 4: 9, 5: None, 6: 7, 7: None}


def test_mixed_footers_where_only_spark_reads(spark, tmp_path):
    """A scheme that Arrow does not know."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.landing.link./in", f"file://{tmp_path}")
    typed = feed(spark, {"order_id": "1"}).select(*[F.col(c).try_cast(t) for c, t in LANDED_TYPES.items()])
    days = "days_since_prior_order"
    typed.withColumn(days, F.lit(7).cast("bigint")).write.parquet(f"{tmp_path}/raw/batch=1")
    typed.withColumns({"order_id": F.lit(2).cast("bigint"), days: F.lit(8.0)}).write.parquet(f"{tmp_path}/raw/batch=2")
    staged = read_staged_orders(spark, "viewfs://landing/in/raw")
    assert {r.order_id: r[days] for r in jobs.clean_orders(staged).collect()} == {1: 7, 2: 8}


def test_text_parquet_keeps_its_numbers(spark, tmp_path):
    raw = f"{tmp_path}/raw"
    feed(spark, {"order_hour_of_day": "12.7"}).write.parquet(raw)
    assert [(r.days_since_prior_order, r.order_hour_of_day) for r in read_staged_orders(spark, raw).collect()] == [(7, 12)]


def test_serving_objects_are_created_once(spark, tmp_path):
    for _ in range(2):
        serving.create_serving_objects(spark, "made_twice", f"{tmp_path}/w")
    assert dict(spark.table("made_twice.orders_raw").dtypes)["ingested_at"] == "timestamp"
    columns = ", ".join(ORDER_COLUMNS)
    spark.sql(f"INSERT INTO made_twice.orders_raw ({columns}) VALUES "
              "(1, 1, 1, 1, 1, NULL, 'prior', 1, 'p', 1, 'a', 1, 'd', 1, 0), "
              "(0, 1, 1, 1, 1, NULL, 'prior', 1, 'p', 1, 'a', 1, 'd', 1, 0)")
    assert spark.table("made_twice.orders_raw").where("ingested_at IS NULL").count() == 0
    assert spark.table("made_twice.orders").count() == 1


def test_clustered_files_cover_disjoint_ranges(spark, fact, tmp_path):
    path = f"{tmp_path}/t"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        serving.clustered(fact).write.parquet(path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per_file = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("order_id").alias("a"), F.max("order_id").alias("b"))
    spans = sorted((r.a, r.b) for r in per_file.collect())
    assert len(spans) > 1 and all(left[1] <= right[0] for left, right in zip(spans, spans[1:]))


def test_one_large_order_spreads_over_files(spark, tmp_path):
    rows_of_one = spark.range(10000).select(
        F.lit(1).alias("order_id"), (F.col("id") % 7).alias("product_id"), F.col("id").alias("add_to_cart_order")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        serving.clustered(rows_of_one).write.parquet(f"{tmp_path}/t")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(f"{tmp_path}/t").select(F.input_file_name()).distinct().count() > 1


def test_jdbc_call(spark, monkeypatch):
    """No database is started here: only what the writer is asked to do is checked."""
    calls = []
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.jdbc", lambda self, *a, **k: calls.append((a, k)))
    clean = jobs.clean_orders(feed(spark, {}))
    serving.write_jdbc(clean, "jdbc:some:url", "orders_raw", {"driver": "some.Driver", "user": "u"})
    serving.write_jdbc(clean.limit(0), "jdbc:some:url", "orders_raw", {"driver": "some.Driver"})
    assert calls == [
        (("jdbc:some:url", "orders_raw"),
         {"mode": "append", "properties": {"batchsize": "10000", "driver": "some.Driver", "user": "u"}})
    ]


def test_new_rows_ignores_copies(spark):
    clean = jobs.clean_orders(feed(spark, {}, {}, {"order_id": "2"}, {"order_id": "2", "aisle": "z"}))
    existing = clean.where("order_id = 1")
    twice = existing.unionByName(existing)
    assert [r.order_id for r in serving.new_rows(clean.unionByName(clean), twice).collect()] == [2]
    onto_nothing = serving.new_rows(clean, clean.limit(0)).drop("ingested_at")
    assert rows(onto_nothing) == rows(clean.drop("ingested_at"))


def test_odd_folder_names_are_cleaned_up(spark, at):
    """Spark names scanned files in encoded form; the files must go all the same, or the next run loads them again."""
    odd = jobs.Locations(at.payloads, f"{at.raw} c%20d", at.processed, at.warehouse, at.database)
    for batch in ("b 1", "100%"):
        jobs.ingest(spark, odd, batch)
        assert jobs.run(spark, odd) == 6
    assert spark.table(at.table).count() == 12
    with pytest.raises(NoStagedFiles):
        jobs.stage(spark, odd)


def test_files_that_stay_are_not_loaded_again(spark, at, monkeypatch):
    jobs.ingest(spark, at, "b1")
    monkeypatch.setattr(jobs, "remove", lambda spark, paths: paths)  # nothing can be deleted
    assert jobs.run(spark, at) == 6
    assert jobs.run(spark, at) == 0
    jobs.ingest(spark, at, "b2")
    assert jobs.run(spark, at) == 6
    assert spark.table(at.table).count() == 12


def test_kept_files_and_a_file_of_the_same_name(spark, at):
    jobs.ingest(spark, at, "b1", "csv")
    assert jobs.run(spark, at, keep_files=True) == 6
    with pytest.raises(NoStagedFiles):
        jobs.run(spark, at, keep_files=True)
    file = next(Path(at.raw).rglob("*.csv"))
    (file.parent / f".{file.name}.crc").unlink()
    file.write_text(file.read_text() + file.read_text().splitlines()[1] + "\n")  # delivered anew under its old name
    assert jobs.run(spark, at) == 6 and spark.table(at.table).count() == 12


@pytest.mark.parametrize("name", ["my_orders_raw", "orders_raw"])
def test_a_load_that_fails_half_way(spark, at, name, monkeypatch):
    """It stops between the two inserts, and the next run leaves every row once."""
    at = jobs.Locations(at.payloads, at.raw, at.processed, at.warehouse, f"{name}_{abs(hash(at.raw))}.".rstrip("."), 4)
    items = feed(spark, {}, {"order_id": "2"}).withColumn(
        "add_to_cart_order", F.explode(F.sequence(F.lit(1), F.when(F.col("order_id") == "1", 50).otherwise(3)))
    )
    land_batch(items.select(*[F.col(c).try_cast(t) for c, t in LANDED_TYPES.items()]), at.raw, "b1")
    monkeypatch.setattr(jobs, "append", lambda *a, **k: serving.append(*a, **k, hot_rows=10))
    write, calls = serving._replace_load, []

    def fails_once(rows, table, load_id):
        calls.append(table)
        if len(calls) == 2:
            raise OSError("stopped")
        return write(rows, table, load_id)

    monkeypatch.setattr(serving, "_replace_load", fails_once)
    with pytest.raises(OSError, match="stopped"):
        jobs.run(spark, at)
    assert jobs.served(spark, at).count() == 50  # half a load
    land_batch(feed(spark, {"order_id": "3"}).select(*[F.col(c).try_cast(t) for c, t in LANDED_TYPES.items()]), at.raw, "b2")
    assert jobs.run(spark, at) == 54
    assert jobs.served(spark, at).count() == spark.table(f"{at.database}.orders").count() == 54


def test_bad_payloads_are_counted_and_kept(spark, at):
    good = Path(at.payloads, "p.json").read_text().splitlines()
    bad = [good[1][:-40], "{]", "7"]
    Path(at.payloads, "q.json").write_text("\n".join([*bad, "", good[0]]))
    counts = jobs.ingest(spark, at, "b1")
    assert counts["bad_payloads"] == 3
    assert counts["declared_orders"] == sum(json.loads(p)["total_orders"] for p in [*good, good[0]])
    assert counts["rows_written"] == 8
    kept = spark.read.parquet(f"{at.rejects}/batch=b1").collect()
    assert sorted(r.payload for r in kept) == sorted(bad) and all(r.file.endswith("q.json") for r in kept)
    Path(at.payloads, "q.json").write_text(good[0])
    assert jobs.ingest(spark, at, "b1")["bad_payloads"] == 0
    assert not Path(at.rejects, "batch=b1").exists()


def test_extreme_ids_load_idempotently(spark, at):
    ids = ["-9000000000000000000", "9000000000000000000", "1", "9223372036854775807", "-9223372036854775808"]
    for batch in range(2):
        items = feed(spark, *[{"order_id": i} for i in ids]).select(*[F.col(c).try_cast(t) for c, t in LANDED_TYPES.items()])
        land_batch(items, at.raw, f"b{batch}")
        assert jobs.run(spark, at, idempotent=True) == (0 if batch else 5)
    assert spark.table(at.table).count() == 5


def test_a_batch_is_swapped_in_whole(spark, tmp_path, monkeypatch):
    """Whatever fails, the old batch or the new one stands."""
    from trolley.sinks import files

    for name in ("old", "new"):
        spark.range(3).write.parquet(f"{tmp_path}/{name}")
    files.replace(spark, f"{tmp_path}/new", f"{tmp_path}/old")
    assert spark.read.parquet(f"{tmp_path}/old").count() == 3 and not Path(tmp_path, "new").exists()
    with pytest.raises(OSError):
        files.replace(spark, f"{tmp_path}/missing", f"{tmp_path}/old")
    assert spark.read.parquet(f"{tmp_path}/old").count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["old"]


def test_empty_rerun_keeps_the_earlier_batch(spark, at):
    jobs.ingest(spark, at, "b1")
    empty = jobs.read_payloads(spark, at.payloads).where("total_orders < 0")
    with pytest.raises(EmptyBatch):
        land_batch(jobs.flatten_orders(empty), at.raw, "b1")
    assert jobs.run(spark, at) == 6


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_odd_names_survive_landing(spark, at, fmt):
    names = ['Milk "2%", 1l', "back\\slash", "two\nlines", 'ends with "', "plain", "'quoted'", "a,b"]
    items = feed(spark, *[{"order_id": str(i), "product_name": n} for i, n in enumerate(names)])
    land_batch(items.select(*[F.col(c).try_cast(t) for c, t in LANDED_TYPES.items()]), at.raw, "b1", fmt)
    assert jobs.run(spark, at) == len(names)
    assert [r.product_name for r in spark.table(at.table).orderBy("order_id").collect()] == names


def test_a_large_order_comes_through_whole(spark, at):
    items = feed(spark, {}).withColumn("add_to_cart_order", F.explode(F.sequence(F.lit(1), F.lit(40_000))))
    items = items.withColumn("order_number", F.col("add_to_cart_order") + 30_000)
    land_batch(items.select(*[F.col(c).try_cast(t) for c, t in LANDED_TYPES.items()]), at.raw, "b1")
    assert jobs.run(spark, at) == 40_000
    top = spark.table(at.table).agg(F.max("add_to_cart_order"), F.max("order_number")).first()
    assert tuple(top) == (40_000, 70_000)


def test_large_orders_are_kept_apart_and_served_together(spark, at):
    items = feed(spark, {}, {"order_id": "2"}).withColumn(
        "add_to_cart_order", F.explode(F.sequence(F.lit(1), F.when(F.col("order_id") == "1", 50).otherwise(3)))
    )
    clean = jobs.clean_orders(items)
    serving.create_serving_objects(spark, at.database, at.warehouse, 4)
    assert serving.append(clean, at.table, hot_rows=10) == 53
    assert spark.table(at.table).count() == 3
    assert spark.table(f"{at.database}.orders").count() == jobs.served(spark, at).count() == 53
    assert serving.append(clean, at.table, idempotent=True, hot_rows=10) == 0
    assert serving.append(clean, at.table, hot_rows=10) == 53
    assert jobs.served(spark, at).count() == 106


def test_a_load_takes_the_buckets_that_its_stage_dealt_out(spark, tmp_path, fact, monkeypatch):
    at = jobs.Locations("", f"{tmp_path}/raw", f"{tmp_path}/processed", f"{tmp_path}/wh", "dealt_loads", buckets=4)
    seen = []
    real = jobs.append
    monkeypatch.setattr(jobs, "append", lambda *a, **k: seen.append(k.get("dealt")) or real(*a, **k))
    for batch in ("0", "1"):
        land_batch(fact.where(F.col("product_id") % 2 == int(batch)), at.raw, batch)
        jobs.run(spark, at)
    assert seen == [4, 4]
    assert jobs.served(spark, at).count() == fact.count()
    files = Path(at.warehouse, "orders_raw").rglob("*.parquet")
    assert len(list(files)) == 8  # a file for each bucket and load


def test_a_load_does_not_count_again_what_its_stage_found_cold(spark, tmp_path, fact, monkeypatch):
    at = jobs.Locations("", f"{tmp_path}/raw", f"{tmp_path}/processed", f"{tmp_path}/wh", "counted_once", buckets=4)
    counted = []
    monkeypatch.setattr(serving, "find_hot_keys", lambda *a: counted.append(a))
    land_batch(fact, at.raw, "0")
    assert jobs.run(spark, at) == fact.count() and not counted
