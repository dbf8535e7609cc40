"""Every registered query: name -> (spark, folder of the retail tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.operators.clean import (
    clean_orders,
    deduplicate,
    drop_null_keys,
    format_for_sink,
    reject_report,
    type_columns,
)
from trolley.operators.filters import apply_filters, valid_orders
from trolley.operators.flatten import flatten_orders, payload_metrics
from trolley.operators.quality import consistency_check, latest_rows, row_count, table_profile
from trolley.plans import dashboard, increments, jobs, retail
from trolley.plans.mart import order_mart
from trolley.schema import INGESTED_AT_FORMAT, ORDER_COLUMNS
from trolley.sinks.files import land_batch
from trolley.sinks.serving import new_rows
from trolley.sources.payloads import read_payloads
from trolley.sources.staged import read_staged_orders, staged_files
from trolley.sources.tables import read_serving, sibling
from trolley.streaming.landing import dedup_stream, ingest_stream, read_landing_stream, read_stream_output
from trolley.workspace import workspace

Registered = Callable[[SparkSession, str], DataFrame]


def _load_time():
    """A fixed load time: the real clock would make results differ between runs."""
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.dirty_feed(retail.fact(spark, sf_dir))


def fact_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.fact(spark, sf_dir)


def flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_orders(read_payloads(spark, retail.payload_path(spark, sf_dir)))


def ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_metrics(read_payloads(spark, retail.payload_path(spark, sf_dir)))


def union_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = read_staged_orders(spark, retail.mixed_landing_path(spark, sf_dir))
    return drop_null_keys(type_columns(staged))


def clean_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_columns(_dirty(spark, sf_dir))


def clean_dropna(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_null_keys(type_columns(_dirty(spark, sf_dir)))


def clean_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = retail.table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    return deduplicate(lines, ["l_orderkey", "l_partkey", "l_linenumber"])


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_orders(_dirty(spark, sf_dir), _load_time()).select(*ORDER_COLUMNS)


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_report(_dirty(spark, sf_dir))


def valid_orders_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_orders(retail.fact(spark, sf_dir))


def dashboard_filtered_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = apply_filters(
        retail.fact(spark, sf_dir), departments=["LARGE", "PROMO", "STANDARD"], hours=range(8, 18), dows=[0, 6]
    )
    return dashboard.q25_department_scorecard(chosen)


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest_rows(retail.with_load_time(retail.fact(spark, sf_dir)))
    return rows.withColumn("ingested_at", F.date_format("ingested_at", INGESTED_AT_FORMAT))


def idempotent_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full re-delivery onto a table that already holds every user's earlier orders adds only the rest."""
    items = retail.fact(spark, sf_dir)
    existing = items.where("eval_set = 'prior'")
    return existing.unionByName(new_rows(items, existing))


def order_grain_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_mart(retail.fact(spark, sf_dir))


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_profile(read_serving(spark, _loaded_table(spark, sf_dir)))


def consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consistency_check(retail.fact(spark, sf_dir))


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two column types arrive, then text; an available-now run after each cleans what is new."""
    ws = workspace(spark)
    landing, out = ws.fresh("landing"), ws.fresh("stream")
    for arriving in (retail.MIXED_BATCHES[:2], retail.MIXED_BATCHES[2:]):
        for batch in arriving:
            retail.land_mixed(spark, sf_dir, landing, batch)
        ingest_stream(read_landing_stream(spark, landing), out, _load_time())
    return read_stream_output(spark, out).select(*ORDER_COLUMNS)


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed arrives, then arrives again with copies; the second run adds nothing it has already."""
    ws = workspace(spark)
    landing, out = ws.fresh("landing"), ws.fresh("stream")
    for batch, copies in enumerate((False, True)):
        feed = retail.dirty_feed(retail.fact(spark, sf_dir), copies=copies)
        feed.write.parquet(f"{landing}/batch={batch}")
        dedup_stream(read_landing_stream(spark, landing), out, _load_time())
    return read_stream_output(spark, out).select(*ORDER_COLUMNS)


def _locations(root: str, payloads: str) -> jobs.Locations:
    database = "trolley_" + root.rsplit("-", 1)[-1]
    return jobs.Locations(payloads, f"{root}/raw", f"{root}/processed", f"{root}/warehouse", database)


def _loaded_table(spark: SparkSession, sf_dir: str) -> str:
    """Ingest, stage and load the payloads into a serving table of this session; returns its name."""

    def make(root: str) -> str:
        at = _locations(root, retail.payload_path(spark, sf_dir))
        jobs.ingest(spark, at, batch="0")
        jobs.run(spark, at, _load_time())
        return at.table

    return workspace(spark).once("serving", sf_dir, make)


def payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an ingest of payloads reports of which some are cut short, next to what it landed and what it kept apart."""
    at = _locations(workspace(spark).fresh("rejects"), retail.cut_payload_path(spark, sf_dir))
    counts = jobs.ingest(spark, at, batch="0")
    landed = spark.read.parquet(f"{at.raw}/batch=0").agg(
        F.count(F.lit(1)).alias("rows_landed"), F.count_distinct("order_id").alias("orders_landed")
    )
    kept = spark.read.parquet(f"{at.rejects}/batch=0").agg(F.count("payload").alias("payloads_kept"))
    row = landed.unionByName(kept, allowMissingColumns=True)
    row = row.agg(*[F.max(c).alias(c) for c in ("rows_landed", "orders_landed", "payloads_kept")])
    reported = [F.lit(counts[c]).cast("bigint").alias(c) for c in ("bad_payloads", "orders", "declared_orders")]
    return row.select("*", *reported)


def load_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run stops after its load, before its cleanup; the next one finishes it, and every row is there once."""
    at = _locations(workspace(spark).fresh("replayed"), retail.payload_path(spark, sf_dir))
    jobs.ingest(spark, at, batch="0")
    jobs.stage(spark, at, _load_time())
    jobs.load(spark, at)
    jobs.load(spark, at)
    jobs.run(spark, at, _load_time())
    return jobs.served(spark, at).select(*ORDER_COLUMNS)


def cleanup_leftovers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches land and are loaded one by one, and no consumed file is deleted: none is loaded twice."""
    at = _locations(workspace(spark).fresh("leftovers"), "")  # batches land without payloads
    for batch in retail.MIXED_BATCHES:
        retail.land_mixed(spark, sf_dir, at.raw, batch)
        jobs.run(spark, at, _load_time(), keep_files=True)
    return jobs.served(spark, at).select(*ORDER_COLUMNS)


# Dashboard results in one form: name, label column, count column, rate column (or none).
_SHOWN = (
    ("q10_department_share", "department", "total_items_sold", None),
    ("q11_orders_by_hour", "hour_of_day", "total_orders", None),
    ("q13_order_size_distribution", "cart_size_bucket", "total_orders", None),
    ("q15_user_frequency_vs_basket", "user_id", "order_frequency", "avg_order_size"),
    ("q18_orders_and_cart_by_dow", "day_name", "total_orders", "avg_cart_size"),
    ("q23_cart_position_funnel", "cart_step", "orders_reaching_step", None),
    ("q25_department_scorecard", "department", "unique_orders", "reorder_rate_pct"),
    ("q28_top_aisles_per_department", "aisle", "total_items_sold", "reorder_rate_pct"),
    ("q30_reorder_by_hour", "hour_of_day", "total_orders", "reorder_rate_pct"),
)


def _shown(results: dict[str, DataFrame]) -> DataFrame:
    rows = [
        results[name].select(
            F.lit(name).alias("query"),
            F.col(label).cast("string").alias("label"),
            F.col(total).cast("bigint").alias("total"),
            (F.col(rate) if rate else F.lit(None)).cast("double").alias("rate"),
        )
        for name, label, total, rate in _SHOWN
        if name in results
    ]
    return reduce(DataFrame.unionByName, rows)


def dashboard_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results merged from the partials of two loads that have orders, users and products in common."""
    at = _locations(workspace(spark).fresh("marts"), "")  # batches land without payloads
    items = retail.fact(spark, sf_dir)
    for batch, some in enumerate(("product_id % 2 = 0", "product_id % 2 = 1")):
        land_batch(items.where(some), at.raw, str(batch))
        jobs.run(spark, at, _load_time())
        increments.refresh(spark, at)
    return _shown(increments.dashboard_from_marts(spark, at))


def result_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sections of the dashboard, written as tables and read again."""
    sections = ["time_patterns", "cart_deep_dive"]
    out = workspace(spark).fresh("results")
    written = dashboard.write_dashboard(retail.fact(spark, sf_dir), out, sections)
    return _shown({name: spark.read.parquet(path) for name, path in written.items()})


def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consumed files go to an archive; what it and the landing directory hold together is what arrived."""
    ws = workspace(spark)
    landing, out, archive = ws.fresh("landing"), ws.fresh("stream"), ws.fresh("archive")
    for batch in retail.MIXED_BATCHES:
        retail.land_mixed(spark, sf_dir, landing, batch)
        ingest_stream(read_landing_stream(spark, landing, archive=archive), out, _load_time())
    held = read_staged_orders(spark, [r.path for r in staged_files(spark, landing).collect()])
    gone = read_staged_orders(spark, [r.path for r in staged_files(spark, archive).collect()])
    text = [F.col(c).cast("string").alias(c) for c in ORDER_COLUMNS]
    return drop_null_keys(type_columns(held.select(*text).unionByName(gone.select(*text))))


def serving_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sixteen columns as loaded, with the load time as text."""
    rows = read_serving(spark, _loaded_table(spark, sf_dir))
    return rows.withColumn("ingested_at", F.date_format("ingested_at", INGESTED_AT_FORMAT))


def sink_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form an external table takes."""
    return format_for_sink(clean_orders(_dirty(spark, sf_dir), _load_time()))


def serving_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog view over the loaded table."""
    return read_serving(spark, sibling(_loaded_table(spark, sf_dir), "orders")).select(*ORDER_COLUMNS)


def _over_serving(query: dashboard.Query) -> Registered:
    return lambda spark, sf_dir: query(read_serving(spark, _loaded_table(spark, sf_dir)))


# Dashboard queries of every shape, over the table that the pipeline itself writes.
SERVED = ("q01", "q11", "q13", "q14", "q18", "q21", "q22", "q25", "q27", "q28")
SERVING = {f"serving_{name}": query for name, query in dashboard.QUERIES.items() if name.startswith(SERVED)}
SERVING["serving_kpis"] = dashboard.kpis


def loaded_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(read_serving(spark, _loaded_table(spark, sf_dir)))


def _over_fact(query: dashboard.Query) -> Registered:
    return lambda spark, sf_dir: query(retail.fact(spark, sf_dir))


QUERIES: dict[str, Registered] = {
    **{name: _over_fact(query) for name, query in dashboard.QUERIES.items()},
    "dashboard_kpis": _over_fact(dashboard.kpis),
    "dashboard_filtered_scorecard": dashboard_filtered_scorecard,
    "order_grain_mart": order_grain_mart,
    "fact_order_items": fact_order_items,
    "flatten_orders": flattened,
    "ingest_metrics": ingest_metrics,
    "union_staged": union_staged,
    "clean_typed": clean_typed,
    "clean_dropna": clean_dropna,
    "clean_dedup": clean_dedup,
    "clean_orders": cleaned,
    "reject_report": rejects,
    "valid_orders_view": valid_orders_view,
    "serving_roundtrip": serving_roundtrip,
    "payload_rejects": payload_rejects,
    "load_replayed": load_replayed,
    "cleanup_leftovers": cleanup_leftovers,
    "dashboard_marts": dashboard_marts,
    "result_marts": result_marts,
    "sink_format": sink_format,
    "serving_view": serving_view,
    **{name: _over_serving(query) for name, query in SERVING.items()},
    "loaded_row_count": loaded_row_count,
    "latest_rows": latest,
    "idempotent_append": idempotent_append,
    "table_profile": profile,
    "consistency_check": consistency,
    "stream_ingest": stream_ingest,
    "stream_dedup": stream_dedup,
    "stream_archive": stream_archive,
}
