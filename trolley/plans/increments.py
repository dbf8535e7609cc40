"""Marts that grow with the loads.

Each load is summed up once, into partials of its own: counts and sums by order and by product, and bitmaps of the
orders that a department or a cart position was part of. Partials of several loads add up (bitmaps: or), whatever the
loads have in common, so a reader merges them and a new load reads no rows but its own. A load that is repeated replaces
its partials.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trolley.functions.labels import cart_step
from trolley.functions.rates import pct2
from trolley.plans.dashboard import FUNNEL_STEPS, MIN_ITEMS_FOR_TOP_RATE, TOP_AISLES, Query
from trolley.plans.jobs import Locations
from trolley.plans.mart import MART_KEYS, MART_QUERIES, InconsistentOrders
from trolley.sinks.serving import LOAD, OVERWRITE, loads_of, settings
from trolley.sources.tables import LARGE, read_loads, sibling

ITEM_KEYS = ["department", "aisle", "product_id", "product_name"]
SUMS = ["n_items", "n_reordered"]


def _summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    sums = (F.count(F.lit(1)), F.sum("reordered").cast("bigint"))
    return rows.groupBy(LOAD, *keys).agg(*[c.alias(n) for n, c in zip(SUMS, sums, strict=True)])


def _orders(rows: DataFrame) -> DataFrame:
    return _summed(rows, MART_KEYS)


def _items(rows: DataFrame) -> DataFrame:
    return _summed(rows, ITEM_KEYS)


def _order_bits(rows: DataFrame) -> DataFrame:
    """Orders by department and by cart position, as bitmaps of 32,768 orders each."""
    steps = rows.where(F.col("add_to_cart_order") <= FUNNEL_STEPS)
    parts = []
    for dimension, of, column in (("department", rows, "department"), ("step", steps, "add_to_cart_order")):
        keys = [F.col(column).cast("string").alias("value"), F.bitmap_bucket_number("order_id").alias("bucket")]
        bits = F.bitmap_construct_agg(F.bitmap_bit_position("order_id")).alias("bits")
        parts.append(of.groupBy(LOAD, *keys).agg(bits).withColumn("dimension", F.lit(dimension)))
    return reduce(DataFrame.unionByName, parts)


# Table of each kind of partial: its columns and how a load's rows become them.
PARTIALS = {
    "mart_orders": (
        "order_id bigint, user_id bigint, order_number bigint, order_dow tinyint, order_hour_of_day tinyint, "
        "days_since_prior_order int, n_items bigint, n_reordered bigint",
        _orders,
    ),
    "mart_items": (
        "department string, aisle string, product_id bigint, product_name string, n_items bigint, n_reordered bigint",
        _items,
    ),
    "mart_order_bits": ("dimension string, value string, bucket bigint, bits binary", _order_bits),
}


def refresh(spark: SparkSession, at: Locations, again: set[str] = frozenset()) -> list[str]:
    """Sum up the loads that have no partials yet, and those of ``again``; returns them. Reads no other load.

    Partials of loads that are gone, because upkeep merged them, go too.
    """
    loaded = loads_of(spark, at.table) | loads_of(spark, sibling(at.table, LARGE))
    names = {kind: sibling(at.table, kind) for kind in PARTIALS}
    done = set.intersection(*(loads_of(spark, name) for name in names.values()))
    for name in names.values():
        for gone in loads_of(spark, name) - loaded:
            spark.sql(f"ALTER TABLE {name} DROP PARTITION ({LOAD} = '{gone}')")
    fresh = sorted((loaded - done) | (loaded & again))
    if not fresh:
        return []
    rows = read_loads(spark, at.table).where(F.col(LOAD).isin(fresh))
    with settings(spark, {OVERWRITE: "dynamic"}):
        for kind, (columns, summed) in PARTIALS.items():
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {names[kind]} ({columns}, {LOAD} string) USING parquet "
                f"PARTITIONED BY ({LOAD}) LOCATION '{at.warehouse}/{kind}'"
            )
            partials = summed(rows).select(*spark.table(names[kind]).columns)
            partials.repartition(F.col(LOAD), F.xxhash64(partials.columns[0])).write.insertInto(
                names[kind], overwrite=True
            )
    return fresh


def _merged(spark: SparkSession, at: Locations, kind: str, keys: list[str]) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in SUMS]
    return spark.table(sibling(at.table, kind)).groupBy(*keys).agg(*sums)


def read_orders(spark: SparkSession, at: Locations) -> DataFrame:
    """The order-grain mart over all loads; refused when two of them, or one, disagree about an order."""
    mart = _merged(spark, at, "mart_orders", MART_KEYS)
    if not mart.groupBy("order_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty():
        raise InconsistentOrders("order columns disagree within an order; query the table instead")
    return mart


def read_items(spark: SparkSession, at: Locations) -> DataFrame:
    return _merged(spark, at, "mart_items", ITEM_KEYS)


def distinct_orders(spark: SparkSession, at: Locations, dimension: str) -> DataFrame:
    """``value, orders``: the number of distinct orders, exactly, by merging bitmaps."""
    bits = spark.table(sibling(at.table, "mart_order_bits")).where(F.col("dimension") == dimension)
    merged = bits.groupBy("value", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy("value").agg(F.sum(F.bitmap_count("bits")).alias("orders"))


def _sold(name: str = "total_items_sold") -> Column:
    return F.sum("n_items").alias(name)


def _rate(items: str = "total_items_sold") -> Column:
    return pct2("_reorders", items).alias("reorder_rate_pct")


def _reorders() -> Column:
    return F.sum("n_reordered").alias("_reorders")


def _largest(items: DataFrame, *keys: str) -> DataFrame:
    return items.groupBy(*keys).agg(_sold()).orderBy(F.desc("total_items_sold"), *keys)


def _q07(items: DataFrame) -> DataFrame:
    products = items.groupBy("product_id", "product_name").agg(_sold(), _reorders())
    rated = products.where(F.col("total_items_sold") >= MIN_ITEMS_FOR_TOP_RATE)
    rated = rated.select("product_id", "product_name", "total_items_sold", _rate())
    order = [F.desc("reorder_rate_pct"), F.desc("total_items_sold"), "product_id"]
    return rated.orderBy(*order).limit(10).drop("product_id")


def _q24(items: DataFrame) -> DataFrame:
    named = items.withColumnsRenamed({"department": "source", "aisle": "target"})
    return _largest(named, "source", "target").limit(30)


def _q28(items: DataFrame) -> DataFrame:
    aisles = items.groupBy("department", "aisle").agg(_sold(), _reorders())
    rank = F.rank().over(Window.partitionBy("department").orderBy(F.desc("total_items_sold"))).cast("bigint")
    top = aisles.withColumn("rank_in_department", rank).where(F.col("rank_in_department") <= TOP_AISLES)
    columns = top.select("department", "aisle", "total_items_sold", _rate(), "rank_in_department")
    return columns.orderBy("department", "rank_in_department", "aisle")


ITEM_QUERIES: dict[str, Query] = {
    "q03_total_products_sold": lambda items: items.agg(F.coalesce(_sold(), F.lit(0)).alias("total_products_sold")),
    "q04_overall_reorder_rate": lambda items: items.agg(_sold(), _reorders()).select(_rate()),
    "q06_top_products": lambda items: items.groupBy("product_id", "product_name")
    .agg(_sold())
    .orderBy(F.desc("total_items_sold"), "product_id")
    .limit(10)
    .drop("product_id"),
    "q07_top_products_by_reorder_rate": _q07,
    "q08_top_departments": lambda items: _largest(items, "department").limit(10),
    "q09_top_aisles": lambda items: _largest(items, "aisle").limit(10),
    "q10_department_share": lambda items: _largest(items, "department"),
    "q24_department_aisle_flow": _q24,
    "q28_top_aisles_per_department": _q28,
}


def scorecard(spark: SparkSession, at: Locations) -> DataFrame:
    items = read_items(spark, at).groupBy("department").agg(
        _sold(), _reorders(), F.count_distinct("product_id").alias("unique_products")
    )
    orders = distinct_orders(spark, at, "department").withColumnsRenamed({"orders": "unique_orders"})
    both = items.join(orders, F.col("department").eqNullSafe(F.col("value")))
    columns = both.select("department", "total_items_sold", "unique_products", "unique_orders", _rate())
    return columns.orderBy(F.desc("total_items_sold"), "department")


def funnel(spark: SparkSession, at: Locations) -> DataFrame:
    steps = distinct_orders(spark, at, "step").withColumn("step", F.col("value").cast("bigint")).orderBy("step")
    return steps.select(cart_step("step").alias("cart_step"), F.col("orders").alias("orders_reaching_step"))


def dashboard_from_marts(spark: SparkSession, at: Locations) -> dict[str, DataFrame]:
    """Every dashboard query that the partials answer, by name."""
    orders, items = read_orders(spark, at), read_items(spark, at)
    results = {name: query(orders) for name, query in MART_QUERIES.items()}
    results |= {name: query(items) for name, query in ITEM_QUERIES.items()}
    results["q02_total_unique_users"] = orders.agg(F.count_distinct("user_id").alias("total_unique_users"))
    results["q23_cart_position_funnel"] = funnel(spark, at)
    results["q25_department_scorecard"] = scorecard(spark, at)
    return results
