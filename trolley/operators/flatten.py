"""Nested order documents to one row per product in an order."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.schema import LANDED_TYPES, ORDER_COLUMNS, ORDER_FIELDS


def flatten_orders(payloads: DataFrame) -> DataFrame:
    """Repeat the order fields on every product; order and column set are fixed.

    ``inline`` yields nothing for a null or empty array, so a payload without orders and an order without products
    disappear. Both generators are map-side: no shuffle.
    """
    orders = payloads.select(F.inline("orders"))
    items = orders.select(*ORDER_FIELDS, F.inline("products"))
    return items.select(*[F.col(c).try_cast(LANDED_TYPES[c]).alias(c) for c in ORDER_COLUMNS])


def payload_metrics(payloads: DataFrame) -> DataFrame:
    """Rows produced and orders seen against the number of orders the payloads declare, in one pass.

    Only order ids are exploded; products are counted in place. The outer variant keeps payloads without orders, and
    a payload's declared count goes to its first order.
    """
    orders = payloads.select("total_orders", F.posexplode_outer("orders").alias("_at", "_order"))
    products = F.coalesce(F.size("_order.products"), F.lit(0))
    n_products = F.when(products > 0, products).otherwise(0)
    return orders.select(
        F.when(F.coalesce("_at", F.lit(0)) == 0, F.col("total_orders")).alias("_declared"),
        F.when(n_products > 0, F.col("_order.order_id")).alias("_order_id"),
        n_products.alias("_products"),
    ).agg(
        F.coalesce(F.sum("_products"), F.lit(0)).alias("rows_written"),
        F.count_distinct("_order_id").alias("orders_with_products"),
        F.coalesce(F.sum("_declared"), F.lit(0)).alias("declared_orders"),
    )
