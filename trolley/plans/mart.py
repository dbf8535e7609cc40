"""Order-grain mart: an opt-in fast path for the queries that count orders.

One row per order turns distinct-order counts into plain counts over about a quarter of the rows. That equals the
row-level definition only when ``order_id`` determines every order column, which ``order_mart`` verifies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions.labels import (
    cart_bucket_label,
    cart_bucket_start,
    day_name,
    frequency_bucket,
    interval_segment,
)
from trolley.functions.rates import hundredths, mean_of_hundredths, pct2, ratio2
from trolley.operators.quality import orders_are_consistent
from trolley.plans.dashboard import Query

MART_KEYS = ["order_id", "user_id", "order_number", "order_dow", "order_hour_of_day", "days_since_prior_order"]


class InconsistentOrders(ValueError):
    """Some order carries two values for an order column, so the mart would not match the row-level queries."""


def order_mart(fact: DataFrame, verify: bool = True) -> DataFrame:
    if verify and not orders_are_consistent(fact):
        raise InconsistentOrders("order columns disagree within an order; query the fact instead")
    return fact.groupBy(*MART_KEYS).agg(
        F.count(F.lit(1)).alias("n_items"), F.sum("reordered").cast("bigint").alias("n_reordered")
    )


def _orders(name: str = "total_orders") -> Column:
    return F.count(F.lit(1)).alias(name)


def _items() -> Column:
    return F.sum("n_items").alias("_items")


def _reorders() -> Column:
    return F.sum("n_reordered").alias("_reorders")


def _rate() -> Column:
    return pct2("_reorders", "_items").alias("reorder_rate_pct")


def _basket(orders: str, name: str) -> Column:
    return ratio2("_items", orders).alias(name)


def _day() -> Column:
    return day_name("order_dow").alias("day_name")


def _q01(mart: DataFrame) -> DataFrame:
    return mart.agg(F.count("order_id").alias("total_unique_orders"))


def _q05(mart: DataFrame) -> DataFrame:
    return mart.agg(_items(), _orders()).select(_basket("total_orders", "avg_products_per_order"))


def _q11(mart: DataFrame) -> DataFrame:
    hours = mart.groupBy(F.col("order_hour_of_day").alias("hour_of_day")).agg(_orders())
    return hours.orderBy(F.asc_nulls_last("hour_of_day"))


def _q12(mart: DataFrame) -> DataFrame:
    days = mart.groupBy("order_dow").agg(_orders())
    return days.select("order_dow", _day(), "total_orders").orderBy(F.asc_nulls_last("order_dow"))


def _q13(mart: DataFrame) -> DataFrame:
    buckets = mart.groupBy(cart_bucket_start("n_items").alias("_start")).agg(_orders())
    label = cart_bucket_label("_start").alias("cart_size_bucket")
    return buckets.orderBy("_start").select(label, "total_orders")


def _q15(mart: DataFrame) -> DataFrame:
    users = mart.groupBy("user_id").agg(_orders("order_frequency"), _items())
    rated = users.select("user_id", "order_frequency", _basket("order_frequency", "avg_order_size"))
    return rated.orderBy(F.desc("order_frequency"), F.desc("avg_order_size"), "user_id")


def _q16(mart: DataFrame) -> DataFrame:
    numbers = mart.groupBy("order_number").agg(_items(), _reorders())
    return numbers.select("order_number", _rate()).orderBy(F.asc_nulls_last("order_number"))


def _q17(mart: DataFrame) -> DataFrame:
    later = mart.where(F.col("days_since_prior_order").isNotNull())
    return later.groupBy("days_since_prior_order").agg(_orders()).orderBy("days_since_prior_order")


def _q18(mart: DataFrame) -> DataFrame:
    days = mart.groupBy("order_dow").agg(_orders(), _items())
    columns = days.select("order_dow", _day(), "total_orders", _basket("total_orders", "avg_cart_size"))
    return columns.orderBy(F.asc_nulls_last("order_dow"))


def _q22(mart: DataFrame) -> DataFrame:
    users = mart.groupBy("user_id").agg(_orders(), _items())
    top = users.orderBy(F.desc("total_orders"), F.desc("_items"), "user_id").limit(20)
    items = F.col("_items").alias("total_items_bought")
    return top.select("user_id", "total_orders", items, _basket("total_orders", "avg_products_per_order"))


def _q26(mart: DataFrame) -> DataFrame:
    days = F.col("days_since_prior_order")
    segments = (
        mart.where(days.isNotNull())
        .groupBy(interval_segment("days_since_prior_order").alias("interval_segment"))
        .agg(_orders(), _items(), _reorders(), F.min(days).alias("_from"))
    )
    basket = _basket("total_orders", "avg_basket_size")
    return segments.orderBy("_from").select("interval_segment", "total_orders", basket, _rate())


def _q27(mart: DataFrame) -> DataFrame:
    rounded = mart.select(
        "order_dow",
        hundredths("n_items - n_reordered", "n_items", 10_000).alias("_new"),
        hundredths("n_reordered", "n_items", 10_000).alias("_returning"),
    )
    days = rounded.groupBy("order_dow").agg(
        F.sum("_new").alias("_new"), F.sum("_returning").alias("_returning"), _orders()
    )
    return days.select(
        "order_dow",
        _day(),
        mean_of_hundredths("_new", "total_orders").alias("avg_pct_new"),
        mean_of_hundredths("_returning", "total_orders").alias("avg_pct_returning"),
    ).orderBy(F.asc_nulls_last("order_dow"))


def _q29(mart: DataFrame) -> DataFrame:
    users = mart.groupBy("user_id").agg(_orders(), _items(), _reorders())
    stats = users.select(
        "total_orders",
        hundredths("_items", "total_orders", 100).alias("_basket"),
        hundredths("_reorders", "_items", 10_000).alias("_rate"),
    )
    buckets = stats.groupBy(frequency_bucket("total_orders").alias("frequency_bucket")).agg(
        _orders("total_users"),
        F.sum("_basket").alias("_basket"),
        F.sum("_rate").alias("_rate"),
        F.min("total_orders").alias("_from"),
    )
    return buckets.orderBy("_from").select(
        "frequency_bucket",
        "total_users",
        mean_of_hundredths("_basket", "total_users").alias("avg_basket_size"),
        mean_of_hundredths("_rate", "total_users").alias("avg_reorder_rate_pct"),
    )


def _q30(mart: DataFrame) -> DataFrame:
    hours = mart.groupBy(F.col("order_hour_of_day").alias("hour_of_day")).agg(_orders(), _items(), _reorders())
    return hours.select("hour_of_day", "total_orders", _rate()).orderBy(F.asc_nulls_last("hour_of_day"))


MART_QUERIES: dict[str, Query] = {
    "q01_total_unique_orders": _q01,
    "q05_avg_products_per_order": _q05,
    "q11_orders_by_hour": _q11,
    "q12_orders_by_dow": _q12,
    "q13_order_size_distribution": _q13,
    "q15_user_frequency_vs_basket": _q15,
    "q16_reorder_by_order_number": _q16,
    "q17_orders_by_days_since_prior": _q17,
    "q18_orders_and_cart_by_dow": _q18,
    "q22_top_users": _q22,
    "q26_interval_segments": _q26,
    "q27_new_vs_returning_by_dow": _q27,
    "q29_user_frequency_cohorts": _q29,
    "q30_reorder_by_hour": _q30,
}
