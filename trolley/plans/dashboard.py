"""The thirty dashboard queries over the order-item fact, one function each: fact DataFrame -> result DataFrame.

Conventions:

* Counts, sums and ranks are BIGINT and rates DOUBLE with two decimals from exact integer arithmetic.
* Distinct orders per group are counted exactly with one distinct column per aggregate, which Spark runs as two
  partial/final steps keyed by (group, order) and then group; no group is gathered in one task.
* Every ORDER BY ends in a unique key. Top-k results are therefore stable, and long results can be range-sorted
  even when most rows tie on the leading keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.functions.labels import (
    DAY_NAMES,
    cart_bucket_label,
    cart_bucket_start,
    cart_step,
    day_name,
    frequency_bucket,
    interval_segment,
)
from trolley.functions.rates import hundredths, mean_of_hundredths, pct2, ratio2
from trolley.operators.ranking import rank_by_value

Query = Callable[[DataFrame], DataFrame]

MIN_ITEMS_FOR_TOP_RATE = 5
MIN_ITEMS_FOR_SCATTER = 3
FUNNEL_STEPS = 10
TOP_AISLES = 3


def _items(name: str = "total_items_sold") -> Column:
    return F.count(F.lit(1)).alias(name)


def _orders(name: str = "total_orders") -> Column:
    return F.count_distinct("order_id").alias(name)


def _reorders() -> Column:
    return F.sum("reordered").alias("_reorders")


def _rate(items: str = "total_items_sold") -> Column:
    return pct2("_reorders", items).alias("reorder_rate_pct")


def _largest_first(df: DataFrame, *tie_breakers: str) -> DataFrame:
    return df.orderBy(F.desc("total_items_sold"), *tie_breakers)


def q01_total_unique_orders(fact: DataFrame) -> DataFrame:
    return fact.agg(_orders("total_unique_orders"))


def q02_total_unique_users(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count_distinct("user_id").alias("total_unique_users"))


def q03_total_products_sold(fact: DataFrame) -> DataFrame:
    return fact.agg(_items("total_products_sold"))


def q04_overall_reorder_rate(fact: DataFrame) -> DataFrame:
    return fact.agg(_items(), _reorders()).select(_rate())


def q05_avg_products_per_order(fact: DataFrame) -> DataFrame:
    totals = fact.agg(_items(), _orders())
    return totals.select(ratio2("total_items_sold", "total_orders").alias("avg_products_per_order"))


def q06_top_products(fact: DataFrame) -> DataFrame:
    products = fact.groupBy("product_id", "product_name").agg(_items())
    return _largest_first(products, "product_id").limit(10).drop("product_id")


def q07_top_products_by_reorder_rate(fact: DataFrame) -> DataFrame:
    products = fact.groupBy("product_id", "product_name").agg(_items(), _reorders())
    sold = products.where(F.col("total_items_sold") >= MIN_ITEMS_FOR_TOP_RATE)
    rated = sold.select("product_id", "product_name", "total_items_sold", _rate())
    best = rated.orderBy(F.desc("reorder_rate_pct"), F.desc("total_items_sold"), "product_id").limit(10)
    return best.drop("product_id")


def _items_by(fact: DataFrame, column: str) -> DataFrame:
    return _largest_first(fact.groupBy(column).agg(_items()), column)


def q08_top_departments(fact: DataFrame) -> DataFrame:
    return _items_by(fact, "department").limit(10)


def q09_top_aisles(fact: DataFrame) -> DataFrame:
    return _items_by(fact, "aisle").limit(10)


def q10_department_share(fact: DataFrame) -> DataFrame:
    return _items_by(fact, "department")


def q11_orders_by_hour(fact: DataFrame) -> DataFrame:
    hours = fact.groupBy(F.col("order_hour_of_day").alias("hour_of_day")).agg(_orders())
    return hours.orderBy(F.asc_nulls_last("hour_of_day"))


def q12_orders_by_dow(fact: DataFrame) -> DataFrame:
    days = fact.groupBy("order_dow").agg(_orders())
    return days.select("order_dow", _day(), "total_orders").orderBy(F.asc_nulls_last("order_dow"))


def _day() -> Column:
    return day_name("order_dow").alias("day_name")


def q13_order_size_distribution(fact: DataFrame) -> DataFrame:
    sizes = fact.groupBy("order_id").agg(_items("_size"))
    buckets = sizes.groupBy(cart_bucket_start("_size").alias("_start")).agg(_items("total_orders"))
    return buckets.orderBy("_start").select(
        cart_bucket_label("_start").alias("cart_size_bucket"), "total_orders"
    )


def q14_volume_vs_reorder(fact: DataFrame) -> DataFrame:
    products = fact.groupBy("product_id", "product_name").agg(_orders(), _items(), _reorders())
    sold = products.where(F.col("total_items_sold") >= MIN_ITEMS_FOR_SCATTER)
    ordered = sold.orderBy(F.desc("total_orders"), "product_id")
    return ordered.select("product_name", "total_orders", _rate(), "total_items_sold")


def q15_user_frequency_vs_basket(fact: DataFrame) -> DataFrame:
    baskets = fact.groupBy("user_id", "order_id").agg(_items("_size"))
    users = baskets.groupBy("user_id").agg(_items("order_frequency"), F.sum("_size").alias("_total"))
    rated = users.select(
        "user_id", "order_frequency", ratio2("_total", "order_frequency").alias("avg_order_size")
    )
    return rated.orderBy(F.desc("order_frequency"), F.desc("avg_order_size"), "user_id")


def q16_reorder_by_order_number(fact: DataFrame) -> DataFrame:
    numbers = fact.groupBy("order_number").agg(_items(), _reorders())
    return numbers.select("order_number", _rate()).orderBy(F.asc_nulls_last("order_number"))


def q17_orders_by_days_since_prior(fact: DataFrame) -> DataFrame:
    later = fact.where(F.col("days_since_prior_order").isNotNull())
    return later.groupBy("days_since_prior_order").agg(_orders()).orderBy("days_since_prior_order")


def q18_orders_and_cart_by_dow(fact: DataFrame) -> DataFrame:
    # min() instead of an arbitrary value: equal on consistent orders and repeatable on others.
    sizes = fact.groupBy("order_id").agg(F.min("order_dow").alias("order_dow"), _items("_size"))
    days = sizes.groupBy("order_dow").agg(_items("total_orders"), F.sum("_size").alias("_total"))
    return days.select(
        "order_dow", _day(), "total_orders", ratio2("_total", "total_orders").alias("avg_cart_size")
    ).orderBy(F.asc_nulls_last("order_dow"))


def q19_department_contribution(fact: DataFrame) -> DataFrame:
    return _items_by(fact, "department").limit(12)


def q20_reorder_by_department_dow(fact: DataFrame) -> DataFrame:
    # Rows first shrink to one per (department, weekday); the pivot then works on a handful of rows.
    cells = fact.groupBy("department", "order_dow").agg(_items(), _reorders())
    pivoted = []
    for dow in range(len(DAY_NAMES)):
        on_day = F.col("order_dow") == dow
        pivoted += [
            F.sum(F.when(on_day, F.col("total_items_sold"))).alias(f"_items_{dow}"),
            F.sum(F.when(on_day, F.col("_reorders"))).alias(f"_reorders_{dow}"),
        ]
    departments = cells.groupBy("department").agg(*pivoted, F.sum("total_items_sold").alias("total_items_sold"))
    rates = [
        pct2(f"_reorders_{dow}", f"_items_{dow}").alias(f"{name.lower()}_reorder_rate_pct")
        for dow, name in enumerate(DAY_NAMES)
    ]
    return _largest_first(departments.select("department", *rates, "total_items_sold"), "department")


def q21_product_rank_in_department(fact: DataFrame) -> DataFrame:
    product = ["department", "product_id", "product_name"]
    metrics = fact.groupBy(*product).agg(_items(), _orders("unique_orders"), _reorders())
    metrics = metrics.withColumn("_product", F.struct("product_id", "product_name"))
    ranked = rank_by_value(metrics, "department", "total_items_sold", "_product", "rank_within_department")
    return ranked.orderBy("department", "rank_within_department", "product_id").select(
        "department", "product_name", "total_items_sold", "unique_orders", _rate(), "rank_within_department"
    )


def q22_top_users(fact: DataFrame) -> DataFrame:
    users = fact.groupBy("user_id").agg(_orders(), _items("total_items_bought"))
    top = users.orderBy(F.desc("total_orders"), F.desc("total_items_bought"), "user_id").limit(20)
    basket = ratio2("total_items_bought", "total_orders").alias("avg_products_per_order")
    return top.select("user_id", "total_orders", "total_items_bought", basket)


def q23_cart_position_funnel(fact: DataFrame) -> DataFrame:
    steps = fact.where(F.col("add_to_cart_order") <= FUNNEL_STEPS)
    reached = steps.groupBy("add_to_cart_order").agg(_orders("orders_reaching_step")).orderBy("add_to_cart_order")
    return reached.select(cart_step("add_to_cart_order").alias("cart_step"), "orders_reaching_step")


def q24_department_aisle_flow(fact: DataFrame) -> DataFrame:
    flows = fact.groupBy(F.col("department").alias("source"), F.col("aisle").alias("target")).agg(_items())
    return _largest_first(flows, "source", "target").limit(30)


def q25_department_scorecard(fact: DataFrame) -> DataFrame:
    # Two aggregates with one distinct column each. A single one would send every row through an Expand that
    # triples it; joining two results with one row per department costs nothing.
    orders = fact.groupBy("department").agg(_items(), _orders("unique_orders"), _reorders())
    products = fact.groupBy(F.col("department").alias("_department")).agg(
        F.count_distinct("product_id").alias("unique_products")
    )
    both = orders.join(products, F.col("department").eqNullSafe(F.col("_department")))
    columns = both.select("department", "total_items_sold", "unique_products", "unique_orders", _rate())
    return _largest_first(columns, "department")


def q26_interval_segments(fact: DataFrame) -> DataFrame:
    days = F.col("days_since_prior_order")
    segments = (
        fact.where(days.isNotNull())
        .groupBy(interval_segment("days_since_prior_order").alias("interval_segment"))
        .agg(_orders(), _items("_items"), _reorders(), F.min(days).alias("_from"))
    )
    return segments.orderBy("_from").select(
        "interval_segment",
        "total_orders",
        ratio2("_items", "total_orders").alias("avg_basket_size"),
        _rate("_items"),
    )


def q27_new_vs_returning_by_dow(fact: DataFrame) -> DataFrame:
    def share(value: int, name: str) -> Column:
        return hundredths(f"_n{value}", "_items", 10_000).alias(name)

    orders = fact.groupBy("order_id").agg(
        F.min("order_dow").alias("order_dow"),
        F.count_if(F.col("reordered") == 0).alias("_n0"),
        F.count_if(F.col("reordered") == 1).alias("_n1"),
        _items("_items"),
    )
    # The per-order shares are rounded before they are averaged.
    rounded = orders.select("order_dow", share(0, "_new"), share(1, "_returning"))
    days = rounded.groupBy("order_dow").agg(
        F.sum("_new").alias("_new"), F.sum("_returning").alias("_returning"), _items("_orders")
    )
    return days.select(
        "order_dow",
        _day(),
        mean_of_hundredths("_new", "_orders").alias("avg_pct_new"),
        mean_of_hundredths("_returning", "_orders").alias("avg_pct_returning"),
    ).orderBy(F.asc_nulls_last("order_dow"))


def q28_top_aisles_per_department(fact: DataFrame) -> DataFrame:
    aisles = fact.groupBy("department", "aisle").agg(_items(), _reorders())
    # The filter on the rank becomes a per-task group limit, so few rows per department reach the window.
    rank = F.rank().over(Window.partitionBy("department").orderBy(F.desc("total_items_sold")))
    top = aisles.withColumn("rank_in_department", rank.cast("bigint")).where(
        F.col("rank_in_department") <= TOP_AISLES
    )
    return top.select("department", "aisle", "total_items_sold", _rate(), "rank_in_department").orderBy(
        "department", "rank_in_department", "aisle"
    )


def q29_user_frequency_cohorts(fact: DataFrame) -> DataFrame:
    users = fact.groupBy("user_id").agg(_orders("_orders"), _items("_items"), _reorders())
    # Per-user values are rounded before they are averaged.
    stats = users.select(
        "_orders",
        hundredths("_items", "_orders", 100).alias("_basket"),
        hundredths("_reorders", "_items", 10_000).alias("_rate"),
    )
    buckets = stats.groupBy(frequency_bucket("_orders").alias("frequency_bucket")).agg(
        _items("total_users"),
        F.sum("_basket").alias("_basket"),
        F.sum("_rate").alias("_rate"),
        F.min("_orders").alias("_from"),
    )
    return buckets.orderBy("_from").select(
        "frequency_bucket",
        "total_users",
        mean_of_hundredths("_basket", "total_users").alias("avg_basket_size"),
        mean_of_hundredths("_rate", "total_users").alias("avg_reorder_rate_pct"),
    )


def q30_reorder_by_hour(fact: DataFrame) -> DataFrame:
    hours = fact.groupBy(F.col("order_hour_of_day").alias("hour_of_day")).agg(_orders(), _items("_items"), _reorders())
    return hours.select("hour_of_day", "total_orders", _rate("_items")).orderBy(F.asc_nulls_last("hour_of_day"))


def kpis(fact: DataFrame) -> DataFrame:
    """The five headline numbers as one row: one aggregate per distinct column, no Expand."""
    columns = ["total_unique_orders", "total_products_sold", "_reorders", "total_unique_users"]
    by_order = fact.agg(_orders(columns[0]), _items(columns[1]), _reorders())
    by_user = fact.agg(F.count_distinct("user_id").alias(columns[3]))
    row = by_order.unionByName(by_user, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in columns])
    return row.select(
        "total_unique_orders",
        "total_unique_users",
        "total_products_sold",
        pct2("_reorders", "total_products_sold").alias("reorder_rate_pct"),
        ratio2("total_products_sold", "total_unique_orders").alias("avg_products_per_order"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        q01_total_unique_orders,
        q02_total_unique_users,
        q03_total_products_sold,
        q04_overall_reorder_rate,
        q05_avg_products_per_order,
        q06_top_products,
        q07_top_products_by_reorder_rate,
        q08_top_departments,
        q09_top_aisles,
        q10_department_share,
        q11_orders_by_hour,
        q12_orders_by_dow,
        q13_order_size_distribution,
        q14_volume_vs_reorder,
        q15_user_frequency_vs_basket,
        q16_reorder_by_order_number,
        q17_orders_by_days_since_prior,
        q18_orders_and_cart_by_dow,
        q19_department_contribution,
        q20_reorder_by_department_dow,
        q21_product_rank_in_department,
        q22_top_users,
        q23_cart_position_funnel,
        q24_department_aisle_flow,
        q25_department_scorecard,
        q26_interval_segments,
        q27_new_vs_returning_by_dow,
        q28_top_aisles_per_department,
        q29_user_frequency_cohorts,
        q30_reorder_by_hour,
    )
}

# Dashboard sections in display order.
SECTIONS: dict[str, list[str]] = {
    "kpi_overview": [
        "q01_total_unique_orders",
        "q02_total_unique_users",
        "q03_total_products_sold",
        "q04_overall_reorder_rate",
        "q05_avg_products_per_order",
    ],
    "product_category": [
        "q25_department_scorecard",
        "q06_top_products",
        "q07_top_products_by_reorder_rate",
        "q10_department_share",
        "q19_department_contribution",
        "q28_top_aisles_per_department",
        "q24_department_aisle_flow",
        "q21_product_rank_in_department",
    ],
    "user_behavior": [
        "q29_user_frequency_cohorts",
        "q15_user_frequency_vs_basket",
        "q26_interval_segments",
        "q16_reorder_by_order_number",
        "q17_orders_by_days_since_prior",
        "q22_top_users",
    ],
    "time_patterns": [
        "q18_orders_and_cart_by_dow",
        "q12_orders_by_dow",
        "q27_new_vs_returning_by_dow",
        "q11_orders_by_hour",
        "q30_reorder_by_hour",
    ],
    "cart_deep_dive": [
        "q23_cart_position_funnel",
        "q13_order_size_distribution",
        "q14_volume_vs_reorder",
        "q20_reorder_by_department_dow",
    ],
}


def write_dashboard(fact: DataFrame, out: str, sections: list[str] | None = None) -> dict[str, str]:
    """Write every query of the chosen sections to ``out/<section>/<query>``; returns query -> path."""
    written = {}
    for section in sections or SECTIONS:
        for name in SECTIONS[section]:
            written[name] = f"{out}/{section}/{name}"
            QUERIES[name](fact).write.mode("overwrite").parquet(written[name])
    return written
