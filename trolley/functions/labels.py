"""Chart labels and bucket boundaries of a named column. Texts and edges are fixed values of the dashboard."""

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_NAMES = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
CART_BUCKET_WIDTH = 5


def day_name(dow: str) -> Column:
    """Name of weekday 0..6; an out-of-range or missing weekday gives the empty string."""
    names = ", ".join(f"'{name}'" for name in DAY_NAMES)
    position = f"CAST({dow} AS INT) + 1"
    return F.expr(f"IF({dow} BETWEEN 0 AND {len(DAY_NAMES) - 1}, element_at(array({names}), {position}), '')")


def cart_bucket_start(n_items: str) -> Column:
    return F.expr(f"({n_items} - 1) div {CART_BUCKET_WIDTH} * {CART_BUCKET_WIDTH} + 1")


def cart_bucket_label(start: str) -> Column:
    return F.expr(f"concat({start}, '-', {start} + {CART_BUCKET_WIDTH - 1})")


def cart_step(position: str) -> Column:
    return F.expr(f"concat('Item ', {position})")


def interval_segment(days: str) -> Column:
    days = F.col(days)
    return (
        F.when(days < 7, "< 7 days")
        .when(days < 15, "7-14 days")
        .when(days < 22, "15-21 days")
        .otherwise("> 21 days")
    )


def frequency_bucket(orders: str) -> Column:
    orders = F.col(orders)
    return (
        F.when(orders == 1, "1 order")
        .when(orders <= 5, "2-5 orders")
        .when(orders <= 10, "6-10 orders")
        .otherwise("> 10 orders")
    )
