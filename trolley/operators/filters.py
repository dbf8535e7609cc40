"""Row filters composed before a query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the validity rule of the serving view.
VALID_ORDER = "order_id > 0 AND user_id > 0 AND product_id > 0 AND product_name <> ''"


def valid_orders(fact: DataFrame) -> DataFrame:
    """The serving view's predicate; all four terms reach the Parquet scan."""
    return fact.where(VALID_ORDER)


def apply_filters(
    fact: DataFrame,
    departments: Sequence[str] | None = None,
    hours: Sequence[int] | None = None,
    dows: Sequence[int] | None = None,
    reordered: int | None = None,
) -> DataFrame:
    """Dashboard filters; ``None`` leaves a dimension open."""
    for column, chosen in (("department", departments), ("order_hour_of_day", hours), ("order_dow", dows)):
        if chosen is not None:
            fact = fact.where(F.col(column).isin(list(chosen)))
    if reordered is not None:
        fact = fact.where(F.col("reordered") == reordered)
    return fact
