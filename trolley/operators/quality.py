"""Checks on a loaded table: column profile, duplicate keys, order consistency, latest rows."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.schema import CLUSTER_KEYS, DEDUP_KEYS, NULLABLE_COLUMN, ORDER_FIELDS, OUTPUT_COLUMNS, VALUE_RANGES

INTEGERS = ("tinyint", "smallint", "int", "bigint")
BITMAP_BITS = 32_768  # of Spark's bitmaps, 4 kB

# Expressions are text: a profile has some hundred of them, and each call of a column function is a round trip to the JVM.


def _type_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def _outside(name: str) -> str:
    low, high = VALUE_RANGES.get(name, (None, None))
    return "false" if low is None else f"coalesce(`{name}` NOT BETWEEN {low} AND {high}, false)"


def _profile_column(df: DataFrame, name: str) -> DataFrame:
    values = df.groupBy(name).agg(F.count(F.lit(1)).alias("_rows"))
    return values.selectExpr(
        f"'{name}' AS column_name",
        f"'{_type_of(df, name)}' AS data_type",
        "coalesce(sum(_rows), 0) AS row_count",
        f"coalesce(sum(_rows) FILTER (WHERE `{name}` IS NULL), 0) AS null_count",
        f"coalesce(sum(_rows) FILTER (WHERE `{name}` IS NULL AND {name != NULLABLE_COLUMN}), 0) AS null_violations",
        f"count(`{name}`) AS distinct_count",
        f"CAST(min(`{name}`) AS string) AS min_value",
        f"CAST(max(`{name}`) AS string) AS max_value",
        f"coalesce(sum(_rows) FILTER (WHERE {_outside(name)}), 0) AS out_of_range",
    )


def narrow_columns(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Integer columns whose values span at most BITMAP_BITS, and the smallest value of each. One scan of the integer
    columns, a row from each task."""
    integers = [c for c in columns if _type_of(df, c) in INTEGERS]
    if not integers:
        return {}
    found = df.selectExpr(*[f"{f}(`{c}`) AS {f}_{c}" for c in integers for f in ("min", "max")]).first()
    ends = {c: (found[f"min_{c}"], found[f"max_{c}"]) for c in integers}
    return {c: low for c, (low, high) in ends.items() if low is not None and high - low < BITMAP_BITS}


def _profile_narrow(df: DataFrame, lows: dict[str, int]) -> DataFrame:
    """The profile of columns whose distinct values fit a bitmap from their smallest one on: one scan for all of them."""
    measures, lines = ["count(1) AS _rows"], []
    for name, low in lows.items():
        # Positions count from 1.
        bits = f"bitmap_construct_agg(bitmap_bit_position(CAST(`{name}` AS bigint) - {low} + 1))"
        measures += [
            f"count(`{name}`) AS n_{name}",
            f"min(`{name}`) AS min_{name}",
            f"max(`{name}`) AS max_{name}",
            f"bitmap_count({bits}) AS distinct_{name}",
            f"count_if({_outside(name)}) AS outside_{name}",
        ]
        as_seen = f"min_{name} <=> {low} AND max_{name} - {low} < {BITMAP_BITS}"
        fields = {
            "column_name": f"'{name}'",
            "data_type": f"'{_type_of(df, name)}'",
            "row_count": "_rows",
            "null_count": f"_rows - n_{name}",
            "null_violations": f"_rows - n_{name}" if name != NULLABLE_COLUMN else "0L",
            "distinct_count": f"CASE WHEN {as_seen} THEN distinct_{name} ELSE raise_error('the table has changed') END",
            "min_value": f"CAST(min_{name} AS string)",
            "max_value": f"CAST(max_{name} AS string)",
            "out_of_range": f"outside_{name}",
        }
        lines.append(f"named_struct({', '.join(f"'{field}', {value}" for field, value in fields.items())})")
    return df.selectExpr(*measures).selectExpr(f"inline(array({', '.join(lines)}))")


def table_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: type, rows, nulls, nulls where none may be, distinct values, extremes and range violations,
    all exact.

    Integer columns whose values lie close together share one scan, their distinct values in bitmaps that the map tasks
    merge; which ones do, a scan for their extremes tells (Spark answers it from file footers where the session pushes
    aggregates down). Every other column is its own single-column scan. One aggregate over all of them would multiply
    every row by the number of distinct counts before the shuffle; this way low-cardinality columns collapse inside the
    map tasks.
    """
    columns = columns or [c for c in OUTPUT_COLUMNS if c in df.columns]
    lows = narrow_columns(df, columns)
    parts = [_profile_column(df, c) for c in columns if c not in lows]
    return reduce(DataFrame.unionByName, [*parts, *([_profile_narrow(df, lows)] if lows else [])])


def consistency_check(df: DataFrame) -> DataFrame:
    """One row per check: keys that occur more than once, and orders whose order columns disagree."""
    count = F.count(F.lit(1))
    repeated = df.groupBy(*DEDUP_KEYS).agg(count.alias("_n")).where("_n > 1")
    mixed = df.select(*ORDER_FIELDS).distinct().groupBy("order_id").agg(count.alias("_n")).where("_n > 1")
    found = [
        bad.agg(F.lit(name).alias("check_name"), count.alias("violations"))
        for name, bad in (("duplicate_keys", repeated), ("inconsistent_orders", mixed))
    ]
    return reduce(DataFrame.unionByName, found)


def orders_are_consistent(df: DataFrame) -> bool:
    """Whether ``order_id`` determines every order column, the condition for using the order-grain mart."""
    versions = df.select(*ORDER_FIELDS).distinct().groupBy("order_id").agg(F.count(F.lit(1)).alias("_n"))
    return versions.where("_n > 1").isEmpty()


def latest_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most recently loaded rows, seven columns; key order settles ties."""
    shown = ["order_id", "user_id", "product_id", "product_name", "department", "reordered", "ingested_at"]
    newest = df.orderBy(F.desc("ingested_at"), *CLUSTER_KEYS, "add_to_cart_order").limit(n)
    return newest.select(*shown)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))
