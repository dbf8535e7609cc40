"""Typing, null-key rejection and deduplication of staged rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.operators.skew import HOT_KEY_ROWS, find_hot_keys, split_by_hot
from trolley.schema import CLEAN_TYPES, DEDUP_KEYS, INGESTED_AT_FORMAT, KEY_COLUMNS, OUTPUT_COLUMNS
from trolley.workspace import workspace


def _typed(df: DataFrame, name: str, to: str) -> Column:
    col = F.col(name)
    if to == "string" or not isinstance(df.schema[name].dataType, T.StringType):
        return col.try_cast(to).alias(name)
    # Staged text may read 7.0 or 12.7: go through double so that it truncates instead of becoming NULL.
    through_double = col.try_cast("double").try_cast(to)
    if to == "bigint":
        return F.coalesce(col.try_cast("bigint"), through_double).alias(name)
    return through_double.alias(name)


def type_columns(df: DataFrame, types: dict[str, str] = CLEAN_TYPES) -> DataFrame:
    """Project to the 15 typed columns; what does not fit its type becomes NULL."""
    return df.select(*[_typed(df, name, to) for name, to in types.items()])


def drop_null_keys(df: DataFrame) -> DataFrame:
    return df.dropna(how="any", subset=KEY_COLUMNS)


def deduplicate(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the smallest of the remaining columns, compared left to right, nulls first.

    An aggregate rather than a ranked window: copies collapse inside each map task, so a key that holds a third of
    the rows sends one row per task through the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    survivor = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return survivor.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def stamp(df: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Add the load time (second precision) and fix the output column order."""
    at = F.current_timestamp() if ingested_at is None else ingested_at
    return df.withColumn("ingested_at", F.date_trunc("second", at)).select(*OUTPUT_COLUMNS)


def clean_orders(raw: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    return stamp(deduplicate(drop_null_keys(type_columns(raw)), DEDUP_KEYS), ingested_at)


def clean_orders_by_order(
    raw: DataFrame, ingested_at: Column | None = None, parts: int | None = None, hot_rows: int = HOT_KEY_ROWS
) -> tuple[DataFrame, bool]:
    """What ``clean_orders`` returns, for rows about to be written, and whether all of it is dealt out by order (into
    ``parts``, where given): yes, unless an order is hot.

    The lines of an order stay together, and their order columns repeat next to each other in the shuffle and in the
    files; no map task sorts its rows to find copies. Orders of more than ``hot_rows`` rows, copies included, take the
    aggregate over the whole key, in which copies collapse before the shuffle. Reads the order ids a first time.
    """
    typed = drop_null_keys(type_columns(raw))
    hot = find_hot_keys(typed, "order_id", workspace(raw.sparkSession), hot_rows)
    cold, large = (typed, None) if hot is None else split_by_hot(typed, "order_id", hot)
    dealt = cold.repartition("order_id") if parts is None else cold.repartition(parts, "order_id")
    rows = deduplicate(dealt, DEDUP_KEYS)
    if large is not None:
        rows = rows.unionByName(deduplicate(large, DEDUP_KEYS))
    return stamp(rows, ingested_at), large is None


def reject_report(raw: DataFrame) -> DataFrame:
    """How many rows cleaning drops, by the first key column that is missing or does not fit its type."""
    typed = type_columns(raw)
    reason = F.coalesce(*[F.when(F.col(k).isNull(), F.lit(k)) for k in KEY_COLUMNS])
    return (
        typed.select(reason.alias("reject_reason"))
        .where(F.col("reject_reason").isNotNull())
        .groupBy("reject_reason")
        .agg(F.count(F.lit(1)).alias("rejected_rows"))
    )


def format_for_sink(clean: DataFrame) -> DataFrame:
    """The 16 columns with the load time as text, the form an external table takes."""
    at = F.date_format(F.to_timestamp("ingested_at"), INGESTED_AT_FORMAT)
    return clean.select(*OUTPUT_COLUMNS[:-1], at.alias("ingested_at"))
