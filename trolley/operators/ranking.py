"""Ranks over few, large partitions."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.workspace import workspace


def rank_by_value(df: DataFrame, group: str, value: str, tie: str, rank: str) -> DataFrame:
    """``rank() over (partition by group order by value desc)`` without sorting a whole group in one task.

    Rows are range-sorted by group, value and ``tie`` (unique within equal values), so that a group, and the rows of one
    value, spread over as many tasks as they need. Each stretch of the order ranks its own rows; what lies before it in
    the group comes from the stretches' totals, a row for each stretch and group in it. Where a value goes on from the
    stretch before, its rows carry on the rank it had there. ``df`` is evaluated once, into a table.
    """
    keys = [F.asc_nulls_first(group), F.desc_nulls_last(value), F.asc(tie)]
    placed = df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id())
    placed = workspace(df.sparkSession).materialise(placed, "ranked")

    stretch = placed.groupBy("_part", group, value).agg(F.count(F.lit(1)).alias("_n"))
    # Of each stretch and group: its rows, its first value and its last value with the rows that have it.
    totals = stretch.groupBy("_part", group).agg(
        F.sum("_n").alias("_rows"), F.max(value).alias("_first"), F.min(F.struct(value, "_n")).alias("_last")
    )
    in_order = Window.partitionBy(group).orderBy("_part")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    # Rows of the last value so far: those of earlier stretches count as long as that value goes on.
    of_value = Window.partitionBy(group, F.col("_last")[value]).orderBy("_part")
    carried = totals.withColumn("_tied", F.sum("_last._n").over(of_value))
    offsets = carried.select(
        F.col("_part").alias("_p"),
        F.col(group).alias("_g"),
        "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.when(F.lag(F.col("_last")[value]).over(in_order).eqNullSafe(F.col("_first")), F.lag("_tied").over(in_order))
        .otherwise(0)
        .alias("_goes_on"),
    )
    own = F.rank().over(Window.partitionBy("_part", group).orderBy(F.desc_nulls_last(value)))
    same = (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g"))
    ranked = placed.withColumn("_own", own).join(offsets, same)
    goes_on = F.when(F.col(value).eqNullSafe(F.col("_first")), F.coalesce("_goes_on", F.lit(0))).otherwise(0)
    return ranked.select(*df.columns, (F.col("_own") + F.col("_before") - goes_on).cast("bigint").alias(rank))
