"""What the operators of this subpackage share: table access, text normalisation, ordered prefix sums."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trolley.workspace import workspace

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. ``lower`` does just that to a text of ASCII alone, and is much faster."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def crc32_text(text: Column) -> Column:
    """Unsigned crc32 of the UTF-8 bytes; a null text counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def row_key() -> Column:
    """A document row's identity: id and digest of the text. Null and empty text share a digest; a null id is no id."""
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    return F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), digest)


def doc_id_fold(n: int) -> Column:
    """Fold of a document: crc32 of its id as text, modulo ``n``. A null id has fold 0, the crc32 of nothing."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by a table in the shared folder: what is read again later outlives any executor."""
    return workspace(df.sparkSession).materialise(df, name)


def before_each(df: DataFrame, order: list[Column], amount: Column, name: str, parts: int | None = None) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over all rows before this one in the given total order.

    Rows are range-partitioned, so each task sums a stretch of the order, and the stretches' totals (one row per
    task) are summed up to shift them. ``df`` should be a table in files: the sort keys are sampled first.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = {f"_key{i}": key for i, key in enumerate(order)}
    ranged = df.withColumns(keys).withColumn("_amount", amount).repartitionByRange(parts, *keys)
    # The stretch numbers must be the same for the totals and for the rows, so they are written once.
    ranged = materialise(ranged.withColumn("_part", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("_part").agg(F.sum("_amount").alias("_total"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_shift"))
    within = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("_within", F.coalesce(F.sum("_amount").over(within), F.lit(0)))
    # One row per task of the range partitioning: safe to broadcast.
    joined = summed.join(F.broadcast(shifts), "_part")
    return joined.withColumn(name, F.col("_within") + F.col("_shift")).select(*df.columns, name)
