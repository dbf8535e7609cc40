"""Nested order payloads."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from trolley.schema import NESTED_SCHEMA

CORRUPT = "corrupt_payload"


def _whole(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """Declared fields and, where a payload cannot be parsed, its text."""
    schema = StructType([*StructType.fromDDL(NESTED_SCHEMA).fields]).add(CORRUPT, StringType())
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("multiLine", multi_line).json(path)


def read_payloads(spark: SparkSession, path: str, multi_line: bool = False, keep_corrupt: bool = False) -> DataFrame:
    """JSON payloads with the declared schema; absent fields read as NULL.

    One payload per line splits across tasks and is the form to use for volume. ``multi_line`` reads files that
    hold one pretty-printed payload each, at one task per file.

    A payload that cannot be parsed, cut short for instance, yields no orders. ``keep_corrupt`` adds its text as
    ``corrupt_payload`` (else NULL), for callers that count it.
    """
    if not keep_corrupt:
        return spark.read.schema(NESTED_SCHEMA).option("multiLine", multi_line).json(path)
    read = _whole(spark, path, multi_line)
    # Fields before the fault may have been filled: such a payload is rejected whole.
    fields = [F.when(F.col(CORRUPT).isNull(), F.col(c)).alias(c) for c in read.columns if c != CORRUPT]
    return read.select(*fields, CORRUPT)


def payload_rejects(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """``payload`` (its text), ``declared_orders`` (where that could still be read) and ``file`` of every payload that
    cannot be parsed."""
    rejected = _whole(spark, path, multi_line).where(F.col(CORRUPT).isNotNull())
    return rejected.select(
        F.col(CORRUPT).alias("payload"), F.col("total_orders").alias("declared_orders"), F.input_file_name().alias("file")
    )


def parse_payloads(df: DataFrame, text: Column) -> DataFrame:
    """Payloads that arrive as a text column, such as a message body."""
    return df.select(F.from_json(text, NESTED_SCHEMA).alias("_p")).select("_p.*")
