"""Training-data pipeline over ``documents``: quality, near-dedup, decontamination, mixing, sharding.

Each stage takes what its predecessor kept, written as Parquet and read again. All but the last return the columns of
documents. The classifier is trained in numpy, so SQL cannot express the whole: ORACLE_SQL is None, and the tests
hold every stage against a brute-force version.

Nulls, empty and very long texts, ties, repeated rows and empty tables: as the stages' operators document. Extra columns
of the input are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.llm import decontaminate, mixing, quality, sharding, simhash
from trolley.llm.common import DOCUMENT_COLUMNS, materialise, table

ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    scored = quality.score_documents(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(*DOCUMENT_COLUMNS)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id."""
    return simhash.deduplicate(docs.select(*DOCUMENT_COLUMNS))


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth lies in benchmark windows."""
    return decontaminate.decontaminate(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; the one on which a source's cut falls is rounded to a whole one."""
    mixed = mixing.mix(docs.select(*DOCUMENT_COLUMNS))
    copies = F.coalesce(F.round(F.try_divide("taken", "size")), F.lit(0)).cast("int")
    return mixed.where(copies > 0).select(*DOCUMENT_COLUMNS, F.explode(F.sequence(F.lit(1), copies))).drop("col")


def into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and their position in it."""
    return sharding.shard(docs.select(*DOCUMENT_COLUMNS))


STAGES = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", keep_distinct),
    ("benchmark decontamination", keep_uncontaminated),
    ("mixing sources to target weights", mix_sources),
    ("sharding", into_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{k}")
    return docs
