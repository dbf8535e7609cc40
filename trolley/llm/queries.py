"""One query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.llm import (
    chosen_path,
    collocations,
    decontaminate,
    infill,
    language,
    licenses,
    mixing,
    quality,
    search,
    secrets,
    sharding,
    simhash,
    tokens,
)
from trolley.llm.common import crc32_text, table
from trolley.workspace import workspace


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256")
    return checked.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def op2_tokens(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """``tokenizer``: path of the vocabulary file; by default that of the installed public one."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    out = workspace(spark).fresh("token-files")
    tokens.write_tokens(table(spark, sf_dir, "documents"), tokenizer, out)
    return tokens.read_tokens(spark, out, with_ids=False)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.array_join(F.col("sentence_ids").cast("array<string>"), ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
    )


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search(table(spark, sf_dir, "documents"), F.col("doc_id") % 20 == 0)
    return found.select("query_id", "rank", "doc_id", F.round("score", 6).alias("score"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.array(*map(F.lit, (secrets.ASSIGN, secrets.ACCESS, secrets.HEX)))

    def number(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    own = F.filter("secrets", lambda s: F.array_contains(base, s["kind"]))
    return found.select(
        "doc_id",
        number(secrets.ASSIGN).alias("n_assign"),
        number(secrets.ACCESS).alias("n_access"),
        number(secrets.HEX).alias("n_hex"),
        F.sha2(joined(own).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        crc32_text(F.col("text")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return grouped.select("doc_id", simhash.hex_digits("print").alias("fingerprint"), "component_id")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = infill.transform(table(spark, sf_dir, "documents"))
    text = infill.restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(text.cast("binary"), 256).alias("restored_sha256"),
    )


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_tokens": op2_tokens,
    "op3_language": op3_language,
    "op4_licenses": op4_licenses,
    "op5_mix": op5_mix,
    "op6_search": op6_search,
    "op7_secrets": op7_secrets,
    "op8_shards": op8_shards,
    "op9_quality": op9_quality,
    "op10_simhash": op10_simhash,
    "op11_collocations": op11_collocations,
    "op12_infill": op12_infill,
    "op13_minhash": op13_minhash,
}
