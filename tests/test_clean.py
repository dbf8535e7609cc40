"""Typing, null-key rejection, deduplication and the reject report."""

import random

import pytest
from rowsets import rows
from pyspark.sql import functions as F

from trolley.operators.clean import (
    clean_orders,
    clean_orders_by_order,
    deduplicate,
    drop_null_keys,
    format_for_sink,
    reject_report,
    type_columns,
)
from trolley.schema import CLEAN_TYPES, DEDUP_KEYS, KEY_COLUMNS, ORDER_COLUMNS, OUTPUT_COLUMNS, TEXT_SCHEMA

GOOD = dict(order_id="1", user_id="2", order_number="3", order_dow="4", order_hour_of_day="5",
            days_since_prior_order="7.0", eval_set="prior", product_id="10", product_name="milk", aisle_id="3",
            aisle="dairy", department_id="1", department="fresh", add_to_cart_order="1", reordered="0")


def feed(spark, *changes):
    return spark.createDataFrame([tuple({**GOOD, **c}[k] for k in ORDER_COLUMNS) for c in changes], TEXT_SCHEMA)


@pytest.mark.parametrize(
    "column, text, value",
    [
        ("days_since_prior_order", "7.0", 7),
        ("days_since_prior_order", None, None),
        ("order_hour_of_day", "12.7", 12),
        ("order_number", "70000", 70000),
        ("order_number", "99999999999999999999", None),
        ("aisle_id", "65535", 65535),
        ("order_dow", "300", None),
        ("reordered", "x", None),
        ("reordered", "", None),
        ("user_id", " 8 ", 8),
        ("user_id", "-3.9", -3),
        ("order_id", "9007199254740993", 9007199254740993),
        ("order_id", "NaN", None),
        ("order_id", "1e30", None),
    ],
)
def test_text_to_type(spark, column, text, value):
    typed = type_columns(feed(spark, {column: text}))
    assert dict(typed.dtypes) == CLEAN_TYPES
    assert typed.first()[column] == value


def test_numbers_to_type(spark):
    wide = type_columns(feed(spark, {})).withColumns(
        {"order_number": F.lit(1e30), "days_since_prior_order": F.lit(7.9), "order_dow": F.lit(3)}
    )
    r = type_columns(wide).first()
    assert (r.order_number, r.days_since_prior_order, r.order_dow) == (None, 7, 3)


@pytest.mark.parametrize("key", KEY_COLUMNS)
def test_each_key_is_required(spark, key):
    df = feed(spark, {}, {key: None, "aisle": "other"})
    assert [r.aisle for r in drop_null_keys(type_columns(df)).collect()] == ["dairy"]
    assert rows(reject_report(df)) == [(key, 1)]


def test_other_columns_may_be_null(spark):
    others = [c for c in ORDER_COLUMNS if c not in KEY_COLUMNS]
    assert clean_orders(feed(spark, dict.fromkeys(others))).count() == 1


def test_first_missing_key_names_the_reject(spark):
    df = feed(spark, {"reordered": "x", "user_id": None}, {"reordered": "x"}, {})
    assert rows(reject_report(df)) == [("reordered", 1), ("user_id", 1)]


def test_survivor_is_the_smallest_row_whatever_the_input_order(spark):
    copies = [{"aisle": a, "user_id": u} for a in ("b", "a", None) for u in ("3", "2")]
    for seed in range(3):
        random.Random(seed).shuffle(copies)
        df = deduplicate(type_columns(feed(spark, *copies)), DEDUP_KEYS)
        assert [(r.user_id, r.aisle) for r in df.collect()] == [(2, None)]
        assert df.columns == ORDER_COLUMNS


def test_dedup_combines_before_the_shuffle(spark):
    hot = spark.range(0, 20000, 1, 4).select(F.lit(1).alias("k"), (F.col("id") % 5).alias("v"))
    plan = deduplicate(hot, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange")  # printed top-down: partial step below the exchange
    assert rows(deduplicate(hot, ["k"])) == [(1, 0)]


def test_clean_is_idempotent(spark, sf_dir, fact):
    from trolley.plans import retail

    once = clean_orders(retail.dirty_feed(fact))
    assert once.columns == OUTPUT_COLUMNS
    twice = clean_orders(once)
    assert rows(once.drop("ingested_at")) == rows(twice.drop("ingested_at"))


def test_load_time(spark):
    at = F.lit("2024-05-06 07:08:09.5").cast("timestamp")
    clean = clean_orders(feed(spark, {}), at)
    assert dict(clean.dtypes)["ingested_at"] == "timestamp"
    assert format_for_sink(clean).first().ingested_at == "2024-05-06 07:08:09"
    assert clean_orders(feed(spark, {})).where("ingested_at > current_timestamp() - interval 1 hour").count() == 1


def test_empty_feed(spark):
    empty = feed(spark, {}).limit(0)
    assert clean_orders(empty).count() == 0
    assert reject_report(empty).count() == 0


@pytest.mark.parametrize("hot_rows", [10**6, 3])
def test_cleaning_by_order_equals_cleaning(spark, fact, hot_rows):
    from trolley.plans import retail

    feed_rows = retail.dirty_feed(fact)
    cleaned, dealt = clean_orders_by_order(feed_rows, hot_rows=hot_rows)
    assert rows(cleaned.drop("ingested_at")) == rows(clean_orders(feed_rows).drop("ingested_at"))
    assert dealt == (hot_rows > 3)


def test_cleaning_by_order_shuffles_once_and_sorts_nothing_before(fact):
    from trolley.plans import retail

    cleaned, _ = clean_orders_by_order(retail.dirty_feed(fact))
    text = cleaned._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "hashpartitioning(order_id" in text
    assert "Sort" not in text[text.index("Exchange") :]
