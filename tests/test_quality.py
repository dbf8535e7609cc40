"""Profile, consistency, latest rows, row count."""

from pyspark.sql import functions as F
from test_dashboard import make

from trolley.operators import quality
from trolley.operators.quality import consistency_check, latest_rows, orders_are_consistent, row_count, table_profile


def test_profile_flags_range_violations(spark):
    fact = make(spark, [{"order_dow": 7}, {"order_dow": None}, {"order_dow": 3, "order_hour_of_day": 24}, {"reordered": 2}])
    found = {r.column_name: r for r in table_profile(fact).collect()}
    assert len(found) == 15
    assert (found["order_dow"].out_of_range, found["order_dow"].null_count, found["order_dow"].distinct_count) == (1, 1, 3)
    assert found["order_hour_of_day"].out_of_range == 1 and found["reordered"].out_of_range == 1
    assert found["days_since_prior_order"].null_count == 4
    assert (found["order_hour_of_day"].min_value, found["order_hour_of_day"].max_value) == ("0", "24")


def test_profile_of_an_empty_table(spark):
    row = table_profile(make(spark, [{}]).limit(0), ["order_dow"]).first()
    assert tuple(row) == ("order_dow", "bigint", 0, 0, 0, 0, None, None, 0)


def test_profile_by_bitmap_equals_profile_by_groups(spark):
    """Negative values, nulls, a span of exactly one bitmap, and spans and values beyond it."""
    fact = make(spark, [
        {"order_id": -(2**63), "order_number": -5, "product_id": 7, "user_id": 1, "add_to_cart_order": None},
        {"order_id": 2**63 - 1, "order_number": -5 + 32_767, "product_id": 7, "user_id": 32_769, "order_dow": 9},
        {"order_id": 0, "order_number": 0, "product_id": None, "user_id": 5, "order_dow": None},
    ])
    narrow = quality.narrow_columns(fact, fact.columns)
    assert narrow["order_number"] == -5 and narrow["product_id"] == 7
    assert not {"order_id", "user_id", "days_since_prior_order", "product_name"} & narrow.keys()
    by_groups = [quality._profile_column(fact, c).first() for c in fact.columns]
    assert sorted(map(tuple, table_profile(fact, fact.columns).collect())) == sorted(map(tuple, by_groups))


def test_profile_scans_narrow_columns_once(spark):
    """No shuffle by value for them: one exchange, of a row from each task."""
    fact = make(spark, [{}, {"order_dow": 3}])
    profile = table_profile(fact, ["order_dow", "order_hour_of_day", "reordered", "product_id"])
    text = profile._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "hashpartitioning" not in text


def test_consistency(spark):
    clean = make(spark, [{"order_id": 1}, {"order_id": 2}])
    assert orders_are_consistent(clean)
    bad = make(spark, [{"order_id": 1}, {"order_id": 1}, {"order_id": 2, "order_dow": 1},
                       {"order_id": 2, "order_dow": 2, "product_id": 5}])
    assert not orders_are_consistent(bad)
    assert {r.check_name: r.violations for r in consistency_check(bad).collect()} == {
        "duplicate_keys": 1, "inconsistent_orders": 1
    }


def test_null_and_value_disagree(spark):
    assert not orders_are_consistent(make(spark, [{}, {"days_since_prior_order": 3}]))


def test_latest_rows(spark):
    fact = make(spark, [{"order_id": i} for i in range(20)])
    stamped = fact.withColumn("ingested_at", F.timestamp_seconds(F.col("order_id") % 4))
    assert [r.order_id for r in latest_rows(stamped, 7).collect()] == [3, 7, 11, 15, 19, 2, 6]
    assert row_count(stamped).first().total_rows == 20
