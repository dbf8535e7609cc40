"""Dashboard queries on small literal facts: edges, ties, empty input, filters, mart."""

import random

import pytest
from rowsets import rows

from trolley.functions.labels import day_name
from trolley.operators.filters import apply_filters, valid_orders
from trolley.operators.ranking import rank_by_value
from trolley.plans import dashboard
from trolley.plans.mart import MART_QUERIES, InconsistentOrders, order_mart
from trolley.schema import LANDED_SCHEMA, ORDER_COLUMNS
from pyspark.sql import Window
from pyspark.sql import functions as F

DEFAULTS = dict(order_id=1, user_id=1, order_number=1, order_dow=0, order_hour_of_day=0, days_since_prior_order=None,
                eval_set="prior", product_id=1, product_name="p", aisle_id=1, aisle="a", department_id=1,
                department="d", add_to_cart_order=1, reordered=0)


def make(spark, items):
    return spark.createDataFrame([tuple({**DEFAULTS, **i}[c] for c in ORDER_COLUMNS) for i in items], LANDED_SCHEMA)


@pytest.mark.parametrize("name", sorted(dashboard.QUERIES))
def test_empty_fact(spark, name):
    result = dashboard.QUERIES[name](make(spark, [{}]).limit(0)).collect()
    assert len(result) == (1 if name[:3] in ("q01", "q02", "q03", "q04", "q05") else 0)
    if name.startswith(("q04", "q05")):
        assert result[0][0] is None


def test_cart_buckets(spark):
    sizes = {1: 1, 2: 5, 3: 6, 4: 10, 5: 11}
    fact = make(spark, [{"order_id": o, "add_to_cart_order": i} for o, n in sizes.items() for i in range(n)])
    result = [tuple(r) for r in dashboard.q13_order_size_distribution(fact).collect()]
    assert result == [("1-5", 2), ("6-10", 2), ("11-15", 1)]


def test_interval_edges(spark):
    days = [0, 6, 7, 14, 15, 21, 22, None]
    fact = make(spark, [{"order_id": i, "days_since_prior_order": d} for i, d in enumerate(days)])
    result = [(r[0], r[1]) for r in dashboard.q26_interval_segments(fact).collect()]
    assert result == [("< 7 days", 2), ("7-14 days", 2), ("15-21 days", 2), ("> 21 days", 1)]


def test_frequency_edges(spark):
    fact = make(spark, [{"user_id": n, "order_id": n * 100 + i} for n in (1, 2, 5, 6, 10, 11) for i in range(n)])
    result = [(r[0], r[1]) for r in dashboard.q29_user_frequency_cohorts(fact).collect()]
    assert result == [("1 order", 1), ("2-5 orders", 2), ("6-10 orders", 2), ("> 10 orders", 1)]


def test_aisle_ties_keep_all_at_the_cut(spark):
    counts = {"a": 5, "b": 5, "c": 3, "e": 3, "f": 1}
    fact = make(spark, [{"aisle": a} for a, n in counts.items() for _ in range(n)])
    result = [(r.aisle, r.rank_in_department) for r in dashboard.q28_top_aisles_per_department(fact).collect()]
    assert result == [("a", 1), ("b", 1), ("c", 3), ("e", 3)]


def test_weekday_without_rows_is_null(spark):
    fact = make(spark, [{"order_dow": 1, "reordered": 1}, {"order_dow": 1}, {"order_dow": 2}])
    row = dashboard.q20_reorder_by_department_dow(fact).first()
    assert (row.sun_reorder_rate_pct, row.mon_reorder_rate_pct, row.tue_reorder_rate_pct) == (None, 50.0, 0.0)


def test_day_names(spark):
    dows = spark.createDataFrame([(d,) for d in (-1, 0, 6, 7)], "d tinyint")
    assert [r[0] for r in dows.select(day_name("d")).collect()] == ["", "Sun", "Sat", ""]
    assert dashboard.q12_orders_by_dow(make(spark, [{"order_dow": 9}])).first().day_name == ""


def test_funnel_stops_at_ten(spark):
    fact = make(spark, [{"order_id": o, "add_to_cart_order": i} for o in (1, 2) for i in range(1, 13)])
    result = dashboard.q23_cart_position_funnel(fact).collect()
    assert [tuple(r) for r in result] == [(f"Item {i}", 2) for i in range(1, 11)]


def test_thresholds(spark):
    fact = make(spark, [{"product_id": p, "reordered": 1} for p, n in ((1, 5), (2, 4), (3, 3), (4, 2)) for _ in range(n)])
    assert [r.total_items_sold for r in dashboard.q07_top_products_by_reorder_rate(fact).collect()] == [5]
    assert sorted(r.total_items_sold for r in dashboard.q14_volume_vs_reorder(fact).collect()) == [3, 4, 5]


def test_null_groups_stay(spark):
    fact = make(spark, [{"department": None, "aisle": None}, {"department": "d"}, {"department": None}])
    assert [tuple(r) for r in dashboard.q10_department_share(fact).collect()] == [(None, 2), ("d", 1)]
    assert {r.department: r.unique_products for r in dashboard.q25_department_scorecard(fact).collect()} == {
        None: 1, "d": 1
    }
    ranks = dashboard.q21_product_rank_in_department(fact).collect()
    assert {r.department: r.rank_within_department for r in ranks} == {None: 1, "d": 1}


@pytest.mark.parametrize("seed", range(4))
def test_rank_by_value_is_rank(spark, seed):
    """Ties run over many stretches of the order, and over whole ones."""
    rng = random.Random(seed)
    few = 1 + 3 * seed
    df = spark.createDataFrame(
        [(rng.choice("ab") if i % 9 else None, rng.randint(1, few) if i % 11 else None, i) for i in range(300)],
        "g string, v long, i int",
    )
    window = Window.partitionBy("g").orderBy(F.desc("v"))
    expected = df.withColumn("r", F.rank().over(window).cast("bigint"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert rows(rank_by_value(df, "g", "v", "i", "r")) == rows(expected)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _random_fact(spark, seed, consistent=True):
    rng = random.Random(seed)
    items = []
    for order in range(60):
        base = dict(order_id=order, user_id=rng.randint(1, 8), order_number=rng.randint(1, 9), order_dow=rng.randint(0, 6),
                    order_hour_of_day=rng.randint(0, 23), days_since_prior_order=rng.choice([None, 0, 6, 7, 30]))
        for position in range(1, rng.randint(2, 14)):
            if not consistent:
                base["order_dow"] = rng.randint(0, 6)
            product = rng.randint(1, 20)
            items.append({**base, "product_id": product, "product_name": f"p{product}", "aisle": f"a{product % 7}",
                          "department": f"d{product % 3}", "add_to_cart_order": position,
                          "reordered": rng.randint(0, 1)})
    return make(spark, items)


@pytest.mark.parametrize("seed", range(2))
def test_totals_agree_between_queries(spark, seed):
    fact = _random_fact(spark, seed)
    q = {name[:3]: query for name, query in dashboard.QUERIES.items()}
    total = q["q03"](fact).first()[0]
    assert sum(r.total_items_sold for r in q["q10"](fact).collect()) == total
    assert sum(r.total_items_sold for r in q["q24"](fact).collect()) == total
    assert sum(r.total_orders for r in q["q13"](fact).collect()) == q["q01"](fact).first()[0]
    assert sum(r.total_users for r in q["q29"](fact).collect()) == q["q02"](fact).first()[0]
    for r in q["q27"](fact).collect():
        assert abs(r.avg_pct_new + r.avg_pct_returning - 100) <= 0.02
    steps = [r.orders_reaching_step for r in q["q23"](fact).collect()]
    assert steps == sorted(steps, reverse=True)


@pytest.mark.parametrize("seed", range(2))
def test_mart_equals_rows(spark, seed):
    fact = _random_fact(spark, seed)
    mart = order_mart(fact)
    for name, query in MART_QUERIES.items():
        expected = dashboard.QUERIES[name](fact)
        result = query(mart)
        assert result.columns == expected.columns, name
        assert [tuple(r) for r in result.collect()] == [tuple(r) for r in expected.collect()], name


def test_mart_refuses_inconsistent_orders(spark):
    fact = _random_fact(spark, 0, consistent=False)
    with pytest.raises(InconsistentOrders):
        order_mart(fact)
    assert order_mart(fact, verify=False).count() > 60


def test_filters(spark):
    fact = make(spark, [{"department": d, "order_hour_of_day": h, "order_dow": w, "reordered": r}
                        for d in "xyz" for h in (1, 2) for w in (0, 5) for r in (0, 1)])
    assert apply_filters(fact).count() == 24
    assert apply_filters(fact, departments=["x", "y"]).count() == 16
    assert apply_filters(fact, hours=[2], dows=[5], reordered=1).count() == 3
    assert apply_filters(fact, departments=[]).count() == 0


def test_valid_orders(spark):
    fact = make(spark, [{}, {"order_id": 0}, {"user_id": 0}, {"product_id": 0}, {"product_name": ""}, {"product_name": None}])
    assert valid_orders(fact).count() == 1


def test_sections_cover_the_dashboard():
    shown = [name for names in dashboard.SECTIONS.values() for name in names]
    assert len(shown) == len(set(shown)) == 28
    assert {n[:3] for n in set(dashboard.QUERIES) - set(shown)} == {"q08", "q09"}


def test_write_dashboard(spark, tmp_path):
    fact = _random_fact(spark, 1)
    written = dashboard.write_dashboard(fact, str(tmp_path), ["kpi_overview", "time_patterns"])
    assert len(written) == 10
    for name, path in written.items():
        assert rows(spark.read.parquet(path)) == rows(dashboard.QUERIES[name](fact))
