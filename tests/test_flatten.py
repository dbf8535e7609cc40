"""Nested payloads to flat rows."""

import json

from rowsets import rows
from pyspark.sql import functions as F

from trolley.operators.flatten import flatten_orders, payload_metrics
from trolley.plans import retail
from trolley.schema import LANDED_TYPES, ORDER_COLUMNS
from trolley.sources.payloads import parse_payloads, read_payloads

PRODUCT = {"product_id": 10, "product_name": "milk", "aisle_id": 3, "aisle": "dairy", "department_id": 1,
           "department": "fresh", "add_to_cart_order": 1, "reordered": 0}
ORDER = {"order_id": 1, "user_id": 2, "order_number": 3, "order_dow": 4, "order_hour_of_day": 5,
         "days_since_prior_order": 7.0, "eval_set": "prior"}
PAYLOADS = [
    {"total_orders": 4, "orders": [
        {**ORDER, "products": [PRODUCT, {**PRODUCT, "product_id": 11, "add_to_cart_order": 2}]},
        {**ORDER, "order_id": 2, "products": None},
        {**ORDER, "order_id": 3, "products": []},
        {**ORDER, "order_id": 4},
    ]},
    {"total_orders": 1, "orders": [{"order_id": 5, "products": [{"product_id": 12}]}]},
    {"total_orders": 2},
    {"total_orders": 0, "orders": []},
]


def _write(path, payloads, indent=None):
    path.mkdir()
    if indent is None:
        (path / "payloads.json").write_text("\n".join(json.dumps(p) for p in payloads))
    else:
        for i, p in enumerate(payloads):
            (path / f"payload-{i}.json").write_text(json.dumps(p, indent=indent))
    return str(path)


def test_orders_without_products_give_no_rows(spark, tmp_path):
    flat = flatten_orders(read_payloads(spark, _write(tmp_path / "in", PAYLOADS)))
    assert flat.columns == ORDER_COLUMNS
    assert dict(flat.dtypes) == LANDED_TYPES
    assert sorted((r.order_id, r.product_id) for r in flat.collect()) == [(1, 10), (1, 11), (5, 12)]
    first = flat.where("product_id = 11").first()
    assert (first.user_id, first.days_since_prior_order, first.product_name) == (2, 7, "milk")
    sparse = flat.where("order_id = 5").first()
    assert sparse.user_id is None and sparse.product_name is None


def test_one_payload_per_file_and_text_column_read_the_same(spark, tmp_path):
    lines = read_payloads(spark, _write(tmp_path / "lines", PAYLOADS))
    files = read_payloads(spark, _write(tmp_path / "files", PAYLOADS, indent=2), multi_line=True)
    text = parse_payloads(spark.createDataFrame([(json.dumps(p),) for p in PAYLOADS], "body string"), F.col("body"))
    assert rows(flatten_orders(lines)) == rows(flatten_orders(files)) == rows(flatten_orders(text))


def test_metrics_compare_rows_with_declared_orders(spark, tmp_path):
    metrics = payload_metrics(read_payloads(spark, _write(tmp_path / "in", PAYLOADS))).first()
    assert tuple(metrics) == (3, 2, 7)


def test_metrics_of_nothing(spark, tmp_path):
    assert tuple(payload_metrics(read_payloads(spark, _write(tmp_path / "in", [{}]))).first()) == (0, 0, 0)


def test_nest_then_flatten_is_the_fact(spark, fact):
    back = flatten_orders(retail.order_payloads(fact))
    assert rows(back) == rows(fact.select(ORDER_COLUMNS))


def test_long_orders_continue_in_further_documents(spark, fact, monkeypatch):
    monkeypatch.setattr(retail, "PRODUCTS_PER_DOCUMENT", 2)
    payloads = retail.order_payloads(fact)
    sizes = payloads.select(F.explode("orders").alias("o")).select(F.max(F.size("o.products")))
    assert sizes.first()[0] == 2
    assert rows(flatten_orders(payloads)) == rows(fact.select(ORDER_COLUMNS))
    assert payload_metrics(payloads).first().declared_orders == fact.select("order_id").distinct().count()
