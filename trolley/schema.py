"""Declared schemas. Nothing in this package infers a schema.

Three stages share the same 15 column names and differ only in width:

* ``LANDED`` - what the landing writer emits. Every number is BIGINT, so all batches have the same Parquet
  footer whether or not they hold nulls.
* ``CLEAN`` - the typed table after cleaning. Ids are BIGINT: the serving ids are unsigned 32-bit, which INT
  cannot hold, and order counts pass 2^31 long before 100 TB. So are positions: a large user's order number or a
  large order's line passes SMALLINT. Small-domain columns stay narrow; a value outside the type becomes NULL and, in a
  key column, is reported as a reject.
* ``NESTED`` - the order document as it arrives: orders, each holding its products.
"""

# The column names below, their order and the key lists are fixed values of the data model.
ORDER_FIELDS = [
    "order_id",
    "user_id",
    "order_number",
    "order_dow",
    "order_hour_of_day",
    "days_since_prior_order",
    "eval_set",
]

PRODUCT_FIELDS = [
    "product_id",
    "product_name",
    "aisle_id",
    "aisle",
    "department_id",
    "department",
    "add_to_cart_order",
    "reordered",
]

ORDER_COLUMNS = ORDER_FIELDS + PRODUCT_FIELDS
OUTPUT_COLUMNS = ORDER_COLUMNS + ["ingested_at"]

# A row without any one of these is rejected; order matters for the reject report (first failing key is named).
KEY_COLUMNS = [
    "order_id",
    "user_id",
    "order_number",
    "product_id",
    "product_name",
    "add_to_cart_order",
    "reordered",
]

# The one column of the data model that may be null.
NULLABLE_COLUMN = "days_since_prior_order"

# One row per product position in an order.
DEDUP_KEYS = ["order_id", "product_id", "add_to_cart_order"]

# Physical clustering of the serving table.
CLUSTER_KEYS = ["order_id", "product_id"]

TEXT_COLUMNS = ["eval_set", "product_name", "aisle", "department"]

CLEAN_TYPES = {
    "order_id": "bigint",
    "user_id": "bigint",
    "order_number": "bigint",
    "order_dow": "tinyint",
    "order_hour_of_day": "tinyint",
    "days_since_prior_order": "int",
    "eval_set": "string",
    "product_id": "bigint",
    "product_name": "string",
    "aisle_id": "int",
    "aisle": "string",
    "department_id": "int",
    "department": "string",
    "add_to_cart_order": "bigint",
    "reordered": "tinyint",
}

LANDED_TYPES = {c: "string" if c in TEXT_COLUMNS else "bigint" for c in ORDER_COLUMNS}

# Closed ranges used by the table profile.
VALUE_RANGES = {"order_dow": (0, 6), "order_hour_of_day": (0, 23), "reordered": (0, 1)}

INGESTED_AT_FORMAT = "yyyy-MM-dd HH:mm:ss"

# JSON numbers such as 7.0 do not parse as integers, hence DOUBLE for the one nullable number.
_DOCUMENT_TYPES = {**LANDED_TYPES, "days_since_prior_order": "double"}


def _fields(types: dict[str, str], names: list[str]) -> str:
    return ", ".join(f"{name} {types[name]}" for name in names)


LANDED_SCHEMA = _fields(LANDED_TYPES, ORDER_COLUMNS)
CLEAN_SCHEMA = _fields({**CLEAN_TYPES, "ingested_at": "timestamp"}, OUTPUT_COLUMNS)
TEXT_SCHEMA = _fields(dict.fromkeys(ORDER_COLUMNS, "string"), ORDER_COLUMNS)

_PRODUCT = f"struct<{_fields(_DOCUMENT_TYPES, PRODUCT_FIELDS)}>"
_ORDER = f"struct<{_fields(_DOCUMENT_TYPES, ORDER_FIELDS)}, products array<{_PRODUCT}>>"
NESTED_SCHEMA = f"total_orders bigint, orders array<{_ORDER}>"
