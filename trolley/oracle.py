"""Independent SQL for every registered query, for DuckDB over the same Parquet tables.

Each statement starts from the base tables. Only the rounding rule is shared with the Spark side, because it defines
the result: half-even quotients of integers (see ``functions/rates.py``).
"""

from __future__ import annotations

# The 15-column order-item fact, straight from the table definitions.
FACT = """
user_orders AS (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date,
         row_number() OVER w AS order_number,
         lag(CAST(o_orderdate AS DATE)) OVER w AS prior_date,
         count(*) OVER (PARTITION BY o_custkey) AS user_orders
  FROM orders
  WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)
),
products AS (
  SELECT p_partkey, p_name, p_type, p_brand,
         list_position(['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'], p_type) AS department_id
  FROM part
),
fact AS (
  SELECT o_orderkey AS order_id,
         o_custkey AS user_id,
         CAST(order_number AS BIGINT) AS order_number,
         CAST(dayofweek(order_date) AS TINYINT) AS order_dow,
         CAST(o_orderkey % 24 AS TINYINT) AS order_hour_of_day,
         CAST(date_diff('day', prior_date, order_date) AS INTEGER) AS days_since_prior_order,
         CASE WHEN order_number = user_orders THEN 'train' ELSE 'prior' END AS eval_set,
         l_partkey AS product_id,
         p_name AS product_name,
         CAST(department_id * 100 + CAST(substr(p_brand, 7) AS INTEGER) AS INTEGER) AS aisle_id,
         p_type || ' ' || p_brand AS aisle,
         CAST(department_id AS INTEGER) AS department_id,
         p_type AS department,
         CAST(row_number() OVER (
           PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax
         ) AS BIGINT) AS add_to_cart_order,
         CAST(CASE WHEN dense_rank() OVER (
           PARTITION BY o_custkey, p_type, p_brand ORDER BY order_number
         ) > 1 THEN 1 ELSE 0 END AS TINYINT) AS reordered
  FROM lineitem
  JOIN user_orders ON l_orderkey = o_orderkey
  JOIN products ON l_partkey = p_partkey
)"""

# Column names in order.
COLUMNS = (
    "order_id, user_id, order_number, order_dow, order_hour_of_day, days_since_prior_order, eval_set, "
    "product_id, product_name, aisle_id, aisle, department_id, department, add_to_cart_order, reordered"
)

# The staged text feed with its injected faults; dirty_once has every row once, dirty repeats some.
DIRTY = """
dirty_once AS (
  SELECT CAST(order_id AS VARCHAR) AS order_id,
         CASE WHEN order_id % 89 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
         CASE WHEN order_id % 79 = 0 THEN '99999999999999999999' ELSE CAST(order_number AS VARCHAR) END AS order_number,
         CAST(order_dow AS VARCHAR) AS order_dow,
         CAST(order_hour_of_day AS VARCHAR) || CASE WHEN order_id % 73 = 0 THEN '.7' ELSE '' END AS order_hour_of_day,
         CAST(days_since_prior_order AS VARCHAR) || '.0' AS days_since_prior_order,
         eval_set,
         CAST(product_id AS VARCHAR) AS product_id,
         CASE WHEN order_id % 97 = 0 AND add_to_cart_order = 1 THEN NULL ELSE product_name END AS product_name,
         CAST(aisle_id AS VARCHAR) AS aisle_id,
         aisle,
         CAST(department_id AS VARCHAR) AS department_id,
         department,
         CAST(add_to_cart_order AS VARCHAR) AS add_to_cart_order,
         CASE WHEN order_id % 83 = 0 AND add_to_cart_order = 2 THEN 'x' ELSE CAST(reordered AS VARCHAR) END AS reordered
  FROM fact
),
dirty AS (
  SELECT * FROM dirty_once
  UNION ALL
  SELECT * FROM dirty_once WHERE CAST(product_id AS BIGINT) % 10 = 0
)"""

# Columns in order, with types wide enough for the data model's unsigned columns.
_TYPES = {
    "order_id": "BIGINT",
    "user_id": "BIGINT",
    "order_number": "BIGINT",
    "order_dow": "TINYINT",
    "order_hour_of_day": "TINYINT",
    "days_since_prior_order": "INTEGER",
    "eval_set": "VARCHAR",
    "product_id": "BIGINT",
    "product_name": "VARCHAR",
    "aisle_id": "INTEGER",
    "aisle": "VARCHAR",
    "department_id": "INTEGER",
    "department": "VARCHAR",
    "add_to_cart_order": "BIGINT",
    "reordered": "TINYINT",
}


def _typed(source: str) -> str:
    columns = ", ".join(
        name if to == "VARCHAR" else f"TRY_CAST(trunc(TRY_CAST({name} AS DOUBLE)) AS {to}) AS {name}"
        for name, to in _TYPES.items()
    )
    return f"SELECT {columns} FROM {source}"


_KEYS_PRESENT = (
    "order_id IS NOT NULL AND user_id IS NOT NULL AND order_number IS NOT NULL AND product_id IS NOT NULL "
    "AND product_name IS NOT NULL AND add_to_cart_order IS NOT NULL AND reordered IS NOT NULL"
)
_REST = ", ".join(
    f"{c} NULLS FIRST" for c in _TYPES if c not in ("order_id", "product_id", "add_to_cart_order")
)

TYPED = f"typed AS ({_typed('dirty')})"
CLEAN = f"""
clean AS (
  SELECT {COLUMNS} FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, product_id, add_to_cart_order ORDER BY {_REST}) AS copy
    FROM typed WHERE {_KEYS_PRESENT}
  ) WHERE copy = 1
)"""
CLEAN_FACT = f"clean_fact AS (SELECT * FROM ({_typed('fact')}) WHERE {_KEYS_PRESENT})"


def _hundredths(num: str, den: str, scale: int) -> str:
    n, d = f"(CAST({num} AS BIGINT) * {scale})", f"nullif(CAST({den} AS BIGINT), 0)"
    quotient, twice_rest = f"({n} // {d})", f"(2 * ({n} % {d}))"
    up = f"{twice_rest} > {d} OR ({twice_rest} = {d} AND {quotient} % 2 = 1)"
    return f"CAST({quotient} + CASE WHEN {up} THEN 1 ELSE 0 END AS BIGINT)"


def _pct2(num: str, den: str) -> str:
    return f"{_hundredths(num, den, 10_000)} / 100.0::DOUBLE"


def _ratio2(num: str, den: str) -> str:
    return f"{_hundredths(num, den, 100)} / 100.0::DOUBLE"


def _mean2(total: str, den: str) -> str:
    return f"{_hundredths(total, den, 1)} / 100.0::DOUBLE"


_RATE = f"{_pct2('sum(reordered)', 'count(*)')} AS reorder_rate_pct"
_DAY = (
    "CASE WHEN order_dow BETWEEN 0 AND 6 "
    "THEN ['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][order_dow + 1] ELSE '' END AS day_name"
)


def _on(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join((FACT, *ctes)) + "\n" + select


def _weekday_rate(dow: int, name: str) -> str:
    reorders = f"sum(CASE WHEN order_dow = {dow} THEN reordered ELSE 0 END)"
    return f"{_pct2(reorders, f'count(*) FILTER (WHERE order_dow = {dow})')} AS {name}_reorder_rate_pct"


def _dashboard() -> dict[str, str]:
    weekday_rates = ", ".join(
        _weekday_rate(i, n) for i, n in enumerate(("sun", "mon", "tue", "wed", "thu", "fri", "sat"))
    )
    return {
        "q01_total_unique_orders": "SELECT count(DISTINCT order_id) AS total_unique_orders FROM fact",
        "q02_total_unique_users": "SELECT count(DISTINCT user_id) AS total_unique_users FROM fact",
        "q03_total_products_sold": "SELECT count(*) AS total_products_sold FROM fact",
        "q04_overall_reorder_rate": f"SELECT {_RATE} FROM fact",
        "q05_avg_products_per_order": (
            f"SELECT {_ratio2('count(*)', 'count(DISTINCT order_id)')} AS avg_products_per_order FROM fact"
        ),
        "q06_top_products": """
            SELECT product_name, total_items_sold FROM (
              SELECT product_id, product_name, count(*) AS total_items_sold
              FROM fact GROUP BY ALL ORDER BY total_items_sold DESC, product_id LIMIT 10)""",
        "q07_top_products_by_reorder_rate": f"""
            SELECT product_name, total_items_sold, reorder_rate_pct FROM (
              SELECT product_id, product_name, count(*) AS total_items_sold, {_RATE}
              FROM fact GROUP BY product_id, product_name HAVING count(*) >= 5
              ORDER BY reorder_rate_pct DESC, total_items_sold DESC, product_id LIMIT 10)""",
        "q08_top_departments": """
            SELECT department, count(*) AS total_items_sold FROM fact
            GROUP BY department ORDER BY total_items_sold DESC, department LIMIT 10""",
        "q09_top_aisles": """
            SELECT aisle, count(*) AS total_items_sold FROM fact
            GROUP BY aisle ORDER BY total_items_sold DESC, aisle LIMIT 10""",
        "q10_department_share": """
            SELECT department, count(*) AS total_items_sold FROM fact
            GROUP BY department ORDER BY total_items_sold DESC, department""",
        "q11_orders_by_hour": """
            SELECT order_hour_of_day AS hour_of_day, count(DISTINCT order_id) AS total_orders
            FROM fact GROUP BY 1 ORDER BY 1""",
        "q12_orders_by_dow": f"""
            SELECT order_dow, {_DAY}, count(DISTINCT order_id) AS total_orders
            FROM fact GROUP BY order_dow ORDER BY order_dow""",
        "q13_order_size_distribution": """
            SELECT CAST(start AS VARCHAR) || '-' || CAST(start + 4 AS VARCHAR) AS cart_size_bucket,
                   count(*) AS total_orders
            FROM (SELECT (count(*) - 1) // 5 * 5 + 1 AS start FROM fact GROUP BY order_id)
            GROUP BY start ORDER BY start""",
        "q14_volume_vs_reorder": f"""
            SELECT product_name, total_orders, reorder_rate_pct, total_items_sold FROM (
              SELECT product_id, product_name, count(DISTINCT order_id) AS total_orders, {_RATE},
                     count(*) AS total_items_sold
              FROM fact GROUP BY product_id, product_name HAVING count(*) >= 3)""",
        "q15_user_frequency_vs_basket": f"""
            SELECT user_id, count(DISTINCT order_id) AS order_frequency,
                   {_ratio2('count(*)', 'count(DISTINCT order_id)')} AS avg_order_size
            FROM fact GROUP BY user_id""",
        "q16_reorder_by_order_number": f"SELECT order_number, {_RATE} FROM fact GROUP BY order_number",
        "q17_orders_by_days_since_prior": """
            SELECT days_since_prior_order, count(DISTINCT order_id) AS total_orders
            FROM fact WHERE days_since_prior_order IS NOT NULL GROUP BY days_since_prior_order""",
        "q18_orders_and_cart_by_dow": f"""
            SELECT order_dow, {_DAY}, count(*) AS total_orders, {_ratio2('sum(n)', 'count(*)')} AS avg_cart_size
            FROM (SELECT order_id, min(order_dow) AS order_dow, count(*) AS n FROM fact GROUP BY order_id)
            GROUP BY order_dow""",
        "q19_department_contribution": """
            SELECT department, count(*) AS total_items_sold FROM fact
            GROUP BY department ORDER BY total_items_sold DESC, department LIMIT 12""",
        "q20_reorder_by_department_dow": f"""
            SELECT department, {weekday_rates}, count(*) AS total_items_sold FROM fact GROUP BY department""",
        "q21_product_rank_in_department": f"""
            SELECT department, product_name, total_items_sold, unique_orders, reorder_rate_pct,
                   CAST(rank() OVER (PARTITION BY department ORDER BY total_items_sold DESC) AS BIGINT)
                     AS rank_within_department
            FROM (
              SELECT department, product_id, product_name, count(*) AS total_items_sold,
                     count(DISTINCT order_id) AS unique_orders, {_RATE}
              FROM fact GROUP BY department, product_id, product_name)""",
        "q22_top_users": f"""
            SELECT user_id, count(DISTINCT order_id) AS total_orders, count(*) AS total_items_bought,
                   {_ratio2('count(*)', 'count(DISTINCT order_id)')} AS avg_products_per_order
            FROM fact GROUP BY user_id
            ORDER BY total_orders DESC, total_items_bought DESC, user_id LIMIT 20""",
        "q23_cart_position_funnel": """
            SELECT 'Item ' || CAST(add_to_cart_order AS VARCHAR) AS cart_step,
                   count(DISTINCT order_id) AS orders_reaching_step
            FROM fact WHERE add_to_cart_order <= 10 GROUP BY add_to_cart_order""",
        "q24_department_aisle_flow": """
            SELECT department AS source, aisle AS target, count(*) AS total_items_sold
            FROM fact GROUP BY department, aisle
            ORDER BY total_items_sold DESC, source, target LIMIT 30""",
        "q25_department_scorecard": f"""
            SELECT department, count(*) AS total_items_sold, count(DISTINCT product_id) AS unique_products,
                   count(DISTINCT order_id) AS unique_orders, {_RATE}
            FROM fact GROUP BY department""",
        "q26_interval_segments": f"""
            SELECT CASE WHEN days_since_prior_order < 7 THEN '< 7 days'
                        WHEN days_since_prior_order < 15 THEN '7-14 days'
                        WHEN days_since_prior_order < 22 THEN '15-21 days'
                        ELSE '> 21 days' END AS interval_segment,
                   count(DISTINCT order_id) AS total_orders,
                   {_ratio2('count(*)', 'count(DISTINCT order_id)')} AS avg_basket_size, {_RATE}
            FROM fact WHERE days_since_prior_order IS NOT NULL GROUP BY 1""",
        "q27_new_vs_returning_by_dow": f"""
            SELECT order_dow, {_DAY}, {_mean2('sum(new_share)', 'count(*)')} AS avg_pct_new,
                   {_mean2('sum(returning_share)', 'count(*)')} AS avg_pct_returning
            FROM (
              SELECT order_id, min(order_dow) AS order_dow,
                     {_hundredths('count(*) FILTER (WHERE reordered = 0)', 'count(*)', 10_000)} AS new_share,
                     {_hundredths('count(*) FILTER (WHERE reordered = 1)', 'count(*)', 10_000)} AS returning_share
              FROM fact GROUP BY order_id)
            GROUP BY order_dow""",
        "q28_top_aisles_per_department": f"""
            SELECT * FROM (
              SELECT department, aisle, count(*) AS total_items_sold, {_RATE},
                     CAST(rank() OVER (PARTITION BY department ORDER BY count(*) DESC) AS BIGINT)
                       AS rank_in_department
              FROM fact GROUP BY department, aisle)
            WHERE rank_in_department <= 3""",
        "q29_user_frequency_cohorts": f"""
            SELECT CASE WHEN order_count = 1 THEN '1 order'
                        WHEN order_count <= 5 THEN '2-5 orders'
                        WHEN order_count <= 10 THEN '6-10 orders'
                        ELSE '> 10 orders' END AS frequency_bucket,
                   count(*) AS total_users, {_mean2('sum(basket)', 'count(*)')} AS avg_basket_size,
                   {_mean2('sum(rate)', 'count(*)')} AS avg_reorder_rate_pct
            FROM (
              SELECT user_id, count(DISTINCT order_id) AS order_count,
                     {_hundredths('count(*)', 'count(DISTINCT order_id)', 100)} AS basket,
                     {_hundredths('sum(reordered)', 'count(*)', 10_000)} AS rate
              FROM fact GROUP BY user_id)
            GROUP BY 1""",
        "q30_reorder_by_hour": f"""
            SELECT order_hour_of_day AS hour_of_day, count(DISTINCT order_id) AS total_orders, {_RATE}
            FROM fact GROUP BY order_hour_of_day""",
        "dashboard_kpis": f"""
            SELECT count(DISTINCT order_id) AS total_unique_orders, count(DISTINCT user_id) AS total_unique_users,
                   count(*) AS total_products_sold, {_RATE},
                   {_ratio2('count(*)', 'count(DISTINCT order_id)')} AS avg_products_per_order
            FROM fact""",
        "dashboard_filtered_scorecard": f"""
            SELECT department, count(*) AS total_items_sold, count(DISTINCT product_id) AS unique_products,
                   count(DISTINCT order_id) AS unique_orders, {_RATE}
            FROM fact
            WHERE department IN ('LARGE', 'PROMO', 'STANDARD') AND order_hour_of_day BETWEEN 8 AND 17
              AND order_dow IN (0, 6)
            GROUP BY department""",
        "order_grain_mart": """
            SELECT order_id, user_id, order_number, order_dow, order_hour_of_day, days_since_prior_order,
                   count(*) AS n_items, CAST(sum(reordered) AS BIGINT) AS n_reordered
            FROM fact GROUP BY ALL""",
    }


_SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "TINYINT": "tinyint", "VARCHAR": "string", "TIMESTAMP": "timestamp"
}
_LOAD_TIME = "'2024-01-01 00:00:00' AS ingested_at"


def _profile(column: str) -> str:
    ranges = {"order_dow": (0, 6), "order_hour_of_day": (0, 23), "reordered": (0, 1)}
    low, high = ranges.get(column, (None, None))
    outside = "0" if low is None else f"count(*) FILTER (WHERE {column} NOT BETWEEN {low} AND {high})"
    return f"""
        SELECT '{column}' AS column_name, count(*) AS row_count,
               '{_SPARK_TYPES[_TYPES.get(column, "TIMESTAMP")]}' AS data_type,
               count(*) FILTER (WHERE {column} IS NULL) AS null_count,
               count(*) FILTER (WHERE {column} IS NULL AND '{column}' <> 'days_since_prior_order') AS null_violations,
               count(DISTINCT {column}) AS distinct_count,
               CAST(min({column}) AS VARCHAR) AS min_value, CAST(max({column}) AS VARCHAR) AS max_value,
               CAST({outside} AS BIGINT) AS out_of_range
        FROM loaded"""


# The CSV batch of the mixed landing has odd product names.
_ODD_NAMES = f"""SELECT {COLUMNS.replace("product_name", """
    product_name || CASE WHEN order_hour_of_day >= 16 AND order_id % 50 = 0
                         THEN ' "2%", 1l\\x' || chr(10) || 'new' ELSE '' END AS product_name""")} FROM clean_fact"""


# Dashboard results in one form: label, count and rate.
_SHOWN = (
    ("q10_department_share", "department", "total_items_sold", "NULL"),
    ("q11_orders_by_hour", "hour_of_day", "total_orders", "NULL"),
    ("q13_order_size_distribution", "cart_size_bucket", "total_orders", "NULL"),
    ("q15_user_frequency_vs_basket", "user_id", "order_frequency", "avg_order_size"),
    ("q18_orders_and_cart_by_dow", "day_name", "total_orders", "avg_cart_size"),
    ("q23_cart_position_funnel", "cart_step", "orders_reaching_step", "NULL"),
    ("q25_department_scorecard", "department", "unique_orders", "reorder_rate_pct"),
    ("q28_top_aisles_per_department", "aisle", "total_items_sold", "reorder_rate_pct"),
    ("q30_reorder_by_hour", "hour_of_day", "total_orders", "reorder_rate_pct"),
)


def _shown(statements: dict[str, str], names: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS query, CAST({label} AS VARCHAR) AS label, CAST({total} AS BIGINT) AS total, "
        f"CAST({rate} AS DOUBLE) AS rate FROM ({statements[name]})"
        for name, label, total, rate in _SHOWN
        if name.startswith(tuple(names))
    )


def oracle_sql() -> dict[str, str]:
    statements = {name: _on(select=sql) for name, sql in _dashboard().items()}
    whole_fact = _on(select=f"SELECT {COLUMNS} FROM fact")
    bigint_fact = ", ".join(
        c if c in ("eval_set", "product_name", "aisle", "department") else f"CAST({c} AS BIGINT) AS {c}" for c in _TYPES
    )
    landed_fact = _on(select=f"SELECT {bigint_fact} FROM fact")
    statements |= {
        "fact_order_items": whole_fact,
        "flatten_orders": landed_fact,
        "idempotent_append": whole_fact,
        "union_staged": _on(CLEAN_FACT, select=_ODD_NAMES),
        "ingest_metrics": _on(
            select="""SELECT count(*) AS rows_written, count(DISTINCT order_id) AS orders_with_products,
                             count(DISTINCT order_id) AS declared_orders FROM fact"""
        ),
        "clean_typed": _on(DIRTY, TYPED, select="SELECT * FROM typed"),
        "clean_dropna": _on(DIRTY, TYPED, select=f"SELECT * FROM typed WHERE {_KEYS_PRESENT}"),
        "clean_orders": _on(DIRTY, TYPED, CLEAN, select="SELECT * FROM clean"),
        "stream_dedup": _on(DIRTY, TYPED, CLEAN, select="SELECT * FROM clean"),
        "stream_ingest": _on(CLEAN_FACT, select=_ODD_NAMES),
        "cleanup_leftovers": _on(CLEAN_FACT, select=_ODD_NAMES),
        "stream_archive": _on(CLEAN_FACT, select=_ODD_NAMES),
        "dashboard_marts": _shown(statements, [name for name, *_ in _SHOWN]),
        "result_marts": _shown(statements, ["q11", "q12", "q13", "q18", "q23", "q27", "q30"]),
        "load_replayed": _on(CLEAN_FACT, select=f"SELECT {COLUMNS} FROM clean_fact"),
        "payload_rejects": _on(
            "documents AS (SELECT DISTINCT order_id, order_id // 20 AS payload, (add_to_cart_order - 1) // 500 AS part "
            "FROM fact)",
            select="""
            SELECT (SELECT count(*) FROM fact WHERE order_id // 20 % 7 <> 0) AS rows_landed,
                   count(DISTINCT order_id) FILTER (WHERE payload % 7 <> 0) AS orders_landed,
                   count(DISTINCT (payload, part)) FILTER (WHERE payload % 7 = 0) AS payloads_kept,
                   count(DISTINCT (payload, part)) FILTER (WHERE payload % 7 = 0) AS bad_payloads,
                   count(*) FILTER (WHERE payload % 7 <> 0) AS orders,
                   count(DISTINCT order_id) FILTER (WHERE payload % 7 <> 0) AS declared_orders
            FROM documents""",
        ),
        "reject_report": _on(
            DIRTY,
            TYPED,
            select="""
            SELECT CASE WHEN order_id IS NULL THEN 'order_id' WHEN user_id IS NULL THEN 'user_id'
                        WHEN order_number IS NULL THEN 'order_number' WHEN product_id IS NULL THEN 'product_id'
                        WHEN product_name IS NULL THEN 'product_name'
                        WHEN add_to_cart_order IS NULL THEN 'add_to_cart_order' ELSE 'reordered' END AS reject_reason,
                   count(*) AS rejected_rows
            FROM typed WHERE NOT (""" + _KEYS_PRESENT + ") GROUP BY 1",
        ),
        "clean_dedup": """
            SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                   l_returnflag, l_linestatus, l_shipdate
            FROM (
              SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate),
                     row_number() OVER (
                       PARTITION BY l_orderkey, l_partkey, l_linenumber
                       ORDER BY l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
                                l_linestatus, l_shipdate) AS copy
              FROM lineitem)
            WHERE copy = 1""",
        "valid_orders_view": _on(
            select=f"""SELECT {COLUMNS} FROM fact
                       WHERE order_id > 0 AND user_id > 0 AND product_id > 0 AND product_name <> ''"""
        ),
        "serving_roundtrip": _on(CLEAN_FACT, select=f"SELECT {COLUMNS}, {_LOAD_TIME} FROM clean_fact"),
        "sink_format": _on(DIRTY, TYPED, CLEAN, select=f"SELECT {COLUMNS}, {_LOAD_TIME} FROM clean"),
        "serving_view": _on(
            CLEAN_FACT,
            select=f"""SELECT {COLUMNS} FROM clean_fact
                       WHERE order_id > 0 AND user_id > 0 AND product_id > 0 AND product_name <> ''""",
        ),
        **{
            f"serving_{name.removeprefix('dashboard_')}": sql
            for name, sql in statements.items()
            if name.startswith(("q01", "q11", "q13", "q14", "q18", "q21", "q22", "q25", "q27", "q28", "dashboard_kpis"))
        },
        "loaded_row_count": _on(CLEAN_FACT, select="SELECT count(*) AS total_rows FROM clean_fact"),
        "latest_rows": _on(
            select="""
            SELECT order_id, user_id, product_id, product_name, department, reordered, ingested_at FROM (
              SELECT *, strftime(TIMESTAMP '2024-01-01 00:00:00' + to_hours(order_number % 1000),
                                 '%Y-%m-%d %H:%M:%S') AS ingested_at
              FROM fact
              ORDER BY ingested_at DESC, order_id, product_id, add_to_cart_order LIMIT 10)"""
        ),
        "table_profile": _on(
            CLEAN_FACT,
            f"loaded AS (SELECT {COLUMNS}, {_LOAD_TIME} FROM clean_fact)",
            select=" UNION ALL ".join(_profile(c) for c in [*_TYPES, "ingested_at"]),
        ),
        "consistency_check": _on(
            select="""
            SELECT 'duplicate_keys' AS check_name, count(*) AS violations FROM (
              SELECT 1 FROM fact GROUP BY order_id, product_id, add_to_cart_order HAVING count(*) > 1)
            UNION ALL
            SELECT 'inconsistent_orders', count(*) FROM (
              SELECT order_id FROM (
                SELECT DISTINCT order_id, user_id, order_number, order_dow, order_hour_of_day,
                       days_since_prior_order, eval_set FROM fact)
              GROUP BY order_id HAVING count(*) > 1)"""
        ),
    }
    return statements
