"""Physical plans: what must be there at scale, and what must not."""

import pytest
from compare import connect, differences
from rowsets import rows

from pyspark.sql import functions as F

from trolley.operators.filters import apply_filters, valid_orders
from trolley.oracle import COLUMNS, FACT
from trolley.plans import dashboard, retail
from trolley.plans.registry import QUERIES
from trolley.sinks.serving import new_rows
from trolley.sources.tables import read_serving


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_product_no_global_window(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("PythonUDF", "ArrowEval", "MapInPandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, f"{name}: {node}"


@pytest.mark.parametrize("name", sorted(dashboard.QUERIES))
def test_no_expand(fact, name):
    """No query multiplies its rows for several distinct counts."""
    assert "Expand" not in plan(dashboard.QUERIES[name](fact))


@pytest.mark.parametrize("prefix", ["q06", "q07", "q08", "q09", "q19", "q22", "q24"])
def test_top_k_never_sorts_everything(fact, prefix):
    query = next(q for n, q in dashboard.QUERIES.items() if n.startswith(prefix))
    assert "TakeOrderedAndProject" in plan(query(fact))


def test_top_aisles_limit_groups_before_the_shuffle(fact):
    assert plan(dashboard.q28_top_aisles_per_department(fact)).count("WindowGroupLimit") >= 2


def test_ranks_join_only_totals_of_stretches(fact):
    """Neither products nor their counts are joined by department and count, where the long tail is one key."""
    text = plan(dashboard.q21_product_rank_in_department(fact))
    joins = [line for line in text.splitlines() if "Join" in line]
    assert joins and all("_part" in line and "total_items_sold" not in line for line in joins)
    assert "trolley_fact" not in text  # the fact is read once, for the table that is ranked


def test_scans_read_only_what_they_need(fact):
    text = plan(dashboard.q10_department_share(fact))
    assert "ReadSchema: struct<department:string>" in text
    text = plan(dashboard.q11_orders_by_hour(fact))
    assert "ReadSchema: struct<order_id:bigint,order_hour_of_day:tinyint>" in text


def test_filters_reach_the_scan(fact):
    assert "LessThanOrEqual(add_to_cart_order,10)" in plan(dashboard.q23_cart_position_funnel(fact))
    assert "IsNotNull(days_since_prior_order)" in plan(dashboard.q17_orders_by_days_since_prior(fact))
    text = plan(valid_orders(fact))
    for pushed in ("GreaterThan(order_id,0)", "GreaterThan(user_id,0)", "GreaterThan(product_id,0)"):
        assert pushed in text
    text = plan(dashboard.q10_department_share(apply_filters(fact, departments=["LARGE"], reordered=1)))
    assert "EqualTo(reordered,1)" in text


@pytest.mark.parametrize(
    "name, shuffles",
    [
        ("q01_total_unique_orders", 1),
        ("q05_avg_products_per_order", 1),
        ("q11_orders_by_hour", 2),
        ("q13_order_size_distribution", 2),
        ("q17_orders_by_days_since_prior", 2),
        ("q18_orders_and_cart_by_dow", 2),
        ("q22_top_users", 1),
        ("q23_cart_position_funnel", 2),
        ("q27_new_vs_returning_by_dow", 2),
        ("q30_reorder_by_hour", 2),
    ],
)
def test_order_level_steps_use_the_buckets(fact, name, shuffles):
    """Left are the exchange by the small group key and, where the result is sorted, the sort's."""
    text = plan(dashboard.QUERIES[name](fact))
    assert "Bucketed: true" in text
    assert text.count("Exchange ") == shuffles


@pytest.fixture(scope="module")
def loaded_twice(spark, sf_dir, tmp_path_factory):
    """The serving table after two loads of different orders."""
    from trolley.plans import jobs
    from trolley.schema import LANDED_TYPES
    from trolley.sinks.files import land_batch

    root = tmp_path_factory.mktemp("twice")
    at = jobs.Locations("", f"{root}/raw", f"{root}/processed", f"{root}/warehouse", "loaded_twice")
    items = retail.fact(spark, sf_dir).select(*[F.col(c).cast(t) for c, t in LANDED_TYPES.items()])
    for part in (0, 1):
        land_batch(items.where(F.col("order_id") % 2 == part), at.raw, f"b{part}")
        jobs.run(spark, at, idempotent=True)
    return read_serving(spark, at.table)


@pytest.mark.parametrize(
    "name", [n for n in dashboard.QUERIES if n.startswith(("q01", "q11", "q13", "q14", "q18", "q22", "q27"))]
)
def test_the_served_table_is_bucketed_like_the_fact(fact, loaded_twice, name):
    query = dashboard.QUERIES[name]
    assert plan(query(loaded_twice)).count("Exchange ") == plan(query(fact)).count("Exchange ")
    assert rows(query(loaded_twice)) == rows(query(fact))


def test_idempotent_append_reads_only_the_orders_it_may_repeat(loaded_twice):
    incoming = loaded_twice.where("order_id between 10 and 12 or order_id = 1200")
    text = plan(new_rows(incoming, loaded_twice))
    assert "LessThanOrEqual(order_id,12)" in text and "GreaterThanOrEqual(order_id,1200)" in text


def test_one_bucket_is_one_file(spark, sf_dir, tmp_path):
    stored = retail.store_fact(spark, sf_dir, f"{tmp_path}/fact-onefile")
    files = [f for f in spark.table(stored.ordinary).inputFiles()]
    assert stored.large is None and len(files) == spark.sparkContext.defaultParallelism


def test_large_orders_fall_back_to_shuffles(spark, sf_dir, tmp_path, fact):
    stored = retail.store_fact(spark, sf_dir, f"{tmp_path}/fact-large", hot_rows=8)
    assert stored.large is not None
    split = retail.read_fact(spark, stored)
    assert rows(split) == rows(fact)
    sizes = dashboard.q13_order_size_distribution(split)
    assert "hashpartitioning(order_id" in plan(sizes)
    assert rows(sizes) == rows(dashboard.q13_order_size_distribution(fact))


def test_payload_files_are_compressed(spark, sf_dir):
    files = spark.read.format("binaryFile").load(retail.payload_path(spark, sf_dir)).select("path").collect()
    assert files and all(f.path.endswith(".json.gz") for f in files)


def test_lines_reach_their_order_without_the_columns_that_break_ties(spark, sf_dir):
    """The shuffle that carries the product's texts carries two numbers more, not the eight of LINE_ORDER."""
    text = plan(retail.order_items(spark, sf_dir, 10**9))
    wide = [line for line in text.splitlines() if "Project" in line and "aisle_id" in line]
    assert wide and not any("l_extendedprice" in line for line in wide)


def test_buckets_are_read_one_a_task(fact):
    assert "Bucketed: true" in plan(dashboard.q14_volume_vs_reorder(fact))


def test_lines_carry_no_tie_breaks_and_no_derived_product_columns(spark, sf_dir):
    """Shuffles of the build take three numbers of a line and three texts of its product."""
    text = plan(retail.order_items(spark, sf_dir, 10**9))
    assert "l_extendedprice" not in text and "l_suppkey" not in text
    carried = [line for line in text.splitlines() if "Project" in line and "p_brand" in line and "l_linenumber" in line]
    assert carried and not any("aisle_id" in line or "department" in line for line in carried)


def test_lines_that_tie_get_the_positions_of_sql(spark, sf_dir, tmp_path):
    """Orders whose lines share numbers, products and whole rows."""
    for name in ("orders", "part"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumns(
        {
            "l_linenumber": F.expr("CAST(CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_linenumber % 2 END AS INT)"),
            "l_partkey": F.expr("CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_partkey END"),
        }
    )
    lines.unionByName(lines.where("l_orderkey % 4 = 0")).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = connect("")
    for name in ("orders", "part", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    con.execute("SET default_null_order = 'nulls_first'")
    sql = f"WITH {FACT} SELECT {COLUMNS} FROM fact"
    assert differences(retail.order_items(spark, str(tmp_path)), con, sql) == ""
    assert differences(retail.order_items(spark, str(tmp_path), hot_rows=9), con, sql) == ""
