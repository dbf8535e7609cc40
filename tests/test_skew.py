"""The hot-key operators against plain windows and joins, and the whole fact on deliberately skewed tables."""

import duckdb
import pytest
from compare import connect, differences
from rowsets import rows
from pyspark.sql import functions as F

from trolley import oracle
from trolley.operators.skew import Numbering, find_hot_keys, join_dimension, number_cold, number_rows
from trolley.plans import retail
from trolley.workspace import workspace

FACT_SQL = f"WITH {oracle.FACT} SELECT {oracle.COLUMNS} FROM fact"


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory, sf_dir):
    """The small tables with a third of the lines on one order and one part, and a third of the orders on one user."""
    out = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in ("orders", "lineitem", "part"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    con.execute(
        f"""COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey) FROM orders)
            TO '{out}/orders.parquet'"""
    )
    con.execute(
        f"""COPY (SELECT * REPLACE (CASE WHEN l_suppkey % 3 = 0 THEN 11 ELSE l_orderkey END AS l_orderkey,
                                    CASE WHEN l_quantity > 33 THEN 5 ELSE l_partkey END AS l_partkey) FROM lineitem)
            TO '{out}/lineitem.parquet'"""
    )
    con.execute(f"COPY part TO '{out}/part.parquet'")
    return str(out)


@pytest.mark.parametrize("hot_rows", [1, 5, 100, 10**6])
def test_fact_on_skewed_tables(spark, skewed_dir, hot_rows):
    fact = retail.order_items(spark, skewed_dir, hot_rows)
    assert differences(fact, connect(skewed_dir), FACT_SQL) == ""


@pytest.mark.parametrize("hot_rows", [2, 1000])
def test_fact_on_given_tables(spark, sf_dir, hot_rows):
    fact = retail.order_items(spark, sf_dir, hot_rows)
    assert differences(fact, connect(sf_dir), FACT_SQL) == ""


def test_hot_keys_are_exactly_the_large_ones(spark):
    df = spark.range(100).select(F.when(F.col("id") < 40, 1).otherwise(F.col("id")).alias("k"))
    ws = workspace(spark)
    assert rows(find_hot_keys(df, "k", ws, 10)) == [(1,)]
    assert find_hot_keys(df, "k", ws, 40) is None
    assert find_hot_keys(df, "k", ws, 1000) is None


def test_numbering_spreads_one_key_and_keeps_the_numbers(spark):
    df = spark.range(500).select(F.lit(1).alias("k"), (F.col("id") * 37 % 500).alias("v"))
    how = Numbering("k", ["v"], "n", total="all", previous="before", previous_of="v")
    ws = workspace(spark)
    hot = find_hot_keys(df, "k", ws, 10)
    assert rows(number_rows(df, how, hot, ws)) == rows(number_cold(df, how))


def test_numbering_of_exact_copies_is_a_permutation(spark):
    df = spark.range(300).select(F.lit(1).alias("k"), F.lit(9).alias("v"))
    ws = workspace(spark)
    numbered = number_rows(df, Numbering("k", ["v"], "n"), find_hot_keys(df, "k", ws, 10), ws)
    assert sorted(r.n for r in numbered.collect()) == list(range(1, 301))


def test_join_keeps_every_row(spark):
    big = spark.range(200).select(F.when(F.col("id") < 90, 0).otherwise(F.col("id") % 10).alias("k"), "id")
    dim = spark.range(12).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    hot = find_hot_keys(big, "k", workspace(spark), 50)
    assert rows(join_dimension(big, dim, "k", hot)) == rows(big.join(dim, "k"))
    left_out = dim.where("k > 0")
    assert rows(join_dimension(big, left_out, "k", hot)) == rows(big.join(left_out, "k"))


def test_cold_keys_are_not_shuffled_to_be_counted(spark, monkeypatch):
    """Counting by slots sends a number for each slot; one slot with a hot key in it has its keys counted, and no other."""
    df = spark.range(40_000).select(F.when(F.col("id") < 1500, -5).when(F.col("id") < 1600, None).otherwise(F.col("id")).alias("k"))
    ws, written = workspace(spark), []
    real = ws.materialise
    monkeypatch.setattr(ws, "materialise", lambda frame, name: written.append((name, plan(frame))) or real(frame, name))
    assert find_hot_keys(df, "k", ws, 2000) is None
    assert [name for name, _ in written] == ["hot-slots"]
    exchanges = [line for line in written[0][1].splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("_slot" in line or "xxhash64" in line or "_groupingexpression" in line for line in exchanges)
    assert rows(find_hot_keys(df, "k", ws, 1000)) == [(-5,)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_aisles_first_bought_are_found_with_one_row_an_order(spark, sf_dir):
    """Between orders and users travel lists of aisles, not a row for each aisle."""
    text = plan(retail.order_items(spark, sf_dir, 10**9))
    by_user = [line for line in text.splitlines() if "Exchange hashpartitioning(o_custkey" in line]
    assert by_user and not any("aisle" in line for line in by_user)
