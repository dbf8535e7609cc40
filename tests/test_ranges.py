"""Occupied ranges of a key."""

from pyspark.sql import functions as F

from trolley.operators.ranges import in_ranges, occupied_ranges


def test_ranges_hold_every_value_and_a_stray_one_widens_none(spark):
    df = spark.range(1000, 1100).union(spark.range(1).select(F.lit(10**12).alias("id")))
    assert occupied_ranges(df, "id") == [(1000, 1099), (10**12, 10**12)]
    assert df.where(in_ranges("id", occupied_ranges(df, "id"))).count() == 101


def test_ranges_of_few_or_no_values(spark):
    assert occupied_ranges(spark.range(0), "id") == []
    assert spark.range(5).where(in_ranges("id", [])).count() == 0
    nulls = spark.createDataFrame([(None,), (-3,), (3,)], "id bigint")
    assert occupied_ranges(nulls, "id", 4) == [(-3, -3), (3, 3)]
    assert len(occupied_ranges(spark.range(10_000), "id", 16)) <= 16


def test_ranges_of_ids_at_both_ends(spark):
    ends = [(-(2**63),), (-9 * 10**18,), (0,), (9 * 10**18,), (2**63 - 1,)]
    df = spark.createDataFrame(ends, "id bigint")
    ranges = occupied_ranges(df, "id")
    assert ranges == [(i, i) for (i,) in ends]
    assert df.where(in_ranges("id", ranges)).count() == 5


def test_dense_ids_are_one_range(spark):
    df = spark.range(10_000).select((F.col("id") * 7).alias("id"))
    assert occupied_ranges(df, "id") == [(0, 69_993)]
    assert occupied_ranges(df, "id", bounds=(0, 69_993)) == [(0, 69_993)]
