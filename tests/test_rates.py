"""Exact two-decimal rates against decimal arithmetic."""

from decimal import ROUND_HALF_EVEN, Decimal

from pyspark.sql import functions as F

from trolley.functions.rates import mean_of_hundredths, pct2, ratio2


def _half_even(num, den, scale):
    return float((Decimal(num) * scale / Decimal(den)).quantize(Decimal("0.01"), ROUND_HALF_EVEN))


def test_all_small_ratios(spark):
    pairs = spark.range(1, 161).select(F.col("id").alias("d"), F.explode(F.sequence(F.lit(0), F.col("id"))).alias("n"))
    for r in pairs.select("n", "d", pct2("n", "d").alias("p"), ratio2("n", "d").alias("r")).collect():
        assert r.p == _half_even(r.n, r.d, 100), (r.n, r.d)
        assert r.r == _half_even(r.n, r.d, 1), (r.n, r.d)


def test_ties_go_to_even_and_zero_gives_null(spark):
    df = spark.createDataFrame([(1, 32), (5, 32), (9, 8), (0, 0), (3, 0)], "n long, d long")
    values = df.select(pct2("n", "d").alias("p"), ratio2("n", "d").alias("r")).collect()
    assert [v.p for v in values] == [3.12, 15.62, 112.5, None, None]
    assert values[2].r == 1.12


def test_mean_of_hundredths(spark):
    df = spark.createDataFrame([(1001, 2), (0, 3), (5, 0)], "t long, n long")
    assert [r[0] for r in df.select(mean_of_hundredths("t", "n")).collect()] == [5.0, 0.0, None]


def test_counts_of_a_trillion_rows_do_not_overflow(spark):
    df = spark.createDataFrame([(333_333_333_333, 10**12)], "n long, d long")
    assert df.select(pct2("n", "d")).first()[0] == 33.33
