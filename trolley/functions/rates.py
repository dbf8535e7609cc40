"""Two-decimal rates in exact integer arithmetic.

Floating-point ``round`` differs between engines on values such as 0.575, and a float average depends on the order
rows are added in. So every rate here is a half-even quotient of integers, kept as a whole number of hundredths
until the last step. A zero denominator gives NULL.

Arguments are column names or SQL expressions over integers that are not negative.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _half_even_quotient(num: str, den: str) -> str:
    # Half-up is floor((2 num + den) / (2 den)); a zero rest there is a tie, and an odd result of a tie is one too many.
    den = f"nullif(CAST({den} AS BIGINT), 0)"
    doubled, by = f"(2 * CAST({num} AS BIGINT) + {den})", f"(2 * {den})"
    half_up = f"({doubled} div {by})"
    return f"{half_up} - IF({doubled} % {by} = 0, {half_up} % 2, 0)"


def hundredths(num: str, den: str, scale: int) -> Column:
    """``num / den * scale`` as a BIGINT; scale 100 for a ratio, 10000 for a percentage."""
    return F.expr(_half_even_quotient(f"(({num}) * {scale}L)", den)).cast("bigint")


def _two_decimals(num: str, den: str, scale: int) -> Column:
    return F.expr(f"({_half_even_quotient(f'(({num}) * {scale}L)', den)}) / 100.0D")


def pct2(num: str, den: str) -> Column:
    """``round(num / den * 100, 2)``."""
    return _two_decimals(num, den, 10_000)


def ratio2(num: str, den: str) -> Column:
    """``round(num / den, 2)``."""
    return _two_decimals(num, den, 100)


def mean_of_hundredths(total: str, n: str) -> Column:
    """``round(avg(x), 2)`` where ``total`` is the sum of ``x`` in hundredths."""
    return _two_decimals(total, n, 1)
