"""Exact arithmetic helpers.

Reports round ratios of counts and of money sums. Rounding a binary double
is ambiguous at printed halves (``0.00125``), so ratios of integer-valued
quantities are rounded with integer arithmetic instead: for ``n >= 0`` and
``d > 0``, ``round_half_up(n / d, k) = floor((2 * n * 10^k + d) / (2 * d)) / 10^k``.
All of it stays in JVM expressions (decimal(38,0) arithmetic, codegen'd).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT = "decimal(38,0)"


def floor_div(n: Column, d: Column) -> Column:
    """Exact floor division for integer-valued ``n >= 0`` and ``d > 0``."""
    n = n.cast(_INT)
    d = d.cast(_INT)
    return ((n - n % d) / d).cast(_INT)


def round_ratio(num: Column, den: Column, digits: int, times: int = 1) -> Column:
    """HALF_UP ``round(num / den, digits) * times`` as a double.

    ``num`` and ``den`` must be integer valued (counts, or money in cents)
    and ``den`` non-negative; halves of a negative ``num`` go away from zero.
    NULL when ``den`` is zero or NULL (the reference's ``NULLIF(den, 0)`` guard).
    """
    scale = 10 ** digits
    num = num.cast(_INT)
    den = den.cast(_INT)
    q = floor_div(F.abs(num) * F.lit(2 * scale) + den, den * F.lit(2))
    q = F.when(num < 0, -q).otherwise(q)
    divisor = scale / times
    return F.when(den > 0, q.cast("double") / F.lit(float(divisor)))


def cents(money: Column) -> Column:
    """A decimal money amount with 2 fractional digits as an exact integer."""
    return (money * F.lit(100)).cast(_INT)


def ratio(num: Column, den: Column) -> Column:
    """Unrounded ratio as a double, NULL on a zero denominator."""
    return F.when(den != 0, num.cast("double") / den.cast("double"))
