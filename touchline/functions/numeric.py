"""Null- and ANSI-safe arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Whole numbers up to 10^25 go through the ratio helpers without overflow.
WHOLE = "decimal(26,0)"


def round_ratio(num: Column, den: Column, digits: int = 2, scale: int = 1) -> Column:
    """ROUND(num * scale / NULLIF(den, 0), digits), exact half-up, as double.

    For non-negative integer inputs. Rounding a double quotient is not
    reproducible across engines at half-way points (0.285 -> 0.28 or 0.29),
    so the quotient is rounded in decimal arithmetic on whole numbers and only
    the final k / 10^digits becomes a double, the nearest one.
    """
    f = 10 ** digits
    d = F.nullif(den.cast(WHOLE), F.lit(0).cast(WHOLE))        # NULL divisor, never /0
    a = num.cast(WHOLE) * F.lit(2 * f * scale).cast("decimal(6,0)") + d
    b = d * F.lit(2).cast("decimal(1,0)")
    k = ((a - F.pmod(a, b)) / b).cast("decimal(28,0)")     # exact: a - a mod b is a multiple of b
    return (k / F.lit(f).cast("decimal(5,0)")).cast("double")


def bool_true(c: Column) -> Column:
    """``x = TRUE`` with NULL -> False (the reference's winner normalisation)."""
    return F.coalesce(c == F.lit(True), F.lit(False))


def round_avg(total: Column, n: Column, digits: int = 2, fixed: int = 6) -> Column:
    """ROUND(total / n, digits) for a sum of decimals (ratings, percentages).

    The sum is taken to ``fixed`` decimal places as a whole number first, then
    rounded exactly like ``round_ratio``.
    """
    f = 10 ** fixed
    return round_ratio(F.round(total * f).cast(WHOLE), n.cast("decimal(19,0)") * F.lit(f).cast("decimal(7,0)"),
                       digits)
