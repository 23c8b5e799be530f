"""Column helpers for the missing-value discipline of the valuation chain.

NULL is the only missing marker. NaN never leaves an operator (Spark orders NaN
above every number and ``avg``/``median`` do not skip it). Infinity is kept
mid-chain on purpose (zero shares give +/-inf EPS) and removed at one defined
point by ``clean_inf``.

All helpers are plain Column expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def _dbl_null() -> Column:
    return F.lit(None).cast("double")


def null_if_zero(c: Column) -> Column:
    """0 -> NULL, NULL stays NULL."""
    return F.when(c != 0, c)


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, _dbl_null())


def clean_inf(c: Column) -> Column:
    """+/-inf -> NULL (and NaN -> NULL)."""
    return F.when(F.abs(c) != F.lit(INF), nan_to_null(c))


def ieee_div(n: Column, d: Column) -> Column:
    """Division with IEEE results instead of ANSI errors.

    x/0 -> +inf or -inf by the sign of x, 0/0 -> NULL, NULL operand -> NULL.
    ``try_divide`` would give NULL for x/0, which a later forward fill would
    replace with the previous value -- a different answer.
    """
    return (F.when(n.isNull() | d.isNull(), _dbl_null())
            .when(d != 0, n / d)
            .when(n > 0, F.lit(INF))
            .when(n < 0, F.lit(-INF)))


def round_dp(c: Column, dp: int) -> Column:
    """Round half to even on the scaled value, like numpy ``around``."""
    scale = float(10 ** dp)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def round2(c: Column) -> Column:
    return round_dp(c, 2)


def positive_or_null(c: Column) -> Column:
    return F.when(c > 0, c)


def null_first_min(a: Column, b: Column) -> Column:
    """Python ``min(a, b)`` on floats: NULL first -> NULL, NULL second -> a."""
    return F.when(a.isNull(), _dbl_null()).when(b.isNull(), a).otherwise(F.least(a, b))


def false_if_null(c: Column) -> Column:
    """A comparison with a missing operand is False, not NULL."""
    return F.coalesce(c, F.lit(False))
