"""Exact decimal rounding on integer arithmetic.

PostgreSQL ``numeric`` division is exact and ``round`` is HALF_UP (away from
zero).  Spark decimal division keeps a bounded scale and DuckDB's returns a
double, so every ``round(a / b, k)`` of the marts is computed on integers:

    round(a / b) == sign(a) * sign(b) * ((2*|a| + |b|) div (2*|b|))

and the integer result is shifted into a DECIMAL by a multiplication with an
exact constant (``n * 0.01``), never by a division.  Callers pre-scale ``a`` (or
``b``) by the power of ten of the wanted scale.  Everything stays in LONG
arithmetic (whole-stage codegen, no BigDecimal); ANSI mode makes an overflow
raise instead of wrapping.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def idiv(a, b) -> Column:
    """Integral division truncating toward zero (SQL ``div``), LONG result."""
    return F.call_function("div", _c(a), _c(b))


def round_div(num, den) -> Column:
    """``round(num / den)`` HALF_UP away from zero as a LONG; NULL if an input is NULL.

    ``den`` must be non-zero (guard with ``when``/``nullif`` at the caller).
    """
    num, den = _c(num).cast("long"), _c(den).cast("long")
    q = idiv(F.abs(num) * 2 + F.abs(den), F.abs(den) * 2)
    negative = (num < 0) != (den < 0)
    return F.when(negative, -q).otherwise(q)


def to_decimal(n, scale: int, precision: int) -> Column:
    """LONG ``n`` read as ``n * 10^-scale`` in DECIMAL(precision, scale)."""
    n = _c(n).cast(T.DecimalType(20, 0))
    if scale:
        unit = F.lit(f"{10 ** -scale:.{scale}f}").cast(T.DecimalType(scale, scale))
        n = n * unit
    return n.cast(T.DecimalType(precision, scale))


def round_ratio(num, den, scale: int, precision: int) -> Column:
    """``round(num / den, scale)`` exactly, as DECIMAL(precision, scale)."""
    scaled = _c(num).cast("long") * F.lit(10 ** scale)
    return to_decimal(round_div(scaled, den), scale, precision)
