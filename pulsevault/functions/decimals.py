"""Exact decimal arithmetic with half-up rounding.

The source engine keeps ``avg(decimal(p,s))`` at scale ``s`` with half-up rounding and
divides decimals at the larger operand scale. Spark widens both. To be exact at any
group size we average on unscaled longs: ``S = sum(x * 10^s)``, ``n = count(x)`` and
``mean = sign(S) * floor((2|S| + n) / (2n)) / 10^s`` — integer arithmetic only, all inside
whole-stage codegen, and partial-aggregatable (sum and count).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _unscaled(x: Column, scale: int) -> Column:
    # x is decimal(p, scale): x * 10^scale is an exact integer-valued decimal.
    return (x * F.lit(10**scale)).cast("long")


def _half_up_div(num: Column, den: Column) -> Column:
    """Exact round-half-up of num/den for longs, den > 0; returns long. Integral division throughout, so
    exact as long as 2|num| + den fits a long."""
    q = F.call_function("div", F.abs(num) * 2 + den, den * 2)
    return F.when(num < 0, -q).otherwise(q)


def dec_sum_parts(x, scale: int = 4) -> tuple[Column, Column]:
    """(sum of unscaled values, count of non-null values) — aggregate expressions.

    Usable in ``groupBy().agg`` and ``.over(window)`` alike.
    """
    x = _c(x)
    return F.sum(_unscaled(x, scale)), F.count(x)


def dec_mean_from_parts(s, n, scale: int = 4, precision: int = 10) -> Column:
    """Half-up mean at ``scale`` from unscaled sum ``s`` and count ``n``; NULL when n == 0."""
    s, n = _c(s), _c(n)
    q = _half_up_div(s, n)
    unit = F.lit(Decimal(1).scaleb(-scale))
    return F.when(n > 0, (q.cast("decimal(20,0)") * unit).cast(f"decimal({precision},{scale})"))


def avg_dec(x, scale: int = 4, precision: int = 10) -> Column:
    """Aggregate: exact half-up average of a decimal column, result decimal(precision, scale)."""
    s, n = dec_sum_parts(x, scale)
    return dec_mean_from_parts(s, n, scale, precision)


def round_ratio(num, den: Column, scale: int, precision: int, scale_out: int | None = None) -> Column:
    """Half-up ``num / den`` at ``scale`` decimals for integer num and positive integer den.

    Mirrors ``count * 100.0 / 288.0`` (one decimal) and ``count / 60.0`` in the source SQL.
    """
    num, den = _c(num), _c(den)
    q = _half_up_div(num.cast("long") * F.lit(10**scale), den.cast("long"))
    unit = F.lit(Decimal(1).scaleb(-scale))
    out = q.cast("decimal(20,0)") * unit
    return out.cast(f"decimal({precision},{scale if scale_out is None else scale_out})")


def dec_to_int(x) -> Column:
    """decimal -> integer with half-up rounding (the source engine rounds, Spark truncates)."""
    return F.round(_c(x), 0).cast("int")
