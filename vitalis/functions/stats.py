"""Order-independent averages.

A floating-point sum depends on the order rows are added, which on a cluster
depends on partitioning and task timing, so ``avg`` of the same data can
differ in the last bits between runs.  ``fixed_avg`` sums the values as
integers of 10**-(digits+3) units (DECIMAL(38,0): no overflow below about
10**26 rows of values under 10**3) and divides with exact half-up rounding
to ``digits`` decimals.  The result is the same for every partitioning,
every run and every engine that does the same integer steps.  NaN, infinite
and huge values (from ``HUGE`` on) can't be counted in units: if there is one,
the result is what plain ``avg`` gives.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GUARD = 3  # extra decimals kept in the sum before the final rounding
HUGE = 1e15  # values from here on are summed as doubles


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ordinary(col) -> Column:
    """Is the value one that can be counted in units (not NaN, infinite or huge)?"""
    return F.abs(_c(col)) < HUGE  # NaN is above everything


def scaled(col, decimals: int) -> Column:
    """Value as an integer count of 10**-decimals units (DECIMAL(38,0)); NULL if it isn't ordinary."""
    return F.when(ordinary(col), F.round(_c(col) * F.lit(float(10**decimals))).cast("decimal(38,0)"))


def odd_sum(col) -> Column:
    """Sum, as a double, of the values that ``scaled`` leaves out (NULL if there is none)."""
    return F.sum(F.when(~ordinary(col), _c(col)))


def fixed_avg(col, digits: int = 6, over=None) -> Column:
    """Average of ``col`` rounded half up to ``digits`` decimals (an exact tie
    goes toward +infinity: floor(x + 1/2)).

    Inputs are quantised to ``digits + 3`` decimals, summed exactly and divided
    exactly.  ``over``: a window spec, for a frame average.  NULLs are
    ignored and an all-NULL (or empty) input gives NULL, as with ``avg``.
    """
    def ov(c: Column) -> Column:
        return c.over(over) if over is not None else c

    return fixed_avg_finish(ov(fixed_avg_sum(col, digits)), ov(F.count(_c(col))), digits, ov(odd_sum(col)))


def fixed_avg_sum(col, digits: int = 6) -> Column:
    """The exact-sum part of ``fixed_avg`` (to share one aggregate between outputs)."""
    return F.sum(scaled(col, digits + GUARD))


def fixed_avg_finish(s: Column, count: Column, digits: int = 6, odd: Column | None = None) -> Column:
    """``fixed_avg`` from its exact sum (``fixed_avg_sum``), non-NULL count and ``odd_sum``."""
    n = count.cast("decimal(20,0)")
    k = F.lit(10**GUARD).cast("decimal(20,0)")
    num = s * F.lit(2) + n * k
    den = n * k * F.lit(2)
    q = (num - F.pmod(num, den)) / den
    exact = F.when(n > 0, q.cast("double") / F.lit(float(10**digits)))
    if odd is None:
        return exact
    plain = (odd + F.coalesce(s.cast("double"), F.lit(0.0)) / F.lit(float(10 ** (digits + GUARD)))) / count
    return F.when(odd.isNotNull(), plain).otherwise(exact)


def avg_col(col, digits: int | None = None, over=None) -> Column:
    """``avg`` when ``digits`` is None, else the fixed-point average."""
    if digits is None:
        c = F.avg(_c(col))
        return c.over(over) if over is not None else c
    return fixed_avg(col, digits, over)


def fixed_avg_sql(col: str, digits: int = 6) -> str:
    """``fixed_avg`` as Spark SQL text, for queries written in SQL."""
    unit, k = float(10 ** (digits + GUARD)), 10**GUARD
    plain = f"ABS({col}) < {HUGE:.0f}D"
    s = f"SUM(CASE WHEN {plain} THEN CAST(ROUND({col} * {unit}) AS DECIMAL(38,0)) END)"
    n = f"CAST(COUNT({col}) AS DECIMAL(20,0))"
    num, den = f"({s} * 2 + {n} * {k})", f"({n} * {k} * 2)"
    return (
        f"CASE WHEN COUNT(CASE WHEN NOT {plain} THEN 1 END) > 0 THEN AVG({col}) WHEN COUNT({col}) > 0 THEN "
        f"CAST(({num} - pmod({num}, {den})) / {den} AS DOUBLE) / {float(10**digits)} END"
    )
