"""Arithmetic with defined rounding and defined zero denominators.

Measures have at most two decimals, so quotients, differences and sums are computed on
whole hundredths as LONG: exact, independent of summation order, and cheap in generated
code (no BigDecimal).  Public outputs are DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | int | float | Column) -> Column:
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(x)


def units(x: str | int | Column, scale: int = 2) -> Column:
    """The measure in whole units of ``10 ** -scale``."""
    return F.rint(_c(x).cast("double") * 10**scale).cast("long") if scale else _c(x).cast("long")


def from_units(x: Column, scale: int = 2) -> Column:
    return x.cast("double") / 10**scale


def quotient(num: Column, den: Column, scale: int) -> Column:
    """``num / den`` of two LONGs rounded half up (away from zero) to ``scale`` decimals,
    without a detour through binary fractions; NULL when ``den`` is 0 or NULL."""
    n, d = num.cast("long"), F.nullif(den.cast("long"), F.lit(0).cast("long"))
    size = F.call_function("div", F.abs(n) * (2 * 10**scale) + F.abs(d), F.abs(d) * 2)
    return from_units(F.when((n < 0) != (d < 0), -size).otherwise(size), scale)


def rounded(x: str | Column, scale: int) -> Column:
    return F.round(_c(x), scale).cast("double")


def ratio(num: str | int | Column, den: str | int | Column, scale: int, *, num_scale: int = 2, den_scale: int = 2) -> Column:
    """``round(num / den, scale)`` as double; NULL when the denominator is 0 or NULL."""
    n, d = units(num, num_scale), units(den, den_scale)
    if num_scale < den_scale:
        n = n * 10 ** (den_scale - num_scale)
    elif den_scale < num_scale:
        d = d * 10 ** (num_scale - den_scale)
    return quotient(n, d, scale)


def share(part: str | Column, whole: str | Column, scale: int = 1) -> Column:
    """Percentage of ``whole``; both are counts."""
    return ratio(_c(part).cast("long") * 100, whole, scale, num_scale=0, den_scale=0)


def exact_sum(x: str | Column, scale: int = 2) -> Column:
    """Order-independent sum of a measure with at most ``scale`` decimals."""
    return from_units(F.sum(units(x, scale)), scale)


def minus(a: str | Column, b: str | Column) -> Column:
    """``a - b`` in hundredths."""
    return from_units(units(a) - units(b))


def plus(a: str | Column, b: str | Column) -> Column:
    return from_units(units(a) + units(b))


def per90(x: str | Column, nineties: str | Column, scale: int = 2) -> Column:
    return ratio(x, nineties, scale)


def nineties(given: str | Column, minutes: str | Column) -> Column:
    """Full matches played: the given figure, else minutes / 90."""
    return F.coalesce(_c(given), ratio(F.coalesce(_c(minutes), F.lit(0)), 90, 2, num_scale=0, den_scale=0))


def zero(x: str | Column) -> Column:
    return F.coalesce(_c(x), F.lit(0))


def age_in(year: int, birth_year: str | Column) -> Column:
    return F.lit(year) - _c(birth_year)
