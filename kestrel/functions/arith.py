"""Python-flavoured arithmetic as Column expressions.

Spark's ``div`` truncates and ``%`` keeps the dividend's sign; Python floors.
ANSI mode raises on any division by zero, doubles included, so the
"NaN/inf instead of an error" forms go through ``try_divide`` or IEEE
arithmetic done on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(c)


def floor_div(a, b) -> Column:
    """Python ``a // b`` for integers: floor, not truncation. Raises on b = 0."""
    return int_floor_div(a, b)


def int_floor_div(a, b) -> Column:
    """Exact Python ``a // b`` for integer columns (or constants): integral
    ``div`` truncates, so one is taken off when the remainder is non-zero
    and the signs differ.  No detour through double, so 64-bit keys stay
    exact.  Raises on ``b = 0``, as Python does."""
    a, b = _col(a), _col(b)
    q = F.call_function("div", a, b)
    r = a - q * b
    return F.when((r != 0) & ((r < 0) != (b < 0)), q - 1).otherwise(q)


def py_mod(a, b) -> Column:
    """Python ``a % b``: result takes the sign of the divisor."""
    a, b = _col(a), _col(b)
    r = a % b
    return F.when((r != 0) & ((r < 0) != (b < 0)), r + b).otherwise(r)


def nan_to_null(c) -> Column:
    """NaN becomes NULL so that ``sum``/``avg`` skip it (``nansum``)."""
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def nansum(c) -> Column:
    """Aggregate: sum that skips NaN (and NULL)."""
    return F.sum(nan_to_null(c))


def ieee_divide(a, b) -> Column:
    """Double division with IEEE results (inf, -inf, NaN) instead of an
    ANSI error when the divisor is zero."""
    a, b = _col(a).cast("double"), _col(b).cast("double")
    inf = F.lit(float("inf"))
    by_zero = (F.when(F.isnan(a) | (a == 0), F.lit(float("nan")))
               .when(a > 0, inf).otherwise(-inf))
    return F.when(b == 0, by_zero).otherwise(a / b)


def round_half_away(c, digits: int) -> Column:
    """Round a double to ``digits`` decimals the way SQL engines that scale
    first do it: ``sign(x) * floor(|x| * 10^d + 0.5) / 10^d`` (half away
    from zero on the scaled double).  Spark's ``round`` rounds the double's
    exact decimal expansion instead, which differs on values whose scaled
    double lands exactly on .5; using the same arithmetic keeps results
    comparable digit for digit.  From 2^52 on the scaled double has no
    fraction left to round: such values, infinities and NaN come back as
    they are."""
    x = _col(c).cast("double")
    scale = float(10 ** digits)
    scaled = F.abs(x) * F.lit(scale)
    return F.when(scaled < F.lit(2.0 ** 52), F.signum(x) * F.floor(scaled + F.lit(0.5)) / F.lit(scale)).otherwise(x)
