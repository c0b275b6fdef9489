"""Row formulas: guarded arithmetic, cyclic piecewise-linear maps, parity cells, quantising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def guarded_sqrt(x) -> Column:
    """sqrt(x) when x >= 0, else null: the guard is part of the expression, so no
    evaluation order of filters can make sqrt see a negative number."""
    x = _c(x)
    return F.when(x >= 0, F.sqrt(x))


def guarded_inverse(x, numerator: float = 1.0) -> Column:
    """numerator / x when x > 0, else null (never raises under ANSI mode)."""
    x = _c(x)
    return F.when(x > 0, F.lit(float(numerator)) / x)


def quantize_sqrt(x, x_max, levels: int = 255) -> Column:
    """floor(sqrt(x / x_max) * levels): square-root compression then quantising.

    Null where x is negative, or the maximum is not positive or not a number.
    """
    x, x_max = _c(x), _c(x_max)
    usable = (x >= 0) & (x_max > 0) & ~F.isnan(x) & ~F.isnan(x_max)
    return F.floor(F.sqrt(F.when(usable, x / F.when(x_max > 0, x_max))) * F.lit(float(levels))).cast("bigint")


def triangle_wave(phase, shift: float, low: float, high: float, period: float = 6.0) -> Column:
    """A periodic trapezoid between ``low`` and ``high``, shifted along the period.

    At distance d (around the period) from the phase ``shift`` it is ``high`` up to a sixth of the
    period, ``low`` from a third on, and linear between.
    """
    unit = F.lit(period / 6.0)
    at = F.pmod(_c(phase) - F.lit(float(shift)), F.lit(float(period)))
    distance = F.least(at, F.lit(float(period)) - at) / unit
    rise = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(2.0) - distance))
    return F.lit(low) + F.lit(high - low) * rise


def parity_even(*cells) -> Column:
    """True when the sum of the integer cell coordinates is even (checkerboard)."""
    total = None
    for c in cells:
        c = _c(c).cast("bigint")
        total = c if total is None else total + c
    return F.pmod(total, F.lit(2)) == 0
