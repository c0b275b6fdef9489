"""Numeric helpers that make results identical across engines and partitionings.

``snap``: fixed-point snap ``floor(x * 10^d + 0.5) / 10^d`` for doubles whose value depends on
summation order (means of means, centroids); NaN and values too large to snap pass.  Sums and
means that do not depend on order are in :mod:`lumen.operators.exact`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


SNAP_LIMIT = 9e12


def snap(x, digits: int = 6) -> Column:
    x, scale = _c(x).cast("double"), float(10 ** digits)
    return F.when(F.isnan(x) | (F.abs(x) > SNAP_LIMIT * 1e6 / scale), x).otherwise(F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale))


def sql_snap(expr: str, digits: int = 6) -> str:
    """DuckDB spelling of :func:`snap`."""
    scale = f"CAST(1e{digits} AS DOUBLE)"
    return f"(floor(({expr}) * {scale} + 0.5) / {scale})"
