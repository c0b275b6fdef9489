"""Reproducible draws keyed by row identity.

``rand(seed)`` depends on how rows fall into partitions, so two runs (or a re-executed task
after an executor loss) can draw different numbers.  A keyed draw hashes
``seed | key | draw-number`` instead: the same row always gets the same number, on any
cluster shape, and a lost task recomputes exactly what it produced before.

u = first 52 bits of md5(seed|key...|i) / 2^52, uniform in [0, 1): every double it takes is exact
and any table's keys can be reached.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS, RANGE = 13, float(1 << 52)


def keyed_uniform(seed: str, *keys) -> Column:
    parts = [F.lit(str(seed))] + [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    h = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(h, 1, DIGITS), 16, 10).cast("bigint") / F.lit(RANGE)


def keyed_index(seed: str, n, *keys) -> Column:
    """Uniform integer in [0, n) from a keyed draw."""
    n_col = n if isinstance(n, Column) else F.lit(n)
    return F.floor(keyed_uniform(seed, *keys) * n_col).cast("bigint")


def sql_keyed_uniform(seed: str, *key_exprs: str) -> str:
    """DuckDB twin of :func:`keyed_uniform` (same bits)."""
    parts = ", ".join([f"'{seed}'"] + [f"CAST({k} AS VARCHAR)" for k in key_exprs])
    return f"(('0x' || substr(md5(concat_ws('|', {parts})), 1, {DIGITS}))::BIGINT / {RANGE})"


def by_cut_points(u, labels: list[str], cuts: list[float]) -> Column:
    """Weighted category: labels[i] when u < cuts[i] (cuts ascending), else the last label."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one more label than cut points")
    u = F.col(u) if isinstance(u, str) else u
    expr = F.when(u < F.lit(cuts[0]), F.lit(labels[0]))
    for lab, cut in zip(labels[1:-1], cuts[1:]):
        expr = expr.when(u < F.lit(cut), F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))
