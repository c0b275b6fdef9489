"""Routing rows by type with per-route formulas.

``route`` is the single-pass form: one CASE for the route name and one for the value, so
the input is scanned once and every row lands in exactly one route (the first whose
condition holds, else the default).  ``route_and_union`` is the literal form (one filtered
branch per route, then UNION ALL); use it only when branches need different shapes, since
each branch re-reads its input.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def route(df: DataFrame, routes: list[tuple[str, Column, Column]], default: tuple[str, Column],
          name: str = "route", value: str = "amount") -> DataFrame:
    """Add ``name`` and ``value`` columns from ordered (route, condition, value) triples."""
    r_expr = v_expr = None
    for label, cond, val in routes:
        r_expr = F.when(cond, F.lit(label)) if r_expr is None else r_expr.when(cond, F.lit(label))
        v_expr = F.when(cond, val) if v_expr is None else v_expr.when(cond, val)
    return df.withColumns({name: r_expr.otherwise(F.lit(default[0])), value: v_expr.otherwise(default[1])})


def route_and_union(df: DataFrame, routes: list[tuple[str, Column, callable]],
                    default: tuple[str, callable], name: str = "route") -> DataFrame:
    """Branch-per-route form: each branch is ``transform(rows of that route)``; the default
    branch takes the rows no earlier condition matched.  All branches must share a schema."""
    taken = F.lit(False)
    branches = []
    for label, cond, transform in routes:
        mine = df.where(~taken & F.coalesce(cond, F.lit(False)))
        branches.append(transform(mine).withColumn(name, F.lit(label)))
        taken = taken | F.coalesce(cond, F.lit(False))
    label, transform = default
    branches.append(transform(df.where(~taken)).withColumn(name, F.lit(label)))
    return reduce(lambda a, b: a.unionByName(b), branches)
