"""Range join: points x against intervals low <= x < high, as one equi-join.

An interval of length up to 2^k lies in at most two cells of size 2^k.  Each interval goes to its
own level k, the next even one (a level more for points costs more than a wider cell), and to the
one or two cells it touches there; each point goes to its cell at every level that any interval
uses (at most 33, read off the intervals).  Short and long intervals so
share one equi-join on (keys, level, cell), and a recheck keeps the exact range.  A point lies in
one cell of a level, so no pair is made twice, and an interval that covers everything is one row
or two, not one for each cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVEL, CELL = "__level", "__cell"


def with_cells(intervals: DataFrame, low: str, high: str) -> DataFrame:
    """The non-empty intervals with level and cell, a row for each cell."""
    held = intervals.where(F.col(low) < F.col(high))
    # the number of bits of length - 1: the least k with length <= 2^k; from there the next even one
    last = F.col(high) - F.col(low) - 1
    bits = F.when(last == 0, F.lit(0)).otherwise(F.length(F.bin(last)))
    held = held.withColumn(LEVEL, F.least(bits + bits % 2, F.lit(63)))
    first, end = F.expr(f"shiftright(`{low}`, {LEVEL})"), F.expr(f"shiftright(`{high}` - 1, {LEVEL})")
    return held.withColumn(CELL, F.explode(F.array_distinct(F.array(first, end))))


def levels_of(cells: DataFrame) -> list[int]:
    """The levels in use, at most 33."""
    return sorted(r[0] for r in cells.select(LEVEL).distinct().collect())


def met_in_cells(points: DataFrame, cells: DataFrame, levels: list[int], *, point: str, low: str, high: str, keys: list[str]) -> DataFrame:
    """Points joined to the intervals of :func:`with_cells` that hold them; ``levels``: those in use."""
    places = F.array(*[F.struct(F.lit(k).alias(LEVEL), F.shiftright(point, k).alias(CELL)) for k in levels])
    places = places if levels else F.array().cast(f"array<struct<{LEVEL}:int,{CELL}:bigint>>")
    spread = points.where(F.col(point).isNotNull()).select("*", F.inline(places))
    met = spread.join(cells, [*keys, LEVEL, CELL])
    return met.where((F.col(low) <= F.col(point)) & (F.col(point) < F.col(high))).drop(LEVEL, CELL)


def range_join(points: DataFrame, intervals: DataFrame, *, point: str, low: str, high: str, on: list[str] | None = None) -> DataFrame:
    """Points joined to the intervals that hold them: ``low <= point < high`` and equal ``on`` columns.

    ``point``, ``low`` and ``high`` are bigint columns (times as microseconds or days) whose
    differences fit a bigint.  Empty intervals and nulls match nothing; other column names must differ.
    """
    keys = list(on or [])
    cells = with_cells(intervals, low, high)
    levels = levels_of(cells)
    if not levels:
        return points.join(intervals.where("false"), keys) if keys else points.crossJoin(intervals.limit(0))
    return met_in_cells(points, cells, levels, point=point, low=low, high=high, keys=keys)
