"""Draws without replacement: rows in a keyed random order, without a sort or a shuffle.

``permuted`` is a bijection of 0..n-1 for each seed: a number is written as a row and a column of a
table of a x b cells (a * b just over n), and four rounds add a keyed draw of the one to the other.
A result of n or more is permuted again (cycle walking) until it falls below n; at most a * b - n
cells lie outside, so a walk is short and always ends.  A row's place in the order follows from
its own number alone, so a sample, a shuffle or a split into equal folds needs no other row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumen.functions.draws import keyed_index
from lumen.operators.assemble import global_line_numbers

ROUNDS = 4
#: Walks longer than this raise; with 4,096 numbers or more one in 2^384 would be.
WALK = 64


def sides(n: int) -> tuple[int, int]:
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, -(-n // a) if n else 1


def one_pass(x: Column, n: int, seed: str) -> Column:
    """The bijection of 0..a*b-1."""
    a, b = sides(n)
    row, col = F.floor(x / F.lit(b)).cast("bigint"), F.pmod(x, F.lit(b))
    for r in range(ROUNDS):
        if r % 2:
            col = F.pmod(col + keyed_index(seed, F.lit(b), F.lit(r), row), F.lit(b))
        else:
            row = F.pmod(row + keyed_index(seed, F.lit(a), F.lit(r), col), F.lit(a))
    return row * F.lit(b) + col


def permuted(df: DataFrame, number: str, n: int, seed: str, name: str = "position") -> DataFrame:
    """``df`` with ``name``: the place of ``number`` (0..n-1) in a random order of 0..n-1."""
    out = df.withColumn(name, one_pass(F.col(number), n, seed))
    outside = math.prod(sides(n)) - n
    steps = F.sequence(F.lit(1), F.lit(max(1, min(outside, WALK))))
    walked = F.aggregate(steps, F.col(name), lambda x, _: F.when(x < n, x).otherwise(one_pass(x, n, seed)))
    lost = F.raise_error(F.lit("a walk did not end")).cast("bigint")
    out = out.withColumn(name, F.when(F.col(name) < n, F.col(name)).otherwise(walked)) if outside else out
    return out.withColumn(name, F.when(F.col(name) < n, F.col(name)).otherwise(lost)) if outside > WALK else out


def numbered(df: DataFrame, key: str) -> tuple[DataFrame, int]:
    """``df`` with ``__number`` 0..n-1 in order of ``key`` and n; unbroken integer keys need no sort."""
    low, high, n, distinct = df.agg(F.min(key), F.max(key), F.count(F.lit(1)), F.count_distinct(key)).first()
    if n and low is not None and high - low + 1 == n == distinct:
        return df.withColumn("__number", F.col(key) - F.lit(low)), n
    return global_line_numbers(df, [key], start=0, name="__number"), n


def folds(df: DataFrame, key: str, k: int, seed: str) -> DataFrame:
    """``df`` with ``position`` in a random order and ``fold``: k folds whose sizes differ by one at most."""
    rows, n = numbered(df, key)
    out = permuted(rows, "__number", n, seed).drop("__number")
    return out.withColumn("fold", F.floor(F.col("position") * F.lit(k) / F.lit(max(n, 1))).cast("int"))
