"""Top row(s) per key.

``row_number``/``rank`` filtered to the top n plans as a Window with a *partial*
WindowGroupLimit before the shuffle: every map task keeps at most n rows per key, so a key
holding a third of the table ships only n rows per task, not its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1,
                with_ties: bool = False) -> DataFrame:
    """Rows ranked 1..n per key by ``order``; ``with_ties`` keeps every row tied at rank n."""
    if n < 1:
        raise ValueError("n must be at least 1")
    w = Window.partitionBy(*keys).orderBy(*order)
    rk = (F.rank() if with_ties else F.row_number()).over(w)
    return df.withColumn("__rk", rk).where(F.col("__rk") <= n).drop("__rk")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key by ``order`` (descending, all columns form the tie-break)."""
    return top_per_key(df, keys, [F.col(c).desc() for c in order])


def rows_at_group_max(df: DataFrame, keys: list[str], by: str) -> DataFrame:
    """All rows whose ``by`` equals the maximum of their key (ties kept)."""
    return top_per_key(df, keys, [F.col(by).desc()], with_ties=True)


def dedup_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first by ``order`` (a total order makes it deterministic)."""
    return top_per_key(df, keys, [F.col(c).asc() for c in order])
