"""Intermediate tables of the text operators.

They are Parquet tables in the folder that ``spark.checkpoint.dir`` names, so they cut
lineage and outlive any executor.  Those of one run lie in a ``workspace`` and go with it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumen.session import ensure_checkpoint_dir

#: Bits that ``maybe_among`` gives an id, the power of two of all at most, and those of one bitmap row (Spark's).
BITS, MOST_BITS, BLOCK = 16, 27, 1 << 15


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, or in a ``workspace`` there, read back with its own schema."""
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def workspace(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder in the shared folder for the tables of one run, deleted at its end.

    What is read afterwards must be ``written`` outside of it before.
    """
    folder = shared_path(spark, name)
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_of(column: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def maybe_among(df: DataFrame, column: str, ids: DataFrame, name: str) -> DataFrame:
    """``df`` with a boolean ``name``: false only if ``column`` is none of ``ids`` (one column, each once).

    The hashes of the ids are bits of ``BITS`` to an id, ``MOST_BITS`` at most, so what is broadcast is
    bounded; with more ids more rows are true by chance.  An exact join of the true rows follows,
    and wide rows that are false need no shuffle.  A null is false.
    """
    key = ids.columns[0]
    bits = 1 << max(15, min(MOST_BITS, (BITS * ids.count() - 1).bit_length()))
    place = {c: F.when(F.col(c).isNotNull(), F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(bits))) for c in (column, key)}
    maps = (ids.where(F.col(key).isNotNull()).select(F.floor(place[key] / BLOCK).alias("__block"), F.pmod(place[key], F.lit(BLOCK)).alias("__at"))
            .groupBy("__block").agg(F.bitmap_construct_agg("__at").alias("__bits")))
    # a byte of the bitmap as a number, and its bit
    byte = F.conv(F.hex(F.substring("__bits", F.floor(F.col("__at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod("__at", F.lit(8)))), F.lit(2)) == 1
    return (df.withColumns({"__block": F.floor(place[column] / BLOCK), "__at": F.pmod(place[column], F.lit(BLOCK))})
            .join(F.broadcast(maps), "__block", "left").withColumn(name, F.coalesce(held, F.lit(False))).drop("__block", "__at", "__bits"))


def thinned(df: DataFrame, key: str, n: int, total: int) -> DataFrame:
    """About 2n of about ``total`` rows, by the hash of ``key``."""
    share = min(1.0, 2 * n / max(total, 1))
    return df.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) <= int(share * (1 << 30)))


def drawn(df: DataFrame, key: str, n: int, total: int) -> DataFrame:
    """Up to ``n`` rows of about ``total``, the ones with the least hash of ``key``.

    Rows are first thinned to about 2n by their hash, so that tasks hand on a few rows each
    however many tasks there are.
    """
    return thinned(df, key, n, total).orderBy(F.pmod(F.xxhash64(key), F.lit(1 << 30)), key).limit(n)
