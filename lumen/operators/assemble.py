"""Ordered assembly of rows: per-group documents and globally numbered lines.

* ``ordered_concat``: one text per group, parts joined in a given order.  The group's text
  is the result itself, so the group must fit one row; nothing else is gathered.
* ``global_line_numbers``: 1..N over a total order without a single-partition window.
  Rows are range-partitioned and sorted inside each partition; each partition's row count
  (one row per partition) gives its offset; within a partition the number follows from
  ``monotonically_increasing_id``, which counts up in the sorted order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from lumen.operators.lineage import cut


def ordered_concat(df: DataFrame, keys: list[str], order: str, text: Column, sep: str = "\n") -> DataFrame:
    """(keys..., n_parts, text): parts of each group joined by ``sep`` in ``order``."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("t"))))
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_parts"),
        F.array_join(F.transform(parts, lambda x: x["t"]), sep).alias("text"))


def global_line_numbers(df: DataFrame, order: list[str], *, start: int = 1, n_partitions: int | None = None,
                        name: str = "line_no") -> DataFrame:
    """Add ``name`` = position of each row in the total order ``order`` (starting at ``start``)."""
    # checkpoint pins the range split: the counts and the numbering read the same partitions
    # (AQE may merge adjacent ranges when no count is given; the order is kept)
    by_range = df.repartitionByRange(n_partitions, *order) if n_partitions else df.repartitionByRange(*order)
    ranged = cut(by_range.sortWithinPartitions(*order)
                 .withColumn("__pid", F.spark_partition_id())
                 .withColumn("__mid", F.monotonically_increasing_id()))
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__m0"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: bounded by the partition count, so broadcasting it is safe
    offsets = counts.select("__pid", "__m0", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    out = ranged.join(F.broadcast(offsets), "__pid")
    return out.select(*df.columns,
                      (F.col("__mid") - F.col("__m0") + F.col("__off") + F.lit(start)).alias(name))


def running_total(df: DataFrame, order: list[str], value: str, name: str, number: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` (bigint) over the rows before in the order, and ``number``,
    the count of them, from 0.

    Rows are range-partitioned and sorted; each task adds up its own rows in order, and one row for
    each partition gives what comes before it.  The order must be total up to equal values.
    """
    schema = StructType([*df.schema.fields, StructField("__pid", IntegerType()), StructField("__sum", LongType()), StructField("__no", LongType())])
    at = df.columns.index(value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, rows, pid = 0, 0, TaskContext.get().partitionId()
        for batch in batches:
            values = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            upto = before + np.cumsum(values)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(values), pid, np.int32)), pa.array(upto - values),
                                              pa.array(rows + np.arange(len(values)))], names=schema.names)
            before, rows = int(upto[-1]) if len(upto) else before, rows + len(values)

    ranged = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema))
    parts = ranged.groupBy("__pid").agg(F.max(F.col("__sum") + F.col(value)).alias("__s"), F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: bounded by the partition count, so broadcasting it is safe
    offsets = parts.select("__pid", F.coalesce(F.sum("__s").over(w), F.lit(0)).alias("__s0"), F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__n0"))
    return (ranged.join(F.broadcast(offsets), "__pid")
            .select(*df.columns, (F.col("__sum") + F.col("__s0")).alias(name), (F.col("__no") + F.col("__n0")).alias(number)))
