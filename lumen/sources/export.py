"""Ordered text export.

``write_ordered_text`` writes one line per row so that the part files, read in name order,
give the lines in global order: rows are range-partitioned on the order column (each file
holds one contiguous range) and sorted within each partition.  No single task ever holds
the whole document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumen.operators.assemble import running_total


def write_ordered_text(df: DataFrame, order: str, text: str, path: str, n_files: int | None = None,
                       mode: str = "overwrite") -> None:
    n = n_files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, F.col(order)).sortWithinPartitions(order)
     .select(F.col(text).alias("value")).write.mode(mode).text(path))


def with_offsets(df: DataFrame, order: list[str], line: str) -> DataFrame:
    """``df`` with ``line_no`` and ``byte_start``: where each line lies in the text of all lines in order.

    Every line ends with a line feed, one byte; null lines count as empty.  Offsets come from byte counts
    summed in each range partition and over the partitions: no step sees all lines.
    """
    sized = df.withColumn("__bytes", F.octet_length(F.coalesce(line, F.lit(""))).cast("bigint") + 1)
    return running_total(sized, [*order, line], "__bytes", "byte_start", "line_no").drop("__bytes")


def write_document(df: DataFrame, order: list[str], line: str, path: str) -> DataFrame:
    """Write the lines in order as text files under ``path`` that are one document, with random access.

    Returns and writes (to ``path``/_index) a row for each file: its number (as in its name), the
    document's byte and line where it begins, and how many it holds.  A byte of the document lies in
    the last file that begins at or before it, at the difference.
    """
    placed = with_offsets(df, order, line)
    files = placed.select(F.coalesce(line, F.lit("")).alias("value"), "byte_start", "line_no", F.spark_partition_id().alias("file"))
    files.select("value").write.text(path)
    size = F.octet_length("value").cast("bigint") + 1
    index = files.groupBy("file").agg(F.min("byte_start").alias("byte_start"), F.sum(size).alias("bytes"), F.min("line_no").alias("line_no"),
                                      F.count(F.lit(1)).alias("lines"))
    index.coalesce(1).write.parquet(f"{path}/_index")           # a row for each file
    return df.sparkSession.read.schema(index.schema).parquet(f"{path}/_index")
