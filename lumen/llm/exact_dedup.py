"""Exact dedup by an extendible-hash index on shared files.

The index maps the 64-bit hash of a text to its entry.  A *directory* of 2^g cells (g: global
depth, the top g bits of the hash) points to *buckets*; a bucket of local depth l owns the key
range of one l-bit prefix.  While a bucket holds more than ``capacity`` distinct keys the
directory doubles and only overfull buckets split; every other bucket is then pointed to by
two cells.  Copies of a text share one key, so a hot group never overfills a bucket.

Entries are made by grouping on (bucket, key, text): Spark compares the grouping key byte by
byte, so texts that collide on the 64-bit hash stay apart, and copies are merged on the map
side before the shuffle.  The task that owns a bucket's key range chains colliding entries
and writes them to the index table.  Each document then looks its entry up by (key, SHA-256).

Defined cases: null text is the empty text, and empty texts are equal to one another.  A null
doc_id counts in its group's size and is kept only if the group has no other id.  Rows that
repeat a doc_id are all returned.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from lumen.llm.shared import text_of, written

#: Distinct keys a bucket holds before it splits.
CAPACITY = 16_384
#: Bound of the directory: 2^16 cells of 12 bytes, small enough to broadcast at any input size.
MAX_DEPTH = 16


def _cell(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth)


def build_directory(keys: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> tuple[DataFrame, int]:
    """Directory (cell, local_depth, bucket) over the distinct ``key`` column, and its global depth.

    The capacity grows with the keys where 2^max_depth cells could not hold them; buckets that
    are still overfull at the last depth stay longer, nothing is left out.
    """
    spark = keys.sparkSession
    fine = written(keys.groupBy(_cell(F.col("key"), max_depth).alias("fine")).agg(F.count("*").alias("n")), "cells")
    total = fine.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    capacity = max(capacity, math.ceil(total / 2 ** (max_depth - 3)))
    depth = min(max_depth, max(1, math.ceil(math.log2(max(total / capacity, 1)))))
    directory = spark.range(2**depth).select(F.col("id").alias("cell"), F.lit(depth).alias("local_depth"))
    while depth < max_depth:
        full = (fine.groupBy(F.shiftrightunsigned("fine", max_depth - depth).alias("cell"))
                .agg(F.sum("n").alias("n")).where(F.col("n") > capacity).select("cell", F.lit(True).alias("full")))
        splits = F.coalesce(F.col("full"), F.lit(False)) & (F.col("local_depth") == depth)
        marked = written(directory.join(full, "cell", "left").select("cell", "local_depth", splits.alias("splits")), "directory")
        if marked.where("splits").isEmpty():
            break
        directory = marked.select(F.explode(F.array(F.col("cell") * 2, F.col("cell") * 2 + 1)).alias("cell"),
                                  (F.col("local_depth") + F.col("splits").cast("int")).alias("local_depth"))
        depth += 1
    # a bucket is named by its depth and prefix
    prefix = F.expr(f"shiftrightunsigned(cell, {depth} - local_depth)")
    bucket = F.shiftleft(F.col("local_depth").cast("long"), max_depth).bitwiseOR(prefix)
    return written(directory.select("cell", "local_depth", bucket.alias("bucket")), "directory"), depth


def build_index(rows: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    """Index entries (bucket, key, chain, text_sha256, keep_id, group_size) of rows (doc_id, text, key)."""
    entries = (rows.withColumn("cell", _cell(F.col("key"), depth))
               .join(F.broadcast(directory), "cell")                  # 2^MAX_DEPTH cells at most
               .groupBy("bucket", "key", "text")
               .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
               .select("bucket", "key", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"))
    chain = F.row_number().over(W.Window.partitionBy("bucket", "key").orderBy("text_sha256"))
    owned = entries.repartition("bucket").withColumn("chain", chain)
    return written(owned, "hash-index")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                max_depth: int = MAX_DEPTH, key_of=F.xxhash64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``key_of`` maps the text column to a long; it only decides where an entry lies.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).withColumn("key", key_of(F.col("text")))
    keys = rows.select("key").distinct()
    directory, depth = build_directory(keys, capacity, max_depth)
    index = build_index(rows, directory, depth).select("key", "text_sha256", "keep_id", "group_size")
    slim = rows.select("doc_id", "key", F.sha2("text", 256).alias("text_sha256"))
    # one entry per text; a hot text's documents are split by the adaptive skew join
    return slim.join(index, ["key", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
