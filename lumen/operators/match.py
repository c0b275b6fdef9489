"""Nearest valid match between probe rows and a catalogue (theta join + best per probe).

The catalogue is packed into blocks of at most ``block_rows`` entries, one row for each block.
Every probe meets every block by an equi-join on the block's number; inside a block one fold
keeps the best entry, so no probe x catalogue rows are made.  The best over the blocks is a
minimum per probe with map-side partial aggregates.  One block or five thousand: the same plan.

A score that is null or NaN is no match.  A probe without any match stays, with a null result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumen.functions.vectors import let
from lumen.operators.assemble import global_line_numbers
from lumen.operators.lineage import cut

BLOCK_ROWS = 512


def blocks_of(catalogue: DataFrame, order_key: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(block, entries): the catalogue in order of ``order_key``, ``block_rows`` entries to a row."""
    numbered = global_line_numbers(catalogue, [order_key], start=0, name="__row")
    entry = F.struct("__row", F.struct(*catalogue.columns).alias("item"))
    return cut(numbered.groupBy(F.floor(F.col("__row") / block_rows).cast("bigint").alias("block"))
               .agg(F.array_sort(F.collect_list(entry)).alias("entries")))


def nearest_in_blocks(probes: DataFrame, probe_key: str, catalogue: DataFrame, *, order_key: str,
                      score: Callable[[Column], Column], item: str, carry: list[str] | None = None,
                      block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(probe_key, carry..., score, item): for each probe the catalogue entry with the least score.

    Ties go to the least ``order_key``.  ``score(entry)`` receives an entry as a struct and may use
    the probe's columns.  ``probe_key`` identifies a probe; ``item`` is the entry's column returned.
    """
    blocks = blocks_of(catalogue, order_key, block_rows)
    n_blocks = blocks.count()
    carried = [probe_key, *(carry or [])]
    item_type = dict(catalogue.dtypes)[item]
    if n_blocks == 0:
        return probes.select(*carried, F.lit(None).cast("double").alias("score"), F.lit(None).cast(item_type).alias(item))
    start = F.lit(None).cast(f"struct<score:double,row:bigint,item:{item_type}>")

    def merge(best: Column, entry: Column) -> Column:
        def pick(s: Column) -> Column:
            better = s.isNotNull() & ~F.isnan(s) & (best.isNull() | (s < best["score"]))
            found = F.struct(s.alias("score"), entry["__row"].alias("row"), entry["item"][item].alias("item"))
            return F.when(better, found).otherwise(best)
        return let(score(entry["item"]).cast("double"), pick)

    met = (probes.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))))
           .join(blocks, "block"))
    folded = met.select(*carried, F.aggregate("entries", start, merge).alias("best"))
    return (folded.groupBy(*carried).agg(F.min("best").alias("best"))
            .select(*carried, F.col("best.score").alias("score"), F.col("best.item").alias(item)))
