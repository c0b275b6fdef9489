"""Weighted draws from a table of weights: an alias table, built and used as Spark joins.

n items with whole-number weights of sum W get n slots of W units each.  An item of weight w has
n * w units: a light one (up to W) fills a part of its own slot and leaves a gap, a heavy one
(over W) has a surplus.  Gaps of the light items and surpluses of the heavy ones, each laid out
one after the other, are two divisions of one line, since their sums are equal.  A gap is filled by
the heavy item whose surplus lies at the gap's beginning; where the gap runs over that surplus's
end, the heavy item lacks the rest in its own slot, and the next heavy item fills that.  So each
slot holds two items at most, and a draw is one slot, one point in it and one lookup, however
many items there are.

The running sums come from range partitions and their totals, the meetings of the two divisions from
range joins: no step runs in one task or on the driver.  All arithmetic is whole, in decimals of
38 digits, so an item's chance is exactly its weight's share, up to the draw's 52 bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumen.functions.draws import keyed_index, keyed_uniform
from lumen.operators.assemble import running_total
from lumen.operators.lineage import write_round
from lumen.operators.ranges import range_join


def alias_table(weights: DataFrame) -> tuple[DataFrame, int, int]:
    """((slot, own, item, other), number of slots, units of a slot) of rows (item, weight).

    In a slot ``item`` has the first ``own`` units, ``other`` the rest.  Weights are bigints of 0 or
    more; items with a null or zero weight are never drawn; n * W must fit a bigint.  Raises where
    no item has a weight.
    """
    held, n = write_round(weights.where("weight > 0").select("item", F.col("weight").cast("bigint").alias("weight")))
    if weights.where("weight < 0").limit(1).count():
        raise ValueError("a weight is negative")
    if not n:
        raise ValueError("no item has a weight")
    each = int(held.agg(F.sum(F.col("weight").cast("decimal(38,0)"))).first()[0])
    if n * each >= 1 << 63:
        raise ValueError("number of items times sum of weights must be below 2^63")
    units = held.withColumn("units", F.col("weight") * F.lit(n)).drop("weight")
    light = running_total(units.where(F.col("units") <= each).withColumn("gap", F.lit(each) - F.col("units")), ["item"], "gap", "gap_at", "number")
    heavy = running_total(units.where(F.col("units") > each).withColumn("surplus", F.col("units") - F.lit(each)), ["item"], "surplus", "low", "rank")
    light, n_light = write_round(light)
    heavy = heavy.withColumn("high", F.col("low") + F.col("surplus"))
    heavy, _ = write_round(heavy.select(F.col("item").alias("other"), "rank", "low", "high"))
    # the heavy item at the beginning of each gap
    gaps = light.where("gap > 0").select("item", "number", "gap_at", "gap", F.lit(each).alias("each"))
    filled = range_join(gaps, heavy.select("other", "low", "high"), point="gap_at", low="low", high="high")
    full = light.where("gap = 0")
    # the gap that holds the end of each surplus: what it runs over, the next heavy item fills
    spans = gaps.select("gap_at", (F.col("gap_at") + F.col("gap")).alias("gap_end"))
    ends = heavy.select("other", "rank", "high")
    over = range_join(ends, spans, point="high", low="gap_at", high="gap_end").select("rank", (F.col("gap_end") - F.col("high")).alias("lack"), "gap_at", "high")
    lacking = over.where("gap_at < high").select("rank", "lack")
    following = heavy.select((F.col("rank") - 1).alias("rank"), F.col("other").alias("next"))
    whole = heavy.join(lacking, "rank", "left").join(following, "rank", "left")
    lack = F.coalesce("lack", F.lit(0))
    slots = (filled.select(F.col("number").alias("slot"), (F.lit(each) - F.col("gap")).alias("own"), "item", "other")
             .unionByName(full.select(F.col("number").alias("slot"), F.lit(each).cast("bigint").alias("own"), "item", F.col("item").alias("other")))
             .unionByName(whole.select((F.col("rank") + F.lit(n_light)).alias("slot"), (F.lit(each) - lack).alias("own"), F.col("other").alias("item"),
                                       F.coalesce("next", "other").alias("other"))))
    table, _ = write_round(slots)
    return table, n, each


def drawn(rows: DataFrame, key: str, table: DataFrame, slots: int, each: int, seed: str) -> DataFrame:
    """``rows`` with ``item``: a keyed draw for each row, one lookup in the alias table."""
    at = rows.withColumns({"slot": keyed_index(seed, F.lit(slots), F.col(key), F.lit("slot")),
                           "__u": keyed_uniform(seed, F.col(key), F.lit("unit")) * F.lit(float(each))})
    met = at.join(table, "slot")
    return met.withColumn("item", F.when(F.col("__u") < F.col("own"), F.col("item")).otherwise(F.col("other"))).select(*rows.columns, "item")
