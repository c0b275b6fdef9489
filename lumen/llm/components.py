"""Connected components of an undirected graph given as edges, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumen.llm.shared import written


def connected_components(edges: DataFrame, folder: str | None = None) -> DataFrame:
    """(id, component) for every id of ``edges`` (a, b); component: the smallest id reachable.

    Alternating large-star and small-star steps: each hooks a node's neighbours to its least
    neighbour, so a hub's edges shrink to a star and chains halve.  Only minima are gathered
    by node, with map-side partial aggregates; nothing is collected to a task or the driver.
    The rounds are written in ``folder``.
    """
    def fingerprint(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b") % 1_000_003)).first())

    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    current = written(down, "edges", folder)
    state = fingerprint(current)
    while state[0]:
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
        # every edge now runs from a node to a smaller one
        lower = large.groupBy("a").agg(F.min("b").alias("least"))
        hooked = large.join(lower, "a")
        small = (hooked.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
                 .union(lower.select("a", F.col("least").alias("b"))).distinct())
        current = written(small, "edges", folder)
        before, state = state, fingerprint(current)
        if state == before:
            break
    stars = current.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.union(stars.select("component", "component").distinct())
