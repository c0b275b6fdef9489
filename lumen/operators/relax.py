"""Relaxation: an aggregate over the frontier of a loop, by key.

Cheapest paths from seeds: each round the frontier meets the edges, its offers are reduced to the
best one for each node (partial aggregates before the shuffle, so a node with a third of all
edges is one row for each task), and only offers better than what the node has go into the next
frontier.  The best offers so far are a table in the shared folder, written again each round with
the improvements merged in; rounds before it are deleted, so lineage and disk stay bounded.  It
ends when a round improves nothing, after as many rounds as the longest cheapest path has edges.

A lost executor reaches back to the last written table at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumen.operators.lineage import drop_round, write_round


def cheapest_paths(seeds: DataFrame, edges: DataFrame, *, max_rounds: int = 10_000) -> DataFrame:
    """(node, cost, hops): the least cost of every reachable node, and the fewest edges at that cost.

    seeds: (node, cost); edges: (src, dst, cost) with bigint costs of 0 or more, directed; several
    edges between two nodes count as the cheapest.  Null nodes and costs are left out.
    """
    edges, n_edges = write_round(edges.where("src IS NOT NULL AND dst IS NOT NULL AND cost IS NOT NULL")
                                 .groupBy("src", "dst").agg(F.min("cost").alias("edge_cost")))
    if n_edges and edges.agg(F.min("edge_cost")).first()[0] < 0:
        raise ValueError("an edge has a negative cost")
    start = seeds.where("node IS NOT NULL AND cost IS NOT NULL").groupBy("node").agg(F.min("cost").cast("bigint").alias("cost"))
    best, n = write_round(start.select("node", F.struct("cost", F.lit(0).cast("bigint").alias("hops")).alias("best")))
    frontier, old = best, []
    for _ in range(max_rounds):
        if not n:
            for done in [edges, *old, *([frontier] if frontier is not best else [])]:
                drop_round(done)
            return best.select("node", "best.cost", "best.hops")
        offer = F.struct((F.col("best.cost") + F.col("edge_cost")).alias("cost"), (F.col("best.hops") + 1).alias("hops"))
        offers = (frontier.join(edges, F.col("node") == F.col("src")).groupBy("dst").agg(F.min(offer).alias("offer"))
                  .withColumnRenamed("dst", "to"))
        better = offers.join(best, F.col("to") == F.col("node"), "left").where("best IS NULL OR offer < best")
        improved, n = write_round(better.select(F.col("to").alias("node"), F.col("offer").alias("best")))
        merged = best.unionByName(improved).groupBy("node").agg(F.min("best").alias("best"))
        for done in old:                                  # the tables of the round before
            drop_round(done)
        old = [best, frontier] if frontier is not best else [best]
        best, _ = write_round(merged)
        frontier = improved
    raise RuntimeError(f"cheapest_paths: {n} nodes still improve after {max_rounds} rounds")
