"""Iteration with carried state.

``frontier_loop``: round by round, the active rows of the last round are fed to a step
function that emits the rows of the next round (the recursive term of a WITH RECURSIVE).
The general step may aggregate, rank or join over the frontier, which Spark's native
recursive CTE forbids, so the loop runs on the driver and each round is an ordinary
distributed job: only the frontier moves, and each round's rows are written as a parquet
table to the shared checkpoint folder (the active rows counted in the same job), so the
plan never grows and a lost executor never reaches back more than one round.

``redraw_until_accepted``: per key, keyed draws are tested until one is accepted; only the
keys still rejected go round again.  Draws are generated in batches (``batch``, doubling
each round; exact: the first accepted draw number wins), which trades a few extra
candidate rows for fewer rounds, i.e. fewer shuffles.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumen.operators.lineage import drop_round, write_round


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def frontier_loop(seed: DataFrame, step: Callable[[DataFrame, int], DataFrame], *,
                  active: Column, max_rounds: int) -> DataFrame:
    """Rows of all rounds: ``seed`` (round 0) then ``step(frontier, r)`` for r = 1..max_rounds.

    The frontier of round r is the rows of round r-1 for which ``active`` holds.  The loop
    stops early when a round emits no active row.  Every round's output has the seed's
    columns.  ``step`` is responsible for any terminal rows (rows it emits inactive).
    Each round is one job: its rows are written to the shared checkpoint folder while the
    active rows are counted (see :func:`lumen.operators.lineage.write_round`).  Raises when
    active rows are left after ``max_rounds`` rounds, rather than return a cut result.
    """
    cols = seed.columns
    current, n_active = write_round(seed.select(*cols), active)
    rounds = [current]
    for r in range(1, max_rounds + 1):
        if n_active == 0:
            break
        current, n_active = write_round(step(current.where(active), r).select(*cols), active)
        rounds.append(current)
    if n_active > 0:
        for done in rounds:
            drop_round(done)
        raise RuntimeError(f"frontier_loop: {n_active} rows still active after {max_rounds} rounds")
    return union_all(rounds)


def branching(branches: list[tuple[Column, Callable[[DataFrame, int], DataFrame]]], *,
              otherwise: Callable[[DataFrame, int], DataFrame] | None = None) -> Callable[[DataFrame, int], DataFrame]:
    """A step for :func:`frontier_loop` made of branches of different shape.

    Each row of the frontier goes to the first branch whose condition holds (null does not), the
    rest to ``otherwise`` (terminal rows) or nowhere.  A branch is a step of its own, with its own
    joins; all return the same columns.  The frontier is the written round, so each branch is one
    scan of that table with its filter, and nothing is computed twice.
    """
    def step(frontier: DataFrame, r: int) -> DataFrame:
        out, left = [], F.lit(True)
        for condition, branch in branches:
            holds = F.coalesce(condition, F.lit(False))
            out.append(branch(frontier.where(left & holds), r))
            left = left & ~holds
        if otherwise is not None:
            out.append(otherwise(frontier.where(left), r))
        return union_all(out)
    return step


def redraw_until_accepted(keys: DataFrame, key: str, *, draw: Callable[[Column], Column],
                          accept: Callable[[DataFrame], DataFrame], batch: int = 4,
                          max_batch: int = 256, max_rounds: int = 10_000) -> DataFrame:
    """First accepted draw per key.

    ``keys`` holds each key once (a primary key).  ``draw(i)`` returns the candidate for
    draw number ``i`` (a Column over ``key``); ``accept(df)`` receives rows
    ``(key, draw_no, candidate)`` and adds a boolean column ``accepted`` (typically a join
    against the eligible catalogue).  Returns ``(key, draws, candidate)`` where ``draws`` is
    the number of the accepted draw, counting from 1.

    Round r tests the next ``batch * 2^r`` draws (capped at ``max_batch``) of every key still
    rejected: the frontier shrinks geometrically, so later rounds can afford wider batches,
    and the number of rounds (jobs, shuffles) stays small.  The answer does not depend on
    the batch sizes.  Every key is kept: the loop runs until all keys are accepted and raises
    rather than return a truncated answer if ``max_rounds`` rounds are not enough.
    """
    if batch < 1 or max_batch < batch:
        raise ValueError("need 1 <= batch <= max_batch")
    frontier = keys.select(key)
    done = []
    lo = 1
    for r in range(max_rounds):
        if r > 0 and n_left == 0:
            return union_all(done)
        width = min(batch << r, max_batch)
        tries = (frontier
                 .select(key, F.explode(F.sequence(F.lit(lo), F.lit(lo + width - 1))).alias("draw_no"))
                 .withColumn("candidate", draw(F.col("draw_no"))))
        lo += width
        judged = accept(tries)
        best, n_left = write_round(judged.groupBy(key).agg(
            F.min(F.when(F.col("accepted"), F.struct("draw_no", "candidate"))).alias("best")),
            F.col("best").isNull())
        done.append(best.where(F.col("best").isNotNull())
                    .select(key, F.col("best.draw_no").alias("draws"), F.col("best.candidate").alias("candidate")))
        frontier = best.where(F.col("best").isNull()).select(key)
    raise RuntimeError(f"redraw_until_accepted: keys still rejected after {lo - 1} draws")
