"""Exact sums, metric matches, range joins, relaxation, nested and native recursion, deals: against brute force."""

import math
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumen.functions import vectors as V
from lumen.functions.draws import keyed_index
from lumen.operators.deal import folds, numbered, permuted, sides
from lumen.operators.exact import exact_means, exact_sums
from lumen.operators.iterate import frontier_loop, redraw_until_accepted
from lumen.operators.metric import nearest_valid
from lumen.operators.ranges import range_join
from lumen.operators.recurse import recursed
from lumen.operators.relax import cheapest_paths
from lumen.operators.sequence import first_match_after
from lumen.plans import queries as Q
from lumen.session import ensure_checkpoint_dir


# ---- exact sums -----------------------------------------------------------------------------

def close_to_exact(got, xs):
    """Within two last places of the exact sum."""
    want = float(sum(map(Fraction, xs)))
    return got == want or abs(got - want) <= 2 * math.ulp(want)


def sums(spark, xs, **more):
    rows = spark.createDataFrame([(float(x) if x is not None else None,) for x in xs], "x double")
    return exact_sums(rows, [], {"s": "x"}).first()


SUMS = [[4e-7, 4e-7], [1e12, 0.1, -1e12], [1e300, 1.0, -1e300], [0.1] * 10, [1e16, 1.0, 1.0, -1e16], [5e-324, 5e-324, -1.5e-300],
        [2.0**52, -2.0**52, 2.0**-26, -2.0**-27, 3e-20], [-0.75, 0.25, -1e-9], [1e308, -1e308, 1e-308], [67108864.0, -67108863.99999999],
        [-1.0, 2.0**-60], [123456.78, -0.01, 1e11, 1e13]]


@pytest.mark.parametrize("xs", SUMS)
def test_sums_are_exact(spark, xs):
    row = sums(spark, [*xs, None])
    assert close_to_exact(row.s, xs), (row.s, math.fsum(xs))
    assert (row.n_s, row.n_rows) == (len(xs), len(xs) + 1)
    assert sums(spark, xs[::-1]).s == row.s


def test_sums_show_broken_numbers(spark):
    assert math.isnan(sums(spark, [1.0, 1e12, "nan", 2.0]).s)
    assert sums(spark, [1.0, "inf", 1e300]).s == math.inf
    assert math.isnan(sums(spark, ["inf", "-inf"]).s)
    assert sums(spark, [None, None]).s is None and sums(spark, []).s is None
    assert repr(sums(spark, [-0.0, 0.0]).s) == "0.0"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.floats(allow_nan=False, allow_infinity=False, min_value=-1e200, max_value=1e200)), min_size=1, max_size=40))
def test_sums_by_key_are_exact(spark, rows):
    frame = spark.createDataFrame([(k, x, x / 3) for k, x in rows], "k string, x double, y double").repartition(3)
    got = {r.k: r for r in exact_sums(frame, ["k"], {"s": "x", "t": "y"}).collect()}
    assert set(got) == {k for k, _ in rows}
    for k, r in got.items():
        assert close_to_exact(r.s, [x for j, x in rows if j == k]) and close_to_exact(r.t, [x / 3 for j, x in rows if j == k])
        assert r.n_s == r.n_t == r.n_rows == sum(j == k for j, _ in rows)


def test_means(spark):
    frame = spark.createDataFrame([("a", 4e-7), ("a", 4e-7), ("b", None), ("c", 1.0), ("c", None)], "k string, x double")
    got = {r.k: (r.n_rows, r.m) for r in exact_means(frame, ["k"], {"m": "x"}).collect()}
    assert got == {"a": (2, 4e-7), "b": (1, None), "c": (2, 1.0)}


# ---- nearest valid match by an index --------------------------------------------------------

def plain_nearest(probes, entries):
    out = {}
    for pid, p in probes:
        found = []
        for key, c, r in entries:
            if p is None or c is None or len(p) != len(c) or None in p or None in c or any(map(math.isnan, [*p, *c])) or r is None:
                continue
            d = float(np.sqrt(((np.array(p) - np.array(c)) ** 2).sum()))
            if d <= r:
                found.append((d, key))
        out[pid] = min(found) if found else (None, None)
    return out


def metric_rows(seed, n_probes, n_entries, wide):
    draw = random.Random(seed)
    centres = [[draw.uniform(-wide, wide) for _ in range(3)] for _ in range(12)]

    def near(c, s):
        return [x + draw.gauss(0, s) for x in c]
    entries = [(k, near(draw.choice(centres), 1.0), abs(draw.gauss(0, 1.5))) for k in range(n_entries)]
    probes = [(k, near(draw.choice(centres), 1.5)) for k in range(n_probes)]
    entries += [(9001, None, 1.0), (9002, [float("nan"), 0.0, 0.0], 9.0), (9003, [0.0], 5.0), (9004, [0.0, None, 1.0], 9.0), (9005, [1.0, 1.0, 1.0], None),
                (9006, [0.0, 0.0], 3.0), (9000, [0.0, 0.0], 3.0), (9010, [500.0, 0.0, 0.0], 10_000.0)]
    probes += [(8001, None), (8002, [float("nan")] * 3), (8003, [1.0]), (8004, [0.5, 0.0]), (8005, [0.0, 1.0, None]), (8006, [1e6, 0.0, 0.0]), (8007, [])]
    hot = near(centres[0], 1.0)
    return probes, entries + [(9100 + k, hot, 2.0) for k in range(n_entries // 3)]


@pytest.mark.parametrize(("block", "pivots"), [(4, None), (16, 3), (10_000, None)])
def test_nearest_valid_equals_brute_force(spark, block, pivots):
    probes, entries = metric_rows(1, 150, 180, 30)
    shown = spark.createDataFrame(entries, "e long, c array<double>, r double").repartition(5)
    asked = spark.createDataFrame([(k, p, "x") for k, p in probes], "pid long, p array<double>, score string").repartition(3)
    out = nearest_valid(asked, "pid", "p", shown, order_key="e", vector="c", radius="r", item="e", block=block, pivots=pivots)
    want = plain_nearest(probes, entries)
    assert {r.pid: (r.score, r.e) for r in out.collect()} == want
    out = nearest_valid(asked, "pid", "p", shown, order_key="e", vector="c", item="e", block=block, pivots=pivots)
    assert {r.pid: (r.score, r.e) for r in out.collect()} == plain_nearest(probes, [(e, c, math.inf) for e, c, _ in entries])


def test_nearest_valid_without_a_catalogue(spark):
    shown = spark.createDataFrame([], "e long, c array<double>, r double")
    asked = spark.createDataFrame([(1, [0.0])], "pid long, p array<double>")
    assert nearest_valid(asked, "pid", "p", shown, order_key="e", vector="c", item="e").collect()[0][:] == (1, None, None)
    assert nearest_valid(asked.where("false"), "pid", "p", shown, order_key="e", vector="c", item="e").count() == 0


def test_the_index_prunes(spark):
    """10^5 entries around 300 centres: a probe visits few of the blocks."""
    draw = np.random.default_rng(3)
    centres = draw.uniform(-1000, 1000, (300, 4))
    at = centres[draw.integers(0, 300, 100_000)] + draw.normal(0, 1, (100_000, 4))
    asked = centres[draw.integers(0, 300, 400)] + draw.normal(0, 1, (400, 4))
    shown = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(at)], "e long, c array<double>")
    probes = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(asked)], "pid long, p array<double>")
    visits = []
    out = nearest_valid(probes, "pid", "p", shown, order_key="e", vector="c", item="e", block=128, visits_to=visits)
    got = {r.pid: r.e for r in out.collect()}
    assert all(got[k] == int(((at - p) ** 2).sum(axis=1).argmin()) for k, p in enumerate(asked))
    blocks = 100_000 / 128
    assert visits[0] / 400 < blocks / 10, visits


# ---- range join -----------------------------------------------------------------------------

POINT = st.one_of(st.integers(-40, 40), st.integers(-2**61, 2**61))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), POINT), max_size=25), st.lists(st.tuples(st.integers(0, 2), POINT, POINT), max_size=25))
def test_range_join_equals_brute_force(spark, points, intervals):
    p = spark.createDataFrame([(k, i, x) for i, (k, x) in enumerate(points)], "k long, pid long, x long")
    v = spark.createDataFrame([(k, i, lo, hi) for i, (k, lo, hi) in enumerate(intervals)], "k long, vid long, lo long, hi long")
    got = sorted((r.pid, r.vid) for r in range_join(p, v, point="x", low="lo", high="hi", on=["k"]).collect())
    assert got == sorted((i, j) for i, (k, x) in enumerate(points) for j, (m, lo, hi) in enumerate(intervals) if k == m and lo <= x < hi)
    got = sorted((r.pid, r.vid) for r in range_join(p.drop("k"), v.drop("k"), point="x", low="lo", high="hi").collect())
    assert got == sorted((i, j) for i, (_, x) in enumerate(points) for j, (_, lo, hi) in enumerate(intervals) if lo <= x < hi)


def test_range_join_with_one_interval_over_all(spark):
    p = spark.range(0, 20_000).select(F.col("id").alias("x"))
    v = spark.createDataFrame([(0, -(2**40), 2**40), *((k, 10 * k, 10 * k + 3) for k in range(1, 1500)), (7777, 5, 5), (7778, None, 9)],
                              "vid long, lo long, hi long")
    out = range_join(p, v, point="x", low="lo", high="hi")
    counts = {r.vid: r["count"] for r in out.groupBy("vid").count().collect()}
    assert counts == {0: 20_000} | {k: 3 for k in range(1, 1500)}
    assert "NestedLoop" not in out._jdf.queryExecution().toString() and "Cartesian" not in out._jdf.queryExecution().toString()


# ---- relaxation -----------------------------------------------------------------------------

def plain_paths(seeds, edges):
    best = {}
    for node, cost in seeds:
        best[node] = min(best.get(node, (cost, 0)), (cost, 0))
    while True:
        again = dict(best)
        for a, b, c in edges:
            if a in best:
                offer = (best[a][0] + c, best[a][1] + 1)
                again[b] = min(again.get(b, offer), offer)
        if again == best:
            return sorted((n, *x) for n, x in best.items())
        best = again


def test_cheapest_paths_equal_brute_force(spark):
    draw = random.Random(9)
    edges = [(draw.randrange(60), draw.randrange(60), draw.choice([0, 1, 1, 5, 20])) for _ in range(110)]
    edges += [(100 + k, 101 + k, 1) for k in range(25)] + [(0, k, 50) for k in range(200, 400)] + [(3, 100, 2), (100, 125, 30)]
    seeds = [(0, 0), (0, 4), (3, 1), (999, 5)]
    frame = spark.createDataFrame([*edges, (None, 1, 1), (1, None, 1), (1, 2, None)], "src long, dst long, cost long").repartition(4)
    start = spark.createDataFrame([*seeds, (None, 0), (5, None)], "node long, cost long")
    assert sorted(tuple(r) for r in cheapest_paths(start, frame).collect()) == plain_paths(seeds, edges)
    assert cheapest_paths(start.where("false"), frame).count() == 0
    with pytest.raises(RuntimeError, match="still improve"):
        cheapest_paths(start, frame, max_rounds=3)
    with pytest.raises(ValueError, match="negative"):
        cheapest_paths(start, spark.createDataFrame([(0, 1, -1)], "src long, dst long, cost long"))


def test_relaxation_leaves_its_last_table_only(spark):
    import os
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    edges = spark.createDataFrame([(k, k + 1, 1) for k in range(12)], "src long, dst long, cost long")
    assert cheapest_paths(spark.createDataFrame([(0, 0)], "node long, cost long"), edges).count() == 13
    assert len(set(os.listdir(folder)) - before) <= 3


# ---- recursion ------------------------------------------------------------------------------

def test_nested_loops_draw_the_same_on_any_partitioning(spark):
    def walk(parts):
        keys = spark.range(40).select(F.col("id").alias("k"), F.lit(0).alias("r"), F.lit(None).cast("long").alias("draws"), F.lit(True).alias("active"))

        def step(frontier, r):
            drawn = redraw_until_accepted(frontier.repartition(parts), "k", draw=lambda i: keyed_index("n", F.lit(9), F.col("k"), F.lit(r), i),
                                          accept=lambda t: t.withColumn("accepted", F.col("candidate") == 4), batch=2)
            return drawn.select("k", F.lit(r).alias("r"), F.col("draws").cast("long").alias("draws"), F.lit(r < 3).alias("active"))
        return sorted(tuple(x) for x in frontier_loop(keys, step, active=F.col("active"), max_rounds=3).select("k", "r", "draws").collect() if x.r)
    one = walk(1)
    assert one == walk(7) and len(one) == 120
    by_round = defaultdict(list)
    for _, r, draws in one:
        by_round[r].append(draws)
    assert by_round[1] != by_round[2] != by_round[3]


def test_native_recursion_raises_at_its_limits(spark):
    base = spark.createDataFrame([(1, 10), (2, 3), (3, 0)], "k long, left_over int")
    step = {"k": "k", "left_over": "left_over - 1"}
    want = sorted((k, x) for k, n in ((1, 10), (2, 3), (3, 0)) for x in range(n + 1))
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    assert sorted(tuple(r) for r in recursed(base, step, "left_over > 0", levels=10, rows=len(want)).collect()) == want
    with pytest.raises(Exception, match="RECURSION_LEVEL_LIMIT_EXCEEDED"):
        recursed(base, step, "left_over > 0", levels=7, rows=100)
    with pytest.raises(Exception, match="RECURSION_ROW_LIMIT_EXCEEDED"):
        recursed(base, step, "left_over > 0", levels=10, rows=5)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
    assert recursed(base.where("false"), step, "left_over > 0", levels=0, rows=0).count() == 0
    with pytest.raises(ValueError):
        recursed(base, {"k": "k"}, "true", levels=1, rows=1)


def test_larger_balances_take_no_fewer_instalments():
    steps = [Q.instalments_left(c) for c in range(0, 60_000_000, 99_991)]
    assert steps == sorted(steps)


# ---- draws without replacement --------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 16, 17, 100, 1000, 5000])
def test_permutations_are_complete(spark, n):
    rows = spark.range(n)
    got = [r.position for r in permuted(rows, "id", n, "seed").orderBy("id").collect()] if n else []
    assert sorted(got) == list(range(n))
    if n >= 100:
        assert got != [r.position for r in permuted(rows, "id", n, "other").orderBy("id").collect()]
        assert abs(np.corrcoef(np.arange(n), got)[0, 1]) < 4 / math.sqrt(n)
    a, b = sides(n)
    assert a * b >= n and a * b - n <= a


def test_folds_are_equal_and_keys_may_have_gaps(spark):
    for keys in (list(range(5, 205)), [3 * k for k in range(103)], [7]):
        rows = spark.createDataFrame([(k,) for k in keys], "k long").repartition(6)
        got = folds(rows, "k", 7, "s").collect()
        assert sorted(r.k for r in got) == keys and sorted(r.position for r in got) == list(range(len(keys)))
        sizes = [sum(r.fold == f for r in got) for f in range(7)]
        assert max(sizes) - min(sizes) <= 1
    assert numbered(spark.createDataFrame([], "k long"), "k")[1] == 0


# ---- vectors and as-of matches --------------------------------------------------------------

def test_mean_vectors_of_mixed_lengths(spark):
    rows = [("a", [1.0, 2.0]), ("a", [3.0]), ("a", None), ("a", []), ("b", [float("nan"), 1.0]), ("b", [1.0, 1.0]), ("c", [None, 4.0]), (None, [5.0])]
    got = {r.k: r.m for r in V.mean_vectors(spark.createDataFrame(rows, "k string, v array<double>"), ["k"], "v", "m").collect()}
    assert got["a"] == [2.0, 2.0] and math.isnan(got["b"][0]) and got["b"][1] == 1.0 and got[None] == [5.0] and "c" not in got


def test_matches_write_probes_not_candidates(spark):
    """What an as-of match leaves in the checkpoint folder grows with the probes, not with the candidates."""
    import os
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")

    def held():
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)

    def left_by(n):
        cands = spark.range(n).select(F.pmod("id", F.lit(3)).alias("k"), F.col("id").alias("cid"), F.timestamp_seconds(F.col("id") * 7).cast("timestamp_ntz").alias("t"),
                                      F.col("id").cast("string").alias("kind"))
        probes = spark.range(50).select(F.pmod("id", F.lit(3)).alias("k"), F.col("id").alias("pid"), F.timestamp_seconds(F.col("id") * 100).cast("timestamp_ntz").alias("u"))
        before = held()
        out = first_match_after(probes, cands, "k", probe_ts="u", probe_id="pid", cand_ts="t", cand_id="cid", carry=["kind"]).collect()
        assert all(r.match_kind == str(r.match_id) for r in out if r.match_id is not None) and len(out) == 50
        return held() - before
    left_by(100)
    assert left_by(60_000) < 3 * left_by(2_000) + 20_000


@pytest.mark.parametrize("n_splits,block", [(1, 1), (5, 3), (50, 128)])
def test_timeline_finds_the_first_row_after(spark, monkeypatch, n_splits, block):
    """Ties, a hot key, null keys and times, probes before the first and at or after the last row."""
    import datetime as dt

    from lumen.operators import timeline as T
    plain = T.add_split
    monkeypatch.setattr(T, "add_split", lambda df, key, order: plain(df, key, order, n_splits=n_splits))
    t0, rnd = dt.datetime(2024, 1, 1), random.Random(n_splits)
    rows = [(i, None if i % 37 == 0 else t0 + dt.timedelta(seconds=rnd.choice([rnd.randrange(60), rnd.randrange(10**6), 30])),
             rnd.choice([0, 0, 0, 1, 2, None]), str(i)) for i in range(400)]
    rows.append((400, t0, 3, "alone"))
    probes = [(i, None if i % 41 == 0 else t0 + dt.timedelta(seconds=rnd.choice([-10**9, -1, rnd.randrange(70), rnd.randrange(10**6), 10**7])),
               rnd.choice([0, 0, 1, 2, 3, 4, None])) for i in range(600)]
    line = T.timeline(spark.createDataFrame(rows, "id long, t timestamp_ntz, k long, kind string"), "k", "t", "id", ["kind"], block=block)
    got = {r.kind: tuple(r.match) for r in line.after(spark.createDataFrame(probes, "kind long, u timestamp_ntz, k long"), "u").collect()}
    want = {}
    for p, u, k in probes:
        later = [(t, i, kind) for i, t, of, kind in rows if None not in (u, t, k) and of == k and t > u]
        if later:
            want[p] = min(later)
    assert got == want


def test_timeline_of_nothing_and_drop(spark):
    import os

    from lumen.operators.timeline import timeline
    rows = spark.createDataFrame([], "k long, t timestamp_ntz, id long")
    line = timeline(rows, "k", "t", "id")
    assert line.levels == [] and line.after(rows, "t").count() == 0
    folder = os.path.dirname(line.cells.inputFiles()[0]).removeprefix("file:").replace("///", "/") if line.cells.inputFiles() else None
    line.drop()
    assert folder is None or not os.path.exists(folder)


def test_cooldown_chain_leaves_its_rounds_only(spark):
    """The events, ordered once, are written and dropped again; no round writes them."""
    import os

    from lumen.plans import queries as Q
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    Q.q_cooldown_chain(spark, "/root/testdata/sf0.001").collect()
    left = set(os.listdir(folder)) - before
    assert len(left) <= Q.CHAIN_STEPS + 1 and all(name.startswith("lumen-round-") for name in left)


# ---- branches, alias tables, running sums and documents --------------------------------------

def test_branches_take_each_row_once(spark):
    from lumen.operators.iterate import branching
    seed = spark.createDataFrame([(k, k % 4 if k % 5 else None, 0, True) for k in range(20)], "k long, kind long, depth int, active boolean")
    other = spark.createDataFrame([(0, 1), (1, 2)], "kind long, next long")
    nothing = F.lit(None).cast("long")

    def joined(rows, r):
        return rows.join(other, "kind").select("k", F.col("next").alias("kind"), F.lit(r).alias("depth"), F.lit(True).alias("active"))

    def grouped(rows, r):
        return rows.groupBy("k").agg(F.max("kind").alias("kind")).select("k", (F.col("kind") + 1).alias("kind"), F.lit(r).alias("depth"), F.lit(True).alias("active"))

    def ended(rows, r):
        return rows.select("k", nothing.alias("kind"), F.lit(r).alias("depth"), F.lit(False).alias("active"))
    step = branching([(F.col("kind") < 2, joined), (F.col("kind") == 2, grouped), (F.col("kind") <= 2, ended)], otherwise=ended)
    got = sorted(((r.k, r.depth, r.kind, r.active) for r in frontier_loop(seed, step, active=F.col("active"), max_rounds=6).collect()), key=str)
    want = []
    for k in range(20):
        kind = k % 4 if k % 5 else None
        want.append((k, 0, kind, True))
        depth = 0
        while kind in (0, 1, 2):
            depth, kind = depth + 1, kind + 1
            want.append((k, depth, kind, True))
        want.append((k, depth + 1, None, False))
    assert got == sorted(want, key=str)


WEIGHTS = [[5], [1, 1, 1], [0, 3, 0, 7, 1], [1, 1, 1, 1, 96], [50, 50, 1, 2, 3], [10**9, 1, 10**9 + 1, 3, 5, 5, 5], [2, 4, 6, 8, 10, 12], list(range(1, 40)),
           [1000] * 3 + [1] * 50 + [777, 5000, 2]]


@pytest.mark.parametrize("weights", WEIGHTS)
def test_alias_tables_hold_the_exact_shares(spark, weights):
    from lumen.operators.alias import alias_table
    rows = spark.createDataFrame([(k, w) for k, w in enumerate(weights)] + [(500, None)], "item long, weight long").repartition(3)
    table, n, each = alias_table(rows)
    slots = table.collect()
    assert n == sum(w > 0 for w in weights) == len(slots) and sorted(r.slot for r in slots) == list(range(n)) and each == sum(weights)
    share = defaultdict(int)
    for r in slots:
        assert 0 <= r.own <= each
        share[r.item] += r.own
        share[r.other] += each - r.own
    assert {k: s for k, s in share.items() if s} == {k: n * w for k, w in enumerate(weights) if w}


def test_alias_draws_follow_the_weights(spark):
    from lumen.operators.alias import alias_table, drawn
    weights = [1, 2, 3, 10, 30, 54]
    rows = spark.createDataFrame(list(enumerate(weights)), "item long, weight long")
    table, n, each = alias_table(rows)
    counts = {r.item: r["count"] for r in drawn(spark.range(20_000), "id", table, n, each, "t").groupBy("item").count().collect()}
    chi = sum((counts.get(k, 0) - 200 * w) ** 2 / (200 * w) for k, w in enumerate(weights))
    assert sum(counts.values()) == 20_000 and chi < 25
    for bad, match in (([(1, -1)], "negative"), ([(1, 0)], "no item"), ([(1, 2**62), (2, 2**62)], "below")):
        with pytest.raises(ValueError, match=match):
            alias_table(spark.createDataFrame(bad, "item long, weight long"))


def test_documents_of_many_files(spark, tmp_path):
    from lumen.sources.export import with_offsets, write_document
    rows = [(k % 7, f"line {k} é" * (k % 4)) for k in range(300)] + [(3, None)] + [(1, "same")] * 40
    lines = spark.createDataFrame(rows, "k long, line string").repartition(5)
    index = write_document(lines, ["k"], "line", str(tmp_path / "doc")).orderBy("file").collect()
    files = sorted((tmp_path / "doc").glob("part-*.txt"))
    parts = {int(f.name[5:10]): f.read_bytes() for f in files}
    whole = b"".join(parts[k] for k in sorted(parts))
    assert whole == b"".join((t or "").encode() + b"\n" for _, t in sorted(rows, key=lambda r: (r[0], r[1] is not None, (r[1] or "").encode())))
    for r in index:
        assert len(parts[r.file]) == r.bytes and whole[r.byte_start:r.byte_start + r.bytes] == parts[r.file]
        assert whole[:r.byte_start].count(b"\n") == r.line_no and parts[r.file].count(b"\n") == r.lines
    for r in with_offsets(lines, ["k"], "line").collect():
        text = (r.line or "").encode()
        assert whole[r.byte_start:r.byte_start + len(text) + 1] == text + b"\n"
    assert with_offsets(lines.where("false"), ["k"], "line").count() == 0
