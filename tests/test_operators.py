"""Operators on small hand-made frames, checked against brute force in plain Python."""

import colorsys
import datetime as dt
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from lumen.functions import vectors as V
from lumen.functions.draws import keyed_uniform
from lumen.functions.shapes import guarded_inverse, guarded_sqrt, quantize_sqrt, triangle_wave
from lumen.operators.assemble import global_line_numbers, ordered_concat
from lumen.operators.iterate import frontier_loop, redraw_until_accepted
from lumen.operators.match import nearest_in_blocks
from lumen.operators.route import route, route_and_union
from lumen.operators.sequence import first_match_after, with_following, with_next_row, with_positions
from lumen.operators.topk import dedup_by_key, rows_at_group_max, top_per_key

T0 = dt.datetime(2024, 1, 1)


def _events(spark, n=400, users=5, hot_share=0.6, seed=7):
    """Events with one hot user, gaps that leave empty buckets, and equal timestamps."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        u = 0 if rnd.random() < hot_share else rnd.randrange(1, users)
        t = T0 + dt.timedelta(seconds=rnd.choice([rnd.randrange(0, 4000), rnd.randrange(9000, 9100)]))
        kind = rnd.choice(["a", "b"])
        rows.append((i, t, u, kind))
    return spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, kind string"), rows


# ---- sequence operators -----------------------------------------------------------------

SPLITS = [dict(split="range"), dict(split="time", bucket_seconds=60)]


@pytest.mark.parametrize("how", SPLITS)
def test_with_next_row_matches_lead(spark, how):
    df, rows = _events(spark)
    got = {r.event_id: r.next_event_id for r in
           with_next_row(df, "user_id", "ts", "event_id", ["kind"], **how).collect()}
    by_user = {}
    for r in sorted(rows, key=lambda r: (r[2], r[1], r[0])):
        by_user.setdefault(r[2], []).append(r[0])
    want = {}
    for ids in by_user.values():
        for a, b in zip(ids, ids[1:] + [None]):
            want[a] = b
    assert got == want


@pytest.mark.parametrize("how", SPLITS)
def test_with_positions_matches_row_number(spark, how):
    df, rows = _events(spark)
    got = {r.event_id: r.pos for r in with_positions(df, "user_id", "ts", "event_id", **how).collect()}
    want = {}
    by_user = {}
    for r in sorted(rows, key=lambda r: (r[2], r[1], r[0])):
        by_user.setdefault(r[2], []).append(r[0])
    for ids in by_user.values():
        for i, e in enumerate(ids):
            want[e] = i
    assert got == want


@pytest.mark.parametrize("how", SPLITS)
@pytest.mark.parametrize("gap_s", [0, 60, 600])
def test_first_match_after_matches_brute_force(spark, gap_s, how):
    df, rows = _events(spark, n=300)
    probes = df.where("kind = 'a'")
    cands = df.where("kind = 'b'")
    out = first_match_after(probes, cands, "user_id", probe_ts="ts", probe_id="event_id", cand_ts="ts",
                            cand_id="event_id", min_gap_us=gap_s * 1_000_000, **how)
    got = {r.event_id: r.match_id for r in out.collect()}
    want = {}
    for p in rows:
        if p[3] != "a":
            continue
        best = None
        for c in rows:
            if c[3] == "b" and c[2] == p[2] and (c[1] - p[1]) > dt.timedelta(seconds=gap_s):
                if best is None or (c[1], c[0]) < (best[1], best[0]):
                    best = c
        want[p[0]] = best[0] if best else None
    assert got == want


def test_sequence_operators_on_empty_input(spark):
    df, _ = _events(spark)
    empty = df.where("false")
    assert with_next_row(empty, "user_id", "ts", "event_id", []).count() == 0
    assert first_match_after(empty, df, "user_id", probe_ts="ts", probe_id="event_id", cand_ts="ts",
                             cand_id="event_id").count() == 0
    assert with_positions(empty, "user_id", "ts", "event_id").count() == 0


# ---- top per key --------------------------------------------------------------------------

def test_top_per_key_ties_and_n(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 3, "c"), (2, 1, "d"), (2, 2, "e")],
                               "k int, v int, id string")
    assert sorted(r.id for r in rows_at_group_max(df, ["k"], "v").collect()) == ["a", "b", "e"]
    assert sorted(r.id for r in dedup_by_key(df, ["k"], ["v", "id"]).collect()) == ["c", "d"]
    top2 = top_per_key(df, ["k"], [F.col("v").desc(), F.col("id").asc()], n=2)
    assert sorted(r.id for r in top2.collect()) == ["a", "b", "d", "e"]
    assert top_per_key(df.where("false"), ["k"], [F.col("v")]).count() == 0


# ---- iteration --------------------------------------------------------------------------

def test_frontier_loop_stops_when_frontier_empties(spark):
    seed = spark.createDataFrame([(1, 0, False), (2, 0, False)], "k int, depth int, active boolean")
    calls = []

    def step(fr, r):
        calls.append(r)
        return fr

    out = frontier_loop(seed, step, active=F.col("active"), max_rounds=5)
    assert out.count() == 2 and calls == []


def test_frontier_loop_counts_down(spark):
    seed = spark.createDataFrame([(1, 0, 3), (2, 0, 1)], "k int, depth int, left int").withColumn(
        "active", F.col("left") > 0)

    def step(fr, r):
        return fr.select("k", (F.col("depth") + 1).alias("depth"), (F.col("left") - 1).alias("left")).withColumn(
            "active", F.col("left") > 0)

    out = frontier_loop(seed, step, active=F.col("active"), max_rounds=10)
    got = sorted((r.k, r.depth) for r in out.collect())
    assert got == [(1, 0), (1, 1), (1, 2), (1, 3), (2, 0), (2, 1)]


def _py_uniform(seed, *keys):
    h = hashlib.md5("|".join([seed] + [str(k) for k in keys]).encode()).hexdigest()
    return int(h[:13], 16) / float(1 << 52)


def test_frontier_loop_raises_when_rounds_run_out(spark):
    import glob

    from lumen.session import ensure_checkpoint_dir
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{folder}/lumen-round-*"))
    seed = spark.createDataFrame([(1, True)], "k int, active boolean")
    with pytest.raises(RuntimeError, match="1 rows still active after 3 rounds"):
        frontier_loop(seed, lambda fr, r: fr, active=F.col("active"), max_rounds=3)
    assert set(glob.glob(f"{folder}/lumen-round-*")) == before          # and leaves no table behind


def test_only_a_local_session_may_use_a_local_folder():
    from types import SimpleNamespace

    from lumen.session import ensure_checkpoint_dir
    conf = SimpleNamespace(get=lambda *a: None)
    context = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context, conf=conf))
    context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context, conf=conf))


# ---- null keys ----------------------------------------------------------------------------

@pytest.mark.parametrize("n_splits", [1, 5, 50])
def test_null_keys_are_one_key_however_rows_are_split(spark, n_splits, monkeypatch):
    from lumen.operators import sequence as S
    plain = S.add_split
    monkeypatch.setattr(S, "add_split", lambda df, key, order, **kw: plain(df, key, order, **{**kw, "n_splits": n_splits}))
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i * 7 % 40), None if i % 3 else i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, ts timestamp_ntz, k bigint").repartition(4)
    by_key = {}
    for i, t, k in sorted(rows, key=lambda r: (r[1], r[0])):
        by_key.setdefault(k, []).append((t, i))
    place = {i: (k, p) for k, own in by_key.items() for p, (_, i) in enumerate(own)}
    following = {r.id: [x.id for x in r.following] for r in with_following(df, "k", "ts", "id", 3, []).collect()}
    assert following == {i: [j for _, j in by_key[k][p + 1:p + 4]] for i, (k, p) in place.items()}
    assert {r.id: r.pos for r in with_positions(df, "k", "ts", "id").collect()} == {i: p for i, (_, p) in place.items()}
    nexts = {r.id: r.next_id for r in with_next_row(df, "k", "ts", "id", []).collect()}
    assert nexts == {i: by_key[k][p + 1][1] if p + 1 < len(by_key[k]) else None for i, (k, p) in place.items()}
    found = first_match_after(df, df, "k", probe_ts="ts", probe_id="id", cand_ts="ts", cand_id="id")
    when = {i: t for i, t, _ in rows}
    want = {i: next((j for t, j in by_key[k] if t > when[i]), None) if k is not None else None for i, (k, _) in place.items()}
    assert {r.id: r.match_id for r in found.collect()} == want


def test_keyed_uniform_equals_python_md5(spark):
    df = spark.range(50).select(F.col("id").alias("k"), F.lit(3).alias("i"))
    got = {r.k: r.u for r in df.select("k", keyed_uniform("s", F.col("k"), F.col("i")).alias("u")).collect()}
    assert all(got[k] == _py_uniform("s", k, 3) for k in got)
    assert all(0.0 <= u < 1.0 for u in got.values())


@pytest.mark.parametrize("batch", [1, 3])
def test_redraw_until_accepted_first_accepted_draw(spark, batch):
    keys = spark.range(60).select(F.col("id").alias("k"))

    def accept(t):
        return t.withColumn("accepted", F.col("candidate") % 5 == 0)

    out = redraw_until_accepted(keys, "k", draw=lambda i: F.floor(keyed_uniform("t", F.col("k"), i) * 20).cast("bigint"),
                                accept=accept, batch=batch)
    got = {r.k: (r.draws, r.candidate) for r in out.collect()}
    assert set(got) == set(range(60))
    for k, (d, c) in got.items():
        i = 1
        while math.floor(_py_uniform("t", k, i) * 20) % 5 != 0:
            i += 1
        assert (d, c) == (i, math.floor(_py_uniform("t", k, i) * 20))


# ---- nearest match ------------------------------------------------------------------------

BALLS = [(11, [0.0, 3.0], 1.0), (10, [0.0, 3.0], 1.0), (12, [5.0, 0.5], 0.2), (13, [500.0, 0.0], 1000.0), (14, None, 1.0),
         (15, [float("nan"), 0.0], 1e9), (16, [1.0], 1e9), (17, [7.0, 7.0], 0.0)]
POINTS = [(1, [0.0, 3.5]), (2, [5.0, 0.6]), (3, [-900.0, 0.0]), (4, None), (5, [float("nan"), 0.0]), (6, [1.0]), (7, [7.0, 7.0]),
          (8, [0.0, 3.0])]


@pytest.mark.parametrize("block_rows", [1, 3, 100])
def test_nearest_in_blocks_equals_brute_force(spark, block_rows):
    probes = spark.createDataFrame(POINTS, "pid int, p array<double>")
    balls = spark.createDataFrame(BALLS, "ball int, c array<double>, r double")

    def inside(b):
        return V.let(F.sqrt(V.sqdist("p", b["c"])), lambda d: F.when(d <= b["r"], d))
    out = nearest_in_blocks(probes, "pid", balls, order_key="ball", score=inside, item="ball", block_rows=block_rows)
    want = {}
    for pid, p in POINTS:
        found = []
        for ball, c, r in BALLS:
            if p is not None and c is not None and len(p) == len(c):
                d = math.sqrt(sum((x - y) ** 2 for x, y in zip(p, c)))
                if d <= r:
                    found.append((d, ball))
        want[pid] = min(found)[1] if found else None
    assert {r.pid: r.ball for r in out.collect()} == want
    assert want[1] == 10 and want[7] == 17 and want[3] is None and want[2] == 12


def test_nearest_in_blocks_without_a_catalogue(spark):
    probes = spark.createDataFrame(POINTS, "pid int, p array<double>")
    balls = spark.createDataFrame([], "ball int, c array<double>, r double")
    out = nearest_in_blocks(probes, "pid", balls, order_key="ball", score=lambda b: V.sqdist("p", b["c"]), item="ball")
    assert out.count() == len(POINTS) and out.where("ball IS NOT NULL").count() == 0


# ---- vectors and guards -------------------------------------------------------------------

def test_vector_properties(spark):
    df = spark.createDataFrame([([3.0, 4.0, 0.0], [0.0, 1.0, 0.0]), ([0.0, 0.0, 0.0], [1.0, 0.0, 0.0]),
                                ([1.0, -2.0, 2.0], [0.6, 0.8, 0.0])], "v array<double>, n array<double>")
    out = df.select(V.norm(V.normalize("v")).alias("unit"), V.norm("v").alias("len"),
                    V.norm(V.remove_direction("v", "n", 2.0)).alias("reflected_len"),
                    V.dot(V.remove_direction("v", "n", 1.0), "n").alias("dot_after")).collect()
    assert out[0].unit == pytest.approx(1.0, abs=1e-12)
    assert out[1].unit is None
    for r in out:
        assert r.reflected_len == pytest.approx(r.len, abs=1e-12)
        assert r.dot_after == pytest.approx(0.0, abs=1e-12)


def test_guards_never_raise(spark):
    df = spark.createDataFrame([(-4.0,), (0.0,), (4.0,), (None,)], "x double")
    out = [(r.s, r.i) for r in df.select(guarded_sqrt("x").alias("s"), guarded_inverse("x", 10.0).alias("i")).collect()]
    assert out == [(None, None), (0.0, None), (2.0, 2.5), (None, None)]


def test_three_shifted_waves_are_a_hue_circle(spark):
    df = spark.createDataFrame([(i * 0.05,) for i in range(120)], "h double")
    rows = df.select("h", *[triangle_wave("h", shift, 0.1125, 0.45).alias(x) for shift, x in ((0, "a"), (2, "b"), (4, "c"))]).collect()
    for r in rows:
        assert (r.a, r.b, r.c) == pytest.approx(colorsys.hsv_to_rgb(r.h / 6.0, 0.75, 0.45), abs=1e-12)


def test_numbers_that_are_not_plain(spark):
    from lumen.functions.numeric import snap

    def frame(*xs):
        return spark.createDataFrame([(float(x) if x is not None else None,) for x in xs], "x double")
    got = [r[0] for r in frame("nan", 1e13, "inf", "-inf", None, 0.1234567, -2.5).select(snap("x")).collect()]
    assert math.isnan(got[0]) and got[1:] == [1e13, math.inf, -math.inf, None, 0.123457, -2.5]


def test_quantising_without_a_positive_maximum(spark):
    df = spark.createDataFrame([(4.0, 16.0), (4.0, 0.0), (4.0, -1.0), (-4.0, 16.0), (float("nan"), 16.0), (4.0, None)], "x double, m double")
    assert [r[0] for r in df.select(quantize_sqrt("x", "m", 10)).collect()] == [5, None, None, None, None, None]


# ---- routing and assembly -----------------------------------------------------------------

def test_route_every_row_once(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("z", 3.0), (None, 4.0)], "t string, v double")
    routes = [("X", F.col("t") == "x", F.col("v") * 2), ("Y", F.col("t") == "y", F.col("v") * 3)]
    single = {r.route: r.amount for r in route(df, routes, ("other", F.lit(0.0))).collect() if r.route != "other"}
    assert single == {"X": 2.0, "Y": 6.0}
    assert route(df, routes, ("other", F.lit(0.0))).groupBy("route").count().count() == 3
    branches = [("X", F.col("t") == "x", lambda d: d), ("Y", F.col("t") == "y", lambda d: d)]
    assert route_and_union(df, branches, ("other", lambda d: d)).count() == 4


def test_ordered_concat_and_line_numbers(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 0, "a"), (1, 5, None), (2, 1, "z")], "g int, o int, t string")
    got = {r.g: (r.n_parts, r.text) for r in ordered_concat(df, ["g"], "o", F.col("t"), "|").collect()}
    assert got == {1: (3, "a|b"), 2: (1, "z")}
    big = spark.range(0, 5000, 1, 9).select(((F.col("id") * 7919) % 5000).alias("k"))
    numbered = global_line_numbers(big, ["k"], n_partitions=7)
    rows = sorted((r.k, r.line_no) for r in numbered.collect())
    assert [ln for _, ln in rows] == list(range(1, 5001))


def test_redraw_nested_in_frontier_step(spark):
    """A frontier step that itself runs a redraw loop (recursion inside a recursive step):
    each round, every active walker redraws until it gets an even candidate, then moves."""
    seed = spark.range(20).select(F.col("id").alias("k"), F.lit(0).alias("depth"), F.lit(0).alias("pos"),
                                  F.lit(True).alias("active"))

    def step(fr, r):
        keys = fr.select((F.col("k") * 100 + F.col("depth")).alias("dk"), "k", "depth", "pos")
        got = redraw_until_accepted(
            keys.select("dk"), "dk",
            draw=lambda i: F.floor(keyed_uniform("nest", F.col("dk"), i) * 10).cast("bigint"),
            accept=lambda t: t.withColumn("accepted", F.col("candidate") % 2 == 0), batch=2)
        moved = keys.join(got, "dk")
        return moved.select("k", (F.col("depth") + 1).alias("depth"), (F.col("pos") + F.col("candidate")).alias("pos"),
                            (F.col("depth") + 1 < 3).alias("active"))

    out = frontier_loop(seed, step, active=F.col("active"), max_rounds=5).collect()
    assert len(out) == 20 * 4
    for k in range(20):
        pos = 0
        for d in range(3):
            dk, i = k * 100 + d, 1
            while math.floor(_py_uniform("nest", dk, i) * 10) % 2:
                i += 1
            pos += math.floor(_py_uniform("nest", dk, i) * 10)
        assert [r.pos for r in out if r.k == k and r.depth == 3] == [pos]


def test_frontier_null_state_is_inactive(spark):
    seed = spark.createDataFrame([(1, 0, None), (2, 0, True)], "k int, depth int, active boolean")

    def step(fr, r):
        return fr.select("k", (F.col("depth") + 1).alias("depth"), F.lit(False).alias("active"))

    got = sorted((r.k, r.depth) for r in frontier_loop(seed, step, active=F.col("active"), max_rounds=3).collect())
    assert got == [(1, 0), (2, 0), (2, 1)]


def test_cross_and_orient(spark):
    df = spark.createDataFrame([([1.0, 0.0, 0.0], [0.0, 1.0, 0.0]), ([2.0, 3.0, 4.0], [5.0, 6.0, 7.0])],
                               "a array<double>, b array<double>")
    out = df.select(V.cross3("a", "b").alias("c"), V.orient("a", "b").alias("o"),
                    V.dot(V.cross3("a", "b"), "a").alias("ca")).collect()
    assert out[0].c == [0.0, 0.0, 1.0]
    assert out[1].c == [3 * 7 - 4 * 6, 4 * 5 - 2 * 7, 2 * 6 - 3 * 5]
    assert all(r.ca == 0.0 for r in out)
    assert out[0].o == [1.0, 0.0, 0.0] or out[0].o == [-1.0, -0.0, -0.0]
    assert out[1].o == [-2.0, -3.0, -4.0]


def test_frontier_loop_empty_seed(spark):
    seed = spark.createDataFrame([], "k int, depth int, active boolean")

    def step(fr, r):
        raise AssertionError("no round should run")

    out = frontier_loop(seed, step, active=F.col("active"), max_rounds=3)
    assert out.count() == 0 and out.columns == ["k", "depth", "active"]


def test_redraw_empty_keys(spark):
    keys = spark.createDataFrame([], "k bigint")
    out = redraw_until_accepted(keys, "k", draw=lambda i: F.lit(0).cast("bigint"),
                                accept=lambda t: t.withColumn("accepted", F.lit(True)))
    assert out.count() == 0


def test_line_numbers_with_ties_are_a_permutation(spark):
    df = spark.range(0, 3000, 1, 5).select(F.col("id"), (F.col("id") % 7).alias("k"))   # heavy ties on k
    rows = global_line_numbers(df, ["k"], n_partitions=4).collect()
    assert sorted(r.line_no for r in rows) == list(range(1, 3001))
    by_line = sorted(rows, key=lambda r: r.line_no)
    assert [r.k for r in by_line] == sorted(r.k for r in rows)      # numbering follows the order


def test_parameter_guards(spark):
    df, _ = _events(spark, n=10)
    with pytest.raises(ValueError):
        with_following(df, "user_id", "ts", "event_id", 0, [])
    with pytest.raises(ValueError):
        top_per_key(df, ["user_id"], [F.col("ts")], n=0)
    with pytest.raises(ValueError):
        redraw_until_accepted(df.select("event_id"), "event_id", draw=lambda i: i, accept=lambda t: t, batch=0)
