"""Properties of the registered queries on the smoke tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from lumen.plans import queries as Q
from lumen.sources.tables import load
from tests.conftest import SF001
from tests.helpers import rows_of


def test_journey_properties(spark):
    rows = Q.journeys(spark, SF001).collect()
    by = {}
    for r in rows:
        by.setdefault(r.journey_id, []).append(r)
    for path in by.values():
        path.sort(key=lambda r: r.depth)
        assert [r.depth for r in path] == list(range(len(path)))
        assert path[-1].depth <= Q.JOURNEY_HOPS + 1
        assert all(a.weight >= b.weight for a, b in zip(path, path[1:]))
        assert all(r.active for r in path[:-1])
        if path[-1].depth == Q.JOURNEY_HOPS + 1:
            assert path[-1].event_id is None and not path[-1].active and path[-1].weight == 0.0


def test_replicate_count(spark):
    n_orders = load(spark, SF001, "orders").count()
    out = E.queries()["replicate_rows"](spark, SF001)
    assert out.agg(F.sum("n")).first()[0] == Q.INSTALMENTS * n_orders


def test_redraw_accepts_only_eligible(spark):
    out = E.queries()["redraw_until_accept"](spark, SF001)
    part = load(spark, SF001, "part", "p_partkey", "p_size")
    j = out.join(part, "p_partkey")
    assert j.where(F.col("p_size") > Q.REDRAW_MAX_SIZE).count() == 0
    assert out.count() == load(spark, SF001, "customer").count()


def test_latest_one_row_per_key(spark):
    out = E.queries()["latest_per_key"](spark, SF001)
    assert out.count() == out.select("o_custkey").distinct().count()


def test_framed_export_lines(spark, tmp_path):
    from lumen.sources.export import write_ordered_text
    lines = E.queries()["framed_export"](spark, SF001)
    path = str(tmp_path / "out")
    write_ordered_text(lines, "line_no", "line", path, n_files=3)
    import glob
    text = "".join(open(p).read() for p in sorted(glob.glob(path + "/part-*")))
    got = text.splitlines()
    assert got[0] == "|".join(Q.NATION_COLUMNS)
    assert len(got) == 26
    assert [int(x.split("|")[0]) for x in got[1:]] == sorted(int(x.split("|")[0]) for x in got[1:])


def test_matches_do_not_depend_on_the_block_size(spark):
    for query in (Q.q_nearest_centroid, Q.q_nearest_zone):
        assert rows_of(query(spark, SF001)) == rows_of(query(spark, SF001, block_rows=1)) == rows_of(query(spark, SF001, block_rows=3))


def test_last_states_equal_last_rows(spark):
    from pyspark.sql import functions as F

    from lumen.operators.topk import top_per_key
    rows = Q.journeys(spark, SF001)
    last = top_per_key(rows, ["journey_id"], [F.col("depth").desc()]).select("journey_id", "user_id", "depth", "weight")
    assert rows_of(last) == rows_of(Q.journey_last_states(spark, SF001))


def test_redraw_without_an_eligible_part_raises_at_once(spark, tmp_path):
    part = load(spark, SF001, "part").withColumn("p_size", F.lit(99))
    part.write.parquet(str(tmp_path / "part.parquet"))
    load(spark, SF001, "customer").write.parquet(str(tmp_path / "customer.parquet"))
    with pytest.raises(ValueError, match="p_size"):
        Q.q_redraw_until_accept(spark, str(tmp_path))


@pytest.mark.parametrize("name", ["restock_walk", "redraw_until_accept"])
def test_the_rounds_of_a_redraw_send_no_parts_to_the_driver(spark, tmp_path, name):
    part = spark.range(200_000).select(F.col("id").alias("p_partkey"), (F.col("id") % 50).cast("int").alias("p_size"), F.lit(1.0).alias("p_retailprice"))
    part.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    for table in ("supplier", "customer"):
        load(spark, SF001, table).write.parquet(str(tmp_path / f"{table}.parquet"))
    sc = spark.sparkContext
    sc.setJobGroup(f"sent-{name}", name)
    try:
        E.queries()[name](spark, str(tmp_path)).collect()
    finally:
        sc.setJobGroup("", "")
    stages = {s for j in sc.statusTracker().getJobIdsForGroup(f"sent-{name}") for s in sc.statusTracker().getJobInfo(j).stageIds}
    sent = max(sc._jsc.sc().statusStore().lastStageAttempt(s).resultSize() for s in stages)
    assert sent < 500_000, sent


def test_plane_projection_needs_both_labels(spark, tmp_path):
    load(spark, SF001, "embeddings").where("label <> 1").write.parquet(str(tmp_path / "embeddings.parquet"))
    with pytest.raises(ValueError, match="labels 0 and 1"):
        Q.q_plane_projection(spark, str(tmp_path))


def test_date_spine_of_no_events(spark, tmp_path):
    load(spark, SF001, "events").limit(0).write.parquet(str(tmp_path / "events.parquet"))
    assert Q.q_date_spine_counts(spark, str(tmp_path)).count() == 0


def test_cooldown_chain_by_hand(spark):
    events = sorted((r.ts, r.event_id, r.user_id, r.event_type) for r in load(spark, SF001, "events").collect())
    want = []
    for ts, event_id, user, kind in events:
        if kind != "signup":
            continue
        at, depth, weight, active, last = ts, 0, 1.0, True, event_id
        want.append((event_id, 0, last, weight, True))
        while active:
            due = at + dt.timedelta(seconds=(int((1 - weight) * 10 + 1e-9) + 1) * Q.CHAIN_HOUR)
            after = [e for e in events if e[2] == user and e[0] > due]
            if not after:
                break
            at, last, _, kind_now = after[0]
            depth += 1
            weight = 0.0 if kind_now == "error" else weight * Q.JOURNEY_FACTORS.get(kind_now, 1.0)
            active = kind_now != "error" and depth < Q.CHAIN_STEPS
            want.append((event_id, depth, last, weight, active))
    got = sorted((r.journey_id, r.depth, r.event_id, round(r.weight, 6), r.active) for r in Q.q_cooldown_chain(spark, SF001).collect())
    assert got == sorted((a, b, c, round(w, 6), x) for a, b, c, w, x in want)


def test_route_forms_agree_on_events(spark):
    from pyspark.sql import functions as F

    from lumen.functions.numeric import snap
    from lumen.operators.exact import exact_sums
    from lumen.operators.route import route_and_union
    ev = load(spark, SF001, "events", "event_type", "value")

    def times(factor):
        return lambda d: d.withColumn("amount", F.col("value") * F.lit(factor))

    def flat(amount):
        return lambda d: d.withColumn("amount", F.lit(amount))
    branches = [("purchase", F.col("event_type") == "purchase", times(0.7)), ("view", F.col("event_type") == "view", times(0.01)),
                ("click", F.col("event_type") == "click", flat(0.05))]
    unioned = route_and_union(ev, branches, ("other", flat(0.0)))
    per_route = exact_sums(unioned, ["route"], {"total": "amount"}).select("route", F.col("n_rows").alias("n"), snap("total").alias("total"))
    assert rows_of(per_route) == rows_of(E.queries()["route_and_union"](spark, SF001))
