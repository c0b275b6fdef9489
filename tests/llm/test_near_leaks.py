"""Near-dedup and decontamination against brute force."""

import random
from itertools import combinations
from pathlib import Path
from urllib.parse import urlparse

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lumen.llm import decontaminate, near_dedup
from lumen.llm.components import connected_components
from lumen.llm.queries import ORACLES, QUERIES
from lumen.llm.shared import maybe_among, workspace, written
from lumen.llm.shingles import shingle_set
from lumen.session import ensure_checkpoint_dir
from tests.conftest import SF001, SF01
from tests.helpers import rows_of


def plain_shingles(text, words):
    w = (text or "").encode().lower().split()
    return {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()


def expect_near(rows, words, percent):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    known = [(i, plain_shingles(t, words)) for i, t in rows if i is not None]
    for i, _ in known:
        find(i)
    for (i, a), (j, b) in combinations(known, 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = sorted((find(i), find(j)))
            parent[y] = x
    out = []
    for i, t in rows:
        n = len(plain_shingles(t, words))
        c = None if i is None else find(i)
        out.append((i, n, c, i == c))
    return sorted(out, key=str)


def edited(words, changes):
    words = list(words)
    for _ in range(changes):
        words[random.randrange(len(words))] = f"new{random.randrange(10**6)}"
    return " ".join(words)


def near_rows():
    random.seed(7)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE two three"), (None, "one two three"), (8, "É é"), (9, "é é")]
    for base in range(4):                     # copies with more and more edits: chains around the threshold
        words = [f"w{random.randrange(300)}" for _ in range(random.choice([12, 60, 200]))]
        rows += [(100 * (base + 1) + k, edited(words, k // 4)) for k in range(24)]
    chain = [f"c{k}" for k in range(120)]     # each is near the next only
    rows += [(600 + k, " ".join(chain[2 * k:2 * k + 90])) for k in range(15)]
    shared = " ".join(f"s{k}" for k in range(30))
    rows += [(700 + k, shared + " " + " ".join(f"u{random.randrange(10**6)}" for _ in range(8 + k))) for k in range(40)]
    rows += [(800, shared), (800, shared), (801, shared)]
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize(("words", "percent", "rows"), [(3, 85, 5), (5, 80, 5)])
def test_near_dedup_equals_brute_force(spark, words, percent, rows):
    data = near_rows()
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in data], "doc_id long, text string, component long, registers int").repartition(5)
    got = near_dedup.near_dedup(frame, words, percent, rows)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expect_near(data, words, percent)


def test_links_between_members_that_the_pivot_does_not_reach(spark):
    random.seed(21)
    base = [f"b{k}" for k in range(150)]
    rows = [(1, " ".join(base))]
    for f in range(12):                       # families of a farther copy, whose members are near one another
        words = edited(base, 6 + f % 4).split()
        rows += [(10 + 40 * f + k, edited(words, k % 3)) for k in range(8)]
        rows += [(20 + 40 * f + k, " ".join(words[:150 - 2 * k])) for k in range(6)]
    rows += [(1000 + k, edited(base, 1 + k % 9)) for k in range(150)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in near_dedup.near_dedup(frame).collect()), key=str) == expect_near(rows, 3, 85)


def test_a_pivots_parts_lose_no_link(spark, monkeypatch):
    random.seed(33)
    monkeypatch.setattr(near_dedup, "MEMBERS", 7)
    base = [f"h{k}" for k in range(120)]
    rows = [(k, edited(base, k % 11)) for k in range(160)]
    far = edited(base, 9).split()                      # near one another, dealt to several parts of one pivot
    rows += [(200 + k, edited(far, 1 + k % 2)) for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in near_dedup.near_dedup(frame).collect()), key=str) == expect_near(rows, 3, 85)


def test_a_run_leaves_its_result_only(spark):
    folder = Path(urlparse(ensure_checkpoint_dir(spark)).path)
    rows = [(k, " ".join(f"t{(k // 3) * 100 + j}" for j in range(40))) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = set(folder.iterdir())
    near = near_dedup.near_dedup(docs)
    leaks = decontaminate.contained_items(docs, docs.selectExpr("doc_id AS item_id", "text"))
    assert sorted(p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before) == ["contained", "near-dedup"]
    assert near.where("kept").count() == 10 and leaks.count() == 90


def test_a_failed_run_leaves_nothing(spark):
    folder = Path(urlparse(ensure_checkpoint_dir(spark)).path)
    before = set(folder.iterdir())
    with pytest.raises(ZeroDivisionError), workspace(spark, "failing") as place:
        written(spark.range(3), "numbers", place)
        raise ZeroDivisionError
    assert set(folder.iterdir()) == before


def test_rows_that_share_an_id_link_their_texts(spark):
    random.seed(5)
    text = [" ".join(f"t{k}w{random.randrange(10**6)}" for _ in range(40)) for k in range(9)]
    rows = [(3, text[0]), (4, text[1]), (5, text[0]), (5, text[1])]                       # 3 and 4 meet in 5 only
    rows += [(9, ""), (9, text[1]), (10, ""), (10, None), (11, ""), (None, text[0]), (None, "")]
    rows += [(20, text[2]), (20, text[3]), (21, text[3] + " more"), (22, text[2] + " more"), (22, "")]
    rows += [(30, text[4]), (31, text[5]), (32, text[6]), (33, text[4]), (33, text[5]), (34, text[5]), (34, text[6] + " more")]
    rows += [(40, text[7]), (40, text[7]), (41, text[8]), (41, text[8])]
    random.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in near_dedup.near_dedup(frame).collect()), key=str) == expect_near(rows, 3, 85)


def test_near_dedup_of_nothing(spark):
    assert near_dedup.near_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_registers_hold_zeros_and_mantissa():
    values = np.array([(1 << 63) | (3 << 53), 1 << 62, 5 << 20, (1 << 64) - 1], np.uint64)
    for v, r in zip(values.tolist(), near_dedup.compressed(values).tolist(), strict=True):
        zeros = 64 - v.bit_length()
        assert r >> near_dedup.MANTISSA == zeros
        assert r & 1023 == (v << (zeros + 1) & (1 << 64) - 1) >> 54


def test_estimate_is_corrected_for_chance():
    random.seed(1)
    sketcher = near_dedup.Sketcher(4000)
    a = shingle_set(" ".join(f"a{k}" for k in range(400)), 1)
    b = shingle_set(" ".join(f"a{k}" for k in range(40, 440)), 1)
    one, two = (np.frombuffer(sketcher.registers(x), np.uint16) for x in (a, b))
    n = np.array([400])
    assert abs(near_dedup.estimated(np.array([(one == two).sum()]), 4000, n, n)[0] - 360 / 440) < 0.03
    assert 0.0001 < near_dedup.chance(np.array([400.0]), np.array([400.0]))[0] < 0.001
    assert (1 - 0.85**6) ** near_dedup.bands_for(0.85, 6) <= near_dedup.MISS


def test_components_of_long_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1100)] + [(5000, 4000), (4000, 4000)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(201)} | {k: 1000 for k in range(1000, 1100)} | {5000: 4000, 4000: 4000}


def test_decontaminate_equals_sql(spark, duck):
    want = duck.execute(ORACLES["op7_decontaminate"])
    names = [c[0] for c in want.description]
    columns = sorted(names)
    expected = sorted(tuple(repr(r[names.index(c)]) for c in columns) for r in want.fetchall())
    assert expected and rows_of(QUERIES["op7_decontaminate"](spark, SF01), columns) == expected


def expect_leaks(docs, items, words, percent):
    merged = {}
    for i, t in docs:
        merged.setdefault(i, set()).update(plain_shingles(t, words))
    out = {}
    for j, t in items:
        s = plain_shingles(t, words)
        for i, d in merged.items():
            if j is not None and s and 100 * len(s & d) >= percent * len(s):
                old = out.get((i, j), (0, 0))
                out[i, j] = (max(old[0], len(s & d)), max(old[1], len(s)))
    return sorted(((i, j, *v) for (i, j), v in out.items()), key=str)


def test_decontaminate_cases(spark):
    random.seed(9)
    items = [(k, " ".join(f"i{k}x{m}" for m in range(random.choice([3, 5, 6, 12, 40, 90])))) for k in range(30)]
    items += [(None, items[0][1]), (50, None), (51, ""), (52, "short one"), (3, "another text under the same id")]
    docs = [(1, None), (2, ""), (3, "Short ONE"), (4, "a short one inside"), (None, items[8][1]), (5, "x " * 5000 + items[9][1])]
    for d in range(60):
        words = random.choice(items[:30])[1].split()
        cut = words[random.randint(0, len(words) // 5):] if d % 2 else edited(words, d % 3).split()
        docs.append((100 + d, " ".join(["filler"] * (d % 4) + cut + [f"f{random.randrange(50)}" for _ in range(d)])))
    docs += [docs[-1], (200, items[1][1].upper()), (200, items[2][1])]
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, h long, item_id int").repartition(4)
    item_frame = spark.createDataFrame([(j, t, 3) for j, t in items], "item_id long, text string, need int")
    for bits in (decontaminate.BITS, 64):     # a filter that lets everything through changes nothing
        got = decontaminate.contained_items(frame, item_frame, bits=bits)
        assert got.columns == ["doc_id", "item_id", "n_shared", "n_item"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == expect_leaks(docs, items, 5, 80)
    bad = {i for i, *_ in expect_leaks(docs, items, 5, 80)}
    left = decontaminate.without_contaminated(frame, item_frame)
    assert left.columns == frame.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == sorted((i for i, _ in docs if i not in bad), key=str)


def test_rows_go_by_their_own_text(spark):
    item = " ".join(f"i{k}" for k in range(20))
    half, rest = " ".join(item.split()[:12]), " ".join(item.split()[8:])
    clean = [(None, f"clean text number {k} of those without an id") for k in range(6)] + [(None, None), (None, half), (None, rest)]
    clean += [(1, "a clean text whose id another text repeats"), (2, half), (2, rest), (3, None)]
    leaked = [(None, "before " + item), (None, "before " + item), (1, item + " after"), (4, item)]
    frame = spark.createDataFrame([(i, t, 7) for i, t in clean + leaked], "doc_id long, text string, n_chars long").repartition(3)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = decontaminate.without_contaminated(frame, items)
    assert left.columns == frame.columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted(clean, key=str)


def test_decontaminate_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert decontaminate.contained_items(none, items).count() == 0
    assert decontaminate.contained_items(some, items.limit(0)).count() == 0


def test_sketch_misses_rarely():
    from math import comb
    for n in (3, 16, 17, 40, 100, 1000, 5000):
        held, need = decontaminate.sketch_plan(n)
        miss = sum(comb(held, k) * 0.8**k * 0.2 ** (held - k) for k in range(need))
        assert held <= n and (n <= decontaminate.WHOLE or miss <= decontaminate.MISS)


def test_near_query_equals_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF001}/documents.parquet'").fetchall()
    assert sorted((tuple(r) for r in QUERIES["op4_near_dedup"](spark, SF001).collect()), key=str) == expect_near(rows, 3, 85)


def test_a_large_group_makes_few_pairs(spark, monkeypatch):
    """Edited copies of one text, and texts that share a passage their pivot lacks: few pairs, no lost link."""
    random.seed(23)
    base = [f"b{k}" for k in range(60)]
    passages = [[f"p{j}-{k}" for k in range(30)] for j in range(3)]
    rows = [(k, edited(base, random.randrange(7))) for k in range(900)]
    for k in range(300):
        own = [f"o{k // 2}-{j}" for j in range(30 + k % 2)]                # pairs of likely texts share a passage with many
        rows.append((2000 + k, " ".join(base[:40] + passages[k % 6 // 2] + own)))
    made = {}
    plain = near_dedup.close_pairs

    def counted(*args):
        pairs = plain(*args)
        made["rows"], made["pairs"] = pairs.count(), pairs.distinct().count()
        return pairs
    monkeypatch.setattr(near_dedup, "close_pairs", counted)
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), words=5, percent=80)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expect_near(rows, 5, 80)
    assert made["rows"] <= 3 * made["pairs"] + 100
    assert made["pairs"] < 30_000                                            # of 720,000


def shuffled_mb(spark, run):
    """What ``run`` returns and the MB that its stages write to shuffles."""
    sc, group = spark.sparkContext, f"g{random.getrandbits(60)}"
    sc.setJobGroup(group, group)
    try:
        out = run()
    finally:
        sc.setJobGroup("", "")
    stages = {s for j in sc.statusTracker().getJobIdsForGroup(group) for s in sc.statusTracker().getJobInfo(j).stageIds}
    store = sc._jsc.sc().statusStore()
    return out, sum(store.lastStageAttempt(s).shuffleWriteBytes() for s in stages) / 1e6


def test_texts_without_near_copies_are_not_shuffled(spark):
    """Without any automatic broadcast, texts that share no band stay where they are, in op4 and in the pipeline's stage."""
    rng = random.Random(3)
    texts = [" ".join(rng.choices([f"{k:x}" for k in range(4096, 65536, 7)], k=2000)) for _ in range(200)]
    texts += [t + " end" for t in texts[:4]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    docs = written(docs, "plain-docs")
    text_mb = sum(map(len, texts)) / 1e6
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found, mb = shuffled_mb(spark, lambda: sorted(r.doc_id for r in corpus_pipeline.one_of_each(spark, docs, SF01).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == list(range(200))
    assert mb < text_mb / 2, (mb, text_mb)


@pytest.mark.parametrize("n", [0, 1, 5_000])
def test_maybe_among_loses_no_id(spark, n):
    ids = spark.range(n).select((F.col("id") * 7_919 - 3_000_000).alias("kept_id"))
    rows = spark.range(20_000).select((F.col("id") * 7_919 - 3_000_000).alias("k")).union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    got = [(r.k, r.hit) for r in maybe_among(rows, "k", ids, "hit").collect()]
    true = {k for k, hit in got if hit}
    assert len(got) == 20_001 and {k * 7_919 - 3_000_000 for k in range(n)} <= true and None not in true
    assert len(true) - n < 0.2 * 20_000
