"""Fingerprints, ranked search and phrases against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lumen.llm import fingerprints as fp
from lumen.llm import lexical_search as ls
from lumen.llm import phrases
from lumen.llm.queries import ORACLES, QUERIES
from lumen.llm.transducers import Transducer, summed, union
from tests.conftest import SF001, SF01
from tests.helpers import canon, rows_of

TEXTS = st.text(alphabet="ab .é\n𝄞", max_size=300)


# ---- fingerprints ---------------------------------------------------------------------------

def plain_ends(data):
    """Chunk ends byte by byte."""
    gear = [int(g) for g in fp.GEAR]
    ends, start, hashed = [], 0, []
    for k in range(len(data)):
        hashed.append(sum(gear[data[k - age]] << age for age in range(min(16, k + 1))) % 2**32)
    while start < len(data):
        end = start + 1
        while end < len(data):
            size = end - start
            if size >= fp.MOST or size >= fp.LEAST and hashed[end - 1] < (fp.STRICT if size < fp.NORMAL else fp.LOOSE):
                break
            end += 1
        ends.append(end)
        start = end
    return ends


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_chunks_equal_a_byte_by_byte_search(text):
    assert fp.chunk_ends(text.encode()) == plain_ends(text.encode())


def test_blocks_do_not_move_boundaries(monkeypatch):
    data = random.Random(3).randbytes(5000)
    whole = fp.chunk_ends(data)
    assert whole == plain_ends(data)
    monkeypatch.setattr(fp, "BLOCK", 97)
    assert fp.chunk_ends(data) == whole


def test_an_insertion_changes_few_chunks():
    words = [f"w{random.Random(k).randrange(9999)}" for k in range(600)]
    text = " ".join(words)
    moved = fp.fingerprint("something new at the front " + text)
    assert fp.likeness(fp.fingerprint(text), moved) > 0.95
    assert fp.likeness(fp.fingerprint(text), fp.fingerprint(text)) == 1.0
    assert fp.from_hex(fp.as_hex(moved)).tolist() == moved.tolist()


def plain_edits(rows):
    """The results of rows (doc_id, text) from one list in order."""
    texts = [t or "" for _, t in rows]
    rows = sorted(zip([i for i, _ in rows], texts, strict=True), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (doc, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]

        def marks(t):
            data, start, found = t.encode(), 0, {}
            for end in plain_ends(data):
                found[data[start:end]] = end - start
                start = end
            return found
        own = marks(text)

        def like(other, own=own):
            return sum(n for c, n in own.items() if c in other) / sum(own.values()) if own else float(not other)
        out.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), like(marks(changed)), like(marks(following))))
    return sorted(out, key=str)


def found_edits(df):
    return sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("parts", ["1", "8", "40"])
def test_edited_fingerprints_equal_brute_force(spark, parts):
    draw = random.Random(5)
    rows = [(k, " ".join(f"w{draw.randrange(50)}" for _ in range(draw.choice([0, 1, 5, 60])))) for k in draw.sample(range(-40, 400), 90)]
    rows += [(1000, None), (1001, ""), (1002, "é𝄞" * 90), (1003, "x" * 3000)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, part int").repartition(3).cache()
        assert found_edits(fp.edited_fingerprints(docs)) == plain_edits(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_edits_of_repeated_and_null_rows(spark):
    rows = [(None, "same text of nobody")] * 40 + [(7, "seven")] * 3 + [(9, "nine nine nine")]
    got = found_edits(fp.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)))
    assert got == plain_edits(rows)
    assert found_edits(fp.edited_fingerprints(spark.createDataFrame([(1, "alone and long")], "doc_id long, text string"))) == plain_edits([(1, "alone and long")])
    assert fp.edited_fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_fingerprint_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    df = QUERIES["op11_fingerprints"](spark, SF001)
    short = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found_edits(df) == plain_edits(short)
    marks = {r["doc_id"]: r["fingerprint"] for r in df.collect()}
    assert {r["doc_id"]: r["fingerprint"] for r in fp.fingerprint_texts(docs).collect()} == marks


# ---- ranked search ---------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, top=10):
    rows = [(i, Counter(plain_terms(t))) for i, t in docs]
    n_all = sum(bool(c) for _, c in rows)
    l_all = sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in rows:
            m = 10 + (90 * sum(c.values()) * n_all) // l_all if l_all else 0
            score = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(plain_terms(text)) if c[t])
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, k + 1, f[3], -f[0]) for k, f in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def test_terms_equal_the_pattern():
    text = "Ab-c É_x 12\x7f3 ßA B 𝄞z Ⅷ ABC'd\n\tİ"
    assert [t.decode() for t in ls.terms_of(text)] == plain_terms(text)


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ls, "TREE", 64)
    monkeypatch.setattr(ls, "LEAF", 4)
    draw = random.Random(11)

    def text(n):
        return " ".join(f"t{int(draw.paretovariate(0.7))}" for _ in range(n))
    docs = [(k, text(draw.choice([1, 5, 30, 200]))) for k in range(400)]
    docs += [(500 + k, docs[3][1]) for k in range(30)] + [(None, docs[3][1]), (None, text(9)), (600, None), (601, " .-"), (3, docs[5][1])]
    items = [(k, text(12)) for k in range(20)] + [(20, docs[3][1]), (21, docs[3][1]), (22, ""), (23, None), (24, "unknown words"), (None, "t1 t1 t2")]
    rows = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, score string").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in ls.search(spark, rows, asked).collect()), key=str)
    assert got == plain_search(docs, items)
    monkeypatch.setattr(ls, "BLOCK_CHARS", 200)              # several blocks of items
    assert sorted((tuple(r) for r in ls.search(spark, rows, asked).collect()), key=str) == got


def test_search_of_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ls.search(spark, empty, items).count() == 0
    assert ls.search(spark, spark.createDataFrame([(1, "a b")], "doc_id long, text string"), items.where("false")).count() == 0


def test_ball_trees_bound_and_prune():
    draw = np.random.default_rng(2)
    # documents near eight centres: far ones are pruned without a score
    n = 1024
    first = np.arange(n + 1) * 20
    term = (np.repeat(draw.permutation(np.arange(n) % 8), 20) * 40 + np.tile(np.arange(20) * 2, n))
    value = draw.integers(990, 1000, first[-1])
    tree = ls.BallTree(first, term, value, 400)
    dense = np.zeros((n, 400), np.int64)
    dense[np.repeat(np.arange(n), 20), term] = value
    scored = 0
    for q in range(20):
        terms = np.unique(draw.integers(0, 40, 8)) + 40 * (q % 8)
        exact = dense[:, terms].sum(axis=1)
        bounds = tree.bounds(terms)

        def inside(node):
            low, high = tree.leaves.get(node, (0, 0))
            return list(tree.order[low:high]) + [d for child in tree.children[node] or () for d in inside(child)]
        for node in range(len(tree.children)):
            assert exact[inside(node)].max() <= bounds[node]
        best, some = tree.search(terms, 1, [], list(range(n)))
        scored += some
        assert best == sorted((-int(s), False, k) for k, s in enumerate(exact) if s > 0)[:10]
    assert scored < 10_000


# ---- phrases ---------------------------------------------------------------------------------

def plain_phrases(rows, least, percent=80, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3, 4):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        left = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= percent * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()):
                continue
            score, cut = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            left.append((-score, -a, " ".join(p).encode(), counts[p[:cut]], counts[p[cut:]]))
        out += [(lang, k + 1, p.decode(), -a, lo, r, n[lang], -s) for k, (s, a, p, lo, r) in enumerate(sorted(left)[:top])]
    return sorted(out)


def phrase_rows():
    draw = random.Random(4)
    rows = []
    for k in range(300):
        words = [f"{'Wé'[draw.randrange(2)]}{int(draw.paretovariate(0.8)) % 40}" for _ in range(draw.choice([0, 1, 3, 40]))]
        at = draw.randrange(len(words) + 1)
        words[at:at] = ["of", "the", "NEW", "york"] if k % 3 else ["york\x0bof", "the"]
        rows.append((["en", "fr", None, "en en"][k % 4], "".join(w + draw.choice([" ", "  ", "\t", ". ", "\r\n", "…", " "]) for w in words)))
    return rows + [("en", None), (None, ""), ("xx", " .,"), ("of", "of the of the of the of the")] + [("en", "hot copy of words")] * 100


@pytest.mark.parametrize("held", [None, 40])
def test_phrases_equal_brute_force(spark, monkeypatch, held):
    if held:                                                 # many small transducers, many blocks
        for name, value in (("HELD_WORDS", held), ("HELD_PHRASES", held), ("HELD_PATHS", held), ("BLOCK_BYTES", 300)):
            monkeypatch.setattr(phrases, name, value)
    rows = phrase_rows()
    docs = spark.createDataFrame([(lang, t, 1, "y") for lang, t in rows], "lang string, text string, n int, part string").repartition(4)
    for least, top in ((5, 2000), (3, 7)):
        got = sorted(tuple(r) for r in phrases.collocations(docs, least=least, top=top).collect())
        assert got == plain_phrases(rows, least, top=top)


def test_phrases_of_empty_tables(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert phrases.collocations(spark.createDataFrame([("en", None)], "lang string, text string")).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5), st.integers(0, 5), st.integers(1, 3)), min_size=1, max_size=60))
def test_transducers_count_and_compose(rows):
    table = pa.array([f"s{k}".encode() for k in range(6)], pa.binary())
    want = Counter()
    for a, b, c, w in rows:
        want[a, b, c] += w
    parts = []
    for some in (rows[::2], rows[1::2]):
        if some:
            paths, weights = summed(np.array([r[:3] for r in some]), np.array([r[3] for r in some]))
            parts.append(Transducer.from_bytes(Transducer.of_sorted(table, paths, weights).to_bytes()))
    both = union(parts)
    paths, weights = both.paths()
    names = [s.decode() for s in both.symbols.to_pylist()]
    got = [(tuple(int(names[k][1:]) for k in p), int(w)) for p, w in zip(paths, weights, strict=True)]
    assert got == sorted(want.items())
    every = np.array([(a, b, c) for a in range(6) for b in range(6) for c in range(6)])
    f, here = both.composed(Transducer.of_sorted(table, every, np.ones(len(every), np.int64)))
    assert [(tuple(map(int, p)), int(n)) for p, n, ok in zip(every, f, here, strict=True) if ok] == sorted(want.items())
    assert sum(len(v) for _, _, v in both.layers) <= 3 * len(want)


def test_transducers_share_ends():
    table = pa.array([f"{k:03}".encode() for k in range(200)], pa.binary())
    paths = np.array([(a, 198, 199) for a in range(100)])
    one = Transducer.of_sorted(table, paths, np.ones(100, np.int64))
    assert [len(v) for _, _, v in one.layers] == [100, 1, 1]


@pytest.mark.parametrize("name", ["op12_lexical_search", "op13_phrases"])
def test_queries_equal_their_twins(spark, duck, name):
    df = QUERIES[name](spark, SF01)
    rel = duck.execute(ORACLES[name])
    names = [d[0] for d in rel.description]
    cols = sorted(names)
    want = sorted(tuple(canon(r[names.index(c)]) for c in cols) for r in rel.fetchall())
    assert sorted(df.columns) == cols
    assert rows_of(df, cols) == want
