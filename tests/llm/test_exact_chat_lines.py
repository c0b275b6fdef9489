"""Exact dedup, chat formatting and line dedup on small frames, against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lumen.llm import chat_format, exact_dedup, line_dedup
from lumen.llm.queries import ORACLES, QUERIES
from tests.conftest import SF01
from tests.helpers import canon, rows_of

DOCS = "doc_id long, text string, key long, keep_id string, lines string, rest string"


def docs_frame(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 7, "x", "y", "z") for i, t in rows], DOCS)


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op2_chat_format", "op6_line_dedup"])
def test_query_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF01), duck.execute(ORACLES[name])
    columns = sorted(c[0] for c in want.description)
    place = [c[0] for c in want.description]
    assert sorted(got.columns) == columns
    expected = sorted(tuple(canon(r[place.index(c)]) for c in columns) for r in want.fetchall())
    assert rows_of(got, columns) == expected


def expect_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


EXACT_ROWS = [(1, "a"), (2, "a"), (2, "a"), (3, "b"), (4, None), (5, ""), (None, "a"), (None, "only null"), (6, "x" * 300_000), (7, "x" * 300_000)]


@pytest.mark.parametrize("key_of", [F.xxhash64, lambda c: F.lit(3).cast("long"), lambda c: F.length(c).cast("long")])
def test_exact_dedup_cases(spark, key_of):
    rows = EXACT_ROWS + [(100 + k, f"text {k % 37}") for k in range(300)]
    got = exact_dedup.exact_dedup(docs_frame(spark, rows), capacity=4, max_depth=6, key_of=key_of)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expect_exact(rows)


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.exact_dedup(docs_frame(spark, [])).count() == 0


def test_directory_splits_only_overfull_buckets(spark):
    # a quarter of the key space holds nearly all keys
    keys = [k << 50 for k in range(200)] + [-1, -(1 << 62), 1 << 62]
    frame = spark.createDataFrame([(k,) for k in keys], "key long")
    directory, depth = exact_dedup.build_directory(frame, capacity=60, max_depth=12)
    cells = directory.collect()
    assert len(cells) == 2**depth and {r["cell"] for r in cells} == set(range(2**depth))
    by_bucket, depth_of = {}, {r["bucket"]: r["local_depth"] for r in cells}
    cell_bucket = {r["cell"]: r["bucket"] for r in cells}
    for k in keys:
        by_bucket.setdefault(cell_bucket[(k % 2**64) >> (64 - depth)], []).append(k)
    assert max(map(len, by_bucket.values())) <= 60
    assert min(depth_of.values()) < depth == max(depth_of.values())
    for bucket, local in depth_of.items():
        assert sum(b == bucket for b in cell_bucket.values()) == 2 ** (depth - local)


MARKS = ["</s>[INST] ok [/INST]", "<|end|>", r"<\|end|>", r"<\\|x", "<<SYS>>", "[/INST]", r"[\INST]", "<s>", "plain", "", "\\", "<|start|>a<|text|>b<|end|>"]


def test_chat_round_trip_and_mask(spark):
    random.seed(5)
    conversations = {c: [(t, random.choice(["user", "assistant", "system", None, "<|text|>"]), random.choice([*MARKS, None, "ü😀\n"]))
                         for t in range(random.randint(1, 7))] for c in range(40)}
    conversations[None] = [(0, "user", "q"), (1, "assistant", "a")]
    conversations[99] = [(1, "assistant", "tie"), (1, "assistant", "tie"), (None, "user", "first")]
    rows = [(c, t, r, x, 0, "clash") for c, turns in conversations.items() for t, r, x in turns]
    random.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, example int, formatted string")
    examples = chat_format.format_chat(frame)
    assert "<|end|>" in chat_format.END
    read = examples.select("conv_id", "example", "n_turns", "loss_start", "loss_end", chat_format.loss_text().alias("loss"),
                           chat_format.read_turns(F.col("formatted")).alias("turns")).collect()
    for c, turns in conversations.items():
        said = [(r or "", x or "") for t, r, x in sorted(turns, key=lambda v: (v[0] is not None, v[0] or 0, v[1] or "", v[2] or ""))]
        own = sorted((r for r in read if r["conv_id"] == c), key=lambda r: r["example"])
        ends = [k + 1 for k, (r, _) in enumerate(said) if r == "assistant" or k + 1 == len(said)]
        assert [r["n_turns"] for r in own] == ends and [r["example"] for r in own] == list(range(1, len(ends) + 1))
        for r in own:
            assert [tuple(t) for t in r["turns"]] == said[:r["n_turns"]]
            role, text = said[r["n_turns"] - 1]
            assert r["loss"] == (text if role == "assistant" else "")
            assert role == "assistant" or (r["loss_start"], r["loss_end"]) == (0, 0)


def test_chat_escapes_every_control_string(spark):
    frame = spark.createDataFrame([(k, m) for k, m in enumerate(MARKS)], "k int, m string")
    for r in frame.select("m", chat_format.escape(F.col("m")).alias("e"), chat_format.unescape(chat_format.escape(F.col("m"))).alias("u")).collect():
        assert r["u"] == r["m"]
        assert not any(s in r["e"] for s in ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_chat_of_nothing_and_one_shuffle(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.format_chat(empty).count() == 0
    query = QUERIES["op2_chat_format"](spark, SF01)
    assert query._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def expect_lines(rows):
    seen, out = {}, []
    order = sorted(set((i, t) for i, t in rows if t is not None), key=lambda r: (r[0] is not None, r[0] or 0))
    for i, t in order:
        lines = t.split("\n")
        for p in range(len(lines) - 2):
            seen.setdefault(tuple(lines[p:p + 3]), (i, t, p))
    for i, t in rows:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        lines = t.split("\n")
        gone = {q for p in range(len(lines) - 2) if seen[tuple(lines[p:p + 3])] != (i, t, p) for q in range(p, p + 3)}
        out.append((i, "\n".join(x for q, x in enumerate(lines) if q not in gone), len(lines), len(gone)))
    return sorted(out, key=str)


def test_line_dedup_cases(spark):
    random.seed(11)
    rows = [(k, "\n".join(random.choice("abcd") for _ in range(random.randint(0, 9)))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, "a\nb"), (103, "\n\n\n\n"), (104, "q\nr\ns"), (104, "q\nr\ns"), (105, "q\nr\ns"), (None, "a\na\na\nz"),
             (106, "\n".join(f"line {k}" for k in range(5000))), (107, "\n".join(f"line {k}" for k in range(5000)))]
    got = line_dedup.dedup_lines(docs_frame(spark, rows))
    assert got.columns == ["doc_id", "text", "key", "keep_id", "lines", "rest", "n_lines", "n_removed"]
    assert sorted((tuple(r) for r in got.select("doc_id", "text", "n_lines", "n_removed").collect()), key=str) == expect_lines(rows)
    assert {tuple(r) for r in got.select("key", "keep_id", "lines", "rest").collect()} == {(7, "x", "y", "z")}


def test_line_dedup_of_nothing(spark):
    assert line_dedup.dedup_lines(docs_frame(spark, [])).count() == 0


def test_native_operators_run_no_python(spark):
    for name in ("op1_exact_dedup", "op2_chat_format", "op6_line_dedup", "op9_pii"):
        plan = QUERIES[name](spark, SF01)._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "ExistingRDD")), name
