"""BPE and token files against the tokenizers library."""

import hashlib
import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from lumen.llm import bpe, token_files
from lumen.llm.recent import Recent

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LETTERS = list("abc ABC 'sl don't 0123 \n\t\r\x1c\x1f\x85\xa0 éüßñİΣσς😀漢字ⅷ²") + [
    "<|endoftext|>", "<|startoftext|>", "  ", "'re", "'S", "́", "​", " ", "　", "ﬁ", "가"]
ROWS = [(5, "Hello world"), (3, None), (4, ""), (4, ""), (None, "no id"), (9, "a" * 20_000), (1, "tie <|endoftext|> x"), (2, "ΑΣ İstanbul, ÉTÉ!")]


def texts(n=400):
    random.seed(2)
    return ["".join(random.choice(LETTERS) for _ in range(random.randint(0, 40))) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "c", b"b") for i, t in rows], "doc_id long, text string, n_tokens int, ids string, decoded binary")


def test_segment_tree_merges_as_the_library():
    codec, library = bpe.codec(Path(BYTE).read_text()), Tokenizer.from_file(BYTE)
    for text, ids in zip(texts(), codec.encode(texts()), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert codec.decode(ids) == library.decode(want, skip_special_tokens=False) == text


def test_one_tree_and_many_trees_agree():
    codec = bpe.codec(Path(BYTE).read_text())
    random.seed(4)
    words = ["".join(random.choice("abcdeth") for _ in range(n)) for n in range(2, 65) for _ in range(3)]
    for w in words:
        one = bpe.merge_all(codec.first[np.frombuffer(w.encode(), np.uint8)].tolist(), codec.ranks)
        many = codec.merges.merge_many([w.encode()], codec.first)[0]
        assert one == np.frombuffer(many, "<u4").tolist()


def test_invalid_bytes_decode_as_the_library():
    codec, library = bpe.codec(Path(BYTE).read_text()), Tokenizer.from_file(BYTE)
    for text in ("😀", "漢", "é"):
        ids = library.encode(text, add_special_tokens=False).ids
        for part in (ids[:1], ids[1:], ids[::-1]):
            assert codec.decode(np.array(part, "<u4").tobytes()) == library.decode(part, skip_special_tokens=False)


def test_encode_decode_cases(spark):
    library = Tokenizer.from_file(BYTE)
    got = bpe.encode_decode(frame(spark, ROWS), BYTE)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    want = sorted(((i, len(e), np.array(e, "<u4").tobytes(), t or "") for i, t in ROWS
                   for e in [library.encode(t or "", add_special_tokens=False).ids]), key=str)
    assert sorted(((r[0], r[1], bytes(r[2]), r[3]) for r in got.collect()), key=str) == want
    assert bpe.encode_decode(frame(spark, []), BYTE).count() == 0


def test_recent_words_stay_bounded_and_right():
    made = []

    def make(words):
        made.extend(words)
        return [w.encode() for w in words]
    recent = Recent(2_000, make)
    for k in range(200):
        assert recent.joined([["hot", str(k)], ["hot"]]) == [b"hot" + str(k).encode(), b"hot"]
    assert len(recent.new) + len(recent.old) < 40 and made.count("hot") == 1


def expect_files(rows):
    library, out, start = Tokenizer.from_file(WORD), [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def test_token_files_cases(spark):
    rows = ROWS + [(100 + k, t) for k, t in enumerate(texts(300))]
    docs = frame(spark, rows).repartition(7)
    for length, batch, limit in ((8, 4, 20), (1024, 64, 1 << 16)):
        manifest = token_files.write_token_files(docs, WORD, 2, length=length, rows=batch, file_rows=limit)
        got = token_files.read_token_files(spark, manifest, length, batch)
        assert sorted((tuple(r) for r in got.collect()), key=str) == expect_files(rows)


def test_token_files_are_fixed_size_lists_read_without_a_copy(spark):
    manifest = token_files.write_token_files(frame(spark, [(k, t) for k, t in enumerate(texts(50))]), WORD, 2, length=16, rows=4)
    files = [(r["path"], r["n_tokens"]) for r in spark.read.parquet(manifest).collect()]
    for path, tokens in files:
        with pa.memory_map(f"{path}.arrow") as source:
            file = pa.ipc.open_file(source)
            assert file.schema.field("ids").type == pa.list_(pa.uint16(), 16) and file.schema.field("mask").type == pa.list_(pa.bool_(), 16)
            batches = [file.get_batch(k) for k in range(file.num_record_batches)]
            assert all(b.num_rows == 4 for b in batches[:-1])
            masks = np.concatenate([b.column(1).flatten().to_numpy(zero_copy_only=False) for b in batches])
            assert masks.sum() == tokens and masks[:tokens].all() and len(masks) - tokens < 16
            assert batches[0].column(0).flatten().to_numpy(zero_copy_only=True) is not None


def test_a_hot_id_is_spread_over_tasks(spark):
    """A third of the rows have no id: several files hold them, in the order of their texts."""
    rows = [(k if k % 3 else None, f"{k * 7919 % 3000} words of row {k}") for k in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")     # these few rows would be one task
    try:
        manifest = token_files.write_token_files(frame(spark, rows).repartition(8), WORD, 2)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.parquet(manifest).collect()
    assert sum(r["first_doc"] is None for r in files) >= 2 and max(r["n_docs"] for r in files) < 1000
    assert sorted((tuple(r) for r in token_files.read_token_files(spark, manifest).collect()), key=str) == expect_files(rows)


def test_token_files_of_nothing(spark):
    manifest = token_files.write_token_files(frame(spark, []), WORD, 2)
    assert token_files.read_token_files(spark, manifest).count() == 0


def test_query_digests(spark):
    from lumen.llm.queries import QUERIES
    from lumen.sources.tables import load
    from tests.conftest import SF001
    docs = [tuple(r) for r in load(spark, SF001, "documents", "doc_id", "text").collect()]
    library = Tokenizer.from_file(BYTE)
    coded = {r["doc_id"]: r for r in QUERIES["op3_bpe"](spark, SF001).collect()}
    for i, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert tuple(coded[i]) == (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert sorted((tuple(r) for r in QUERIES["op5_token_files"](spark, SF001).collect()), key=str) == expect_files(docs)
