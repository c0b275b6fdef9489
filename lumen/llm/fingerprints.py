"""Document fingerprints by content-defined chunking.

A gear hash rolls over the text's UTF-8 bytes; its value at a position depends on the last 16
bytes only, so boundaries move with the text when something is inserted before them.  Chunk
sizes are normalised: below ``NORMAL`` bytes a boundary needs seven zero bits, from there on
three, never under ``LEAST`` nor over ``MOST`` bytes.  A fingerprint is the set of the chunks'
64-bit digests with their lengths, as hex in order of digest (16 digits of digest, 4 of length
each).  The likeness of one to another is a containment weighted by length: the bytes of its
chunks that the other has too, as a share of all its bytes.

``edited_fingerprints`` also fingerprints every text after an edit: its last half is replaced by
the beginning of the next document.  Next is a total order over all rows (doc_id downwards, null
ids last, then a hash of the text), in a circle.  Rows are dealt to parts between bounds that are
keys of rows, drawn by hash; the first row of a part is sent to the end of the part before as
well, so each task has the successor of its last row, and the texts are shuffled once.  Equal rows
are told apart by their place in the table, so that a group of copies splits like any other.

Defined cases: a null text is empty; an empty text has an empty fingerprint, which is like another
empty one (1.0) and like no other (0.0); a text shorter than ``LEAST`` bytes is one chunk; rows
that share a doc_id are documents of their own; the only row of a table is its own successor; an
empty table gives no rows.  Very long texts are hashed in blocks.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumen.llm.shared import text_of
from lumen.llm.shingles import STEP, mixed

LEAST, NORMAL, MOST = 8, 32, 128
#: A boundary's hash is below these values: seven zero bits, or three.
STRICT, LOOSE = np.uint32(1 << 25), np.uint32(1 << 29)
GEAR = (mixed(np.arange(1, 257, dtype=np.uint64) * STEP) >> np.uint64(32)).astype(np.uint32)
WINDOW = 16
#: Bytes hashed at a time.
BLOCK = 1 << 20
#: Sampled keys for each part.
KEYS_A_PART = 32

ENTRY = np.dtype([("digest", ">u8"), ("size", ">u2")])
KEY = ["unknown", "rank", "hash", "place"]
RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash at each byte: the sum of GEAR[byte] << age over the last 16 bytes."""
    hashes = GEAR[data]
    for k in (1, 2, 4, 8):
        hashes[k:] += hashes[:-k] << np.uint32(k)
    return hashes


def boundary_places(data: bytes) -> tuple[list[int], list[int]]:
    """Positions just after the bytes whose hash meets the strict and the loose condition."""
    strict, loose = [], []
    whole = np.frombuffer(data, np.uint8)
    for at in range(0, len(whole), BLOCK):
        before = min(at, WINDOW - 1)
        hashes = gear_hashes(whole[at - before:at + BLOCK])[before:]
        met = np.flatnonzero(hashes < LOOSE)
        loose += (met + at + 1).tolist()
        strict += (met[hashes[met] < STRICT] + at + 1).tolist()
    return strict, loose


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of a text end."""
    strict, loose = boundary_places(data)
    ends, start, n = [], 0, len(data)
    while start < n:
        k = bisect_left(strict, start + LEAST)
        end = strict[k] if k < len(strict) else n
        if end >= start + NORMAL:
            k = bisect_left(loose, start + NORMAL)
            end = min(loose[k] if k < len(loose) else n, start + MOST)
        start = min(end, n)
        ends.append(start)
    return ends


def fingerprint(text: str) -> np.ndarray:
    """The chunk digests of a text with their lengths, in order of digest, each once."""
    data = text.encode()
    ends = chunk_ends(data)
    starts = [0, *ends[:-1]]
    digests = np.fromiter((xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(starts, ends, strict=False)), np.uint64, len(ends))
    found, first = np.unique(digests, return_index=True)
    out = np.empty(len(found), ENTRY)
    out["digest"], out["size"] = found, (np.asarray(ends, np.int64) - np.asarray(starts[:len(ends)], np.int64))[first]
    return out


def as_hex(entries: np.ndarray) -> str:
    return entries.tobytes().hex()


def from_hex(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ENTRY)


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """The share of the first fingerprint's bytes whose chunks the second has too."""
    if not len(one):
        return float(not len(other))
    shared = np.isin(one["digest"].astype(np.uint64), other["digest"].astype(np.uint64), assume_unique=True)
    return float(one["size"][shared].sum(dtype=np.int64) / one["size"].sum(dtype=np.int64))


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following`` as there is."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprint_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row, without a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [as_hex(fingerprint(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["doc_id", "fingerprint"])
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return docs.mapInArrow(run, "doc_id long, fingerprint string")


def part_bounds(rows: DataFrame, parts: int) -> tuple[list[tuple], tuple | None]:
    """Keys of rows that split the rows into at most ``parts`` parts of about one size, and the first key."""
    keys = rows.select(*KEY)
    total, first = keys.agg(F.count("*"), F.min(F.struct(*KEY))).first()
    share = min(1.0, KEYS_A_PART * parts / max(total, 1))
    drawn = keys.where(F.pmod(F.xxhash64(*KEY), F.lit(1 << 30)) <= int(share * (1 << 30)))
    sample = sorted(tuple(row) for row in drawn.collect())
    every = max(1, len(sample) // parts)
    return sample[every::every], tuple(first) if total else None


def dealt(rows: DataFrame, parts: int) -> DataFrame:
    """``rows`` by part, in order, each part followed by the first row after it (``ahead``)."""
    bounds, first = part_bounds(rows, parts)

    @F.pandas_udf("array<int>")
    def parts_of(unknown: pd.Series, rank: pd.Series, hashed: pd.Series, place: pd.Series) -> pd.Series:
        out = []
        for key in zip(unknown, rank, hashed, place, strict=True):
            part = bisect_right(bounds, key)
            # the first row of a part ends the part before, the first row of all ends the last part
            out.append([part] + [part - 1] * (part > 0 and bounds[part - 1] == key) + [len(bounds)] * (key == first))
        return pd.Series(out)

    placed = rows.select(*rows.columns, F.posexplode(parts_of(*KEY)).alias("ahead", "part"))
    placed = placed.withColumn("ahead", F.col("ahead") > 0)
    return placed.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", "ahead", *KEY)


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    ``docs`` must hold the same rows in the same places whenever it is read, as a table does.
    """
    doc_id, text = F.col(id_col).cast("long"), text_of(text_col)
    rows = docs.select(doc_id.isNull().alias("unknown"), F.coalesce(F.bitwise_not(doc_id), F.lit(0)).alias("rank"),
                       F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("place"),
                       doc_id.alias("doc_id"), text.alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None                           # the row before: part, doc_id, text, fingerprint
        for batch in batches:
            found = []
            for part, ahead, doc, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                own = fingerprint(text)
                if waiting and waiting[0] == part:
                    _, before, whole, marks = waiting
                    changed = edited(whole, text)
                    other = fingerprint(changed)
                    found.append((before, len(whole), hashlib.sha256(changed.encode()).hexdigest(), as_hex(marks), as_hex(other),
                                  likeness(marks, other), likeness(marks, own)))
                elif waiting:
                    raise RuntimeError(f"part {waiting[0]} has no row after its last one")
                waiting = None if ahead else (part, doc, text, own)
            types = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            columns = list(zip(*found, strict=True)) if found else [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             names=[f.split()[0] for f in RESULT.split(", ")])
        if waiting:
            raise RuntimeError(f"part {waiting[0]} has no row after its last one")

    return dealt(rows, parts).select("part", "ahead", "doc_id", "text").mapInArrow(run, RESULT)
