"""Benchmark decontamination by a size-partitioned MinHash containment search.

An item is contained in a document when at least ``percent`` of its distinct shingles (five
words) are among the document's.  Items are short and documents long, so their similarity is
near zero however well an item is contained; containment is searched for instead.  A shingle
of a MinHash sketch, the item's least shingles under one hash, is a uniform draw from the
item and lies in the document with the probability of the containment.  Items are partitioned
by size into doubling classes; a class fixes how many shingles its sketch holds and how many
of them must be met, so that an item at the threshold is missed with probability ``MISS`` at
most (not at all where the sketch is the whole item).

The search: one pass over the documents keeps the shingles that a bitmap of ``BITS`` bits over
the items' shingles lets through (its size is fixed; it only filters, a later join is exact).
Those join the sketches; pairs with enough hits are candidates.  A candidate is verified by
counting the item's shingles in the document exactly.  A shingle in a third of all documents
is one row of the sketch side, and the adaptive skew join splits its documents.

Defined cases: words are runs of anything but ASCII white space, A-Z in lower case; a text of
fewer words than a shingle is one shingle and only equals another such text; texts without words
(null, empty) match nothing; an item with a null id is not searched; rows that share a doc_id
are one document, whose shingles are those of all its rows (``contained_items``), but each row
stays or goes by its own text (``without_contaminated``); rows that share an item_id but not
the shingles are searched one by one.  Very long texts are read in full; other columns are ignored.
Intermediate tables are deleted at the end of a search.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumen.llm.shared import text_of, workspace, written
from lumen.llm.shingles import STEP, mixed, shingle_set

WORDS, PERCENT = 5, 80
MISS = 1e-7
#: Items of up to this many shingles are their own sketch.
WHOLE = 16
#: Bits of the filter: 2 MB for any number of items.
BITS = 1 << 24


def sketch_plan(n: int, percent: int = PERCENT) -> tuple[int, int]:
    """Shingles in the sketch of an item of n shingles, and how many of them a document must have."""
    if n <= WHOLE:
        return n, -(-percent * n // 100)
    held = WHOLE + 8 * (n.bit_length() - WHOLE.bit_length())
    p, tail, need = percent / 100, 0.0, 0
    while need < held:
        tail += math.comb(held, need) * p**need * (1 - p) ** (held - need)
        if tail > MISS:
            break
        need += 1
    return held, max(1, need)


def item_shingles(items: DataFrame, words: int, percent: int) -> DataFrame:
    """(item_id, item_key, n_item, need, h, sketched): a row for each distinct shingle of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hashes = shingle_set(text, words)
                n = len(hashes)
                held, need = sketch_plan(n, percent)
                sketched = np.zeros(n, bool)
                sketched[np.argsort(mixed(hashes + STEP), kind="stable")[:held]] = True
                key = xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item_id] * n, pa.int64()), pa.array([key] * n, pa.int64()), pa.array([n] * n, pa.int64()),
                     pa.array([need] * n, pa.int64()), pa.array(hashes.view(np.int64)), pa.array(sketched)],
                    names=["item_id", "item_key", "n_item", "need", "h", "sketched"])
    return items.mapInArrow(run, "item_id long, item_key long, n_item long, need long, h long, sketched boolean").distinct()


def bitmap(hashes: DataFrame, bits: int = BITS) -> np.ndarray:
    """Which values of h mod bits occur; at most bits / 64 rows reach the driver."""
    cell = F.col("h").bitwiseAND(F.lit(bits - 1))
    words = (hashes.groupBy(F.shiftright(cell, 6).alias("word"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(h & 63 as int))")).alias("set")).toPandas())
    out = np.zeros(bits // 64, np.int64)
    out[words["word"].to_numpy(np.int64)] = words["set"].to_numpy(np.int64)
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool) if len(words) else np.zeros(bits, bool)


def document_hits(docs: DataFrame, present: np.ndarray, words: int) -> DataFrame:
    """(keys, h) of rows (keys, text): the distinct shingles of each row that the filter lets through."""
    packed = docs.sparkSession.sparkContext.broadcast(np.packbits(present, bitorder="little").tobytes())
    bits, keys = len(present), docs.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.unpackbits(np.frombuffer(packed.value, np.uint8), bitorder="little").view(bool)
        for batch in batches:
            ids, found = [], []
            for k, text in enumerate(batch.column(len(keys))):
                hashes = shingle_set(text.as_py(), words)
                hashes = hashes[filled[(hashes & np.uint64(bits - 1)).astype(np.int64)]]
                ids.append(np.full(len(hashes), k))
                found.append(hashes)
            rows = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int64), pa.int64())
            h = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(rows) for k in range(len(keys))), pa.array(h)], names=[*keys, "h"])
    return docs.mapInArrow(run, ", ".join(f"{k} long" for k in [*keys, "h"]))


def contained_in(docs: DataFrame, items: DataFrame, words: int, percent: int, bits: int) -> DataFrame:
    """(keys, item_id, n_shared, n_item) for every item (item_id, text) contained in a document.

    docs: rows (keys, text) with keys of type long; rows with equal keys, null among them, are one document.
    """
    with workspace(docs.sparkSession, "containment") as folder:
        return written(verified(docs, items, words, percent, bits, folder), "contained")


def verified(docs: DataFrame, items: DataFrame, words: int, percent: int, bits: int, folder: str) -> DataFrame:
    """``contained_in``, read from tables in ``folder``."""
    keys = docs.columns[:-1]
    items = items.where("item_id IS NOT NULL").select(F.col("item_id").cast("long"), text_of("text").alias("text"))
    shingles = written(item_shingles(items, words, percent), "item-shingles", folder)
    hits = written(document_hits(docs, bitmap(shingles.select("h"), bits), words).distinct(), "hits", folder)
    item = ["item_id", "item_key", "n_item"]
    candidates = (hits.join(shingles.where("sketched"), "h").groupBy(*keys, *item, "need").agg(F.count("*").alias("met"))
                  .where("met >= need").select(*keys, *item))
    candidates = written(candidates, "candidates", folder)
    wanted = candidates.select("item_id", "item_key").distinct()
    checked = hits.join(shingles.join(wanted, ["item_id", "item_key"]), "h").groupBy(*keys, *item).agg(F.count("*").alias("n_shared"))
    contained = checked.where(F.col("n_shared") * 100 >= F.col("n_item") * percent).withColumnsRenamed({k: f"in_{k}" for k in keys})
    same = (contained["item_id"] == candidates["item_id"]) & (contained["item_key"] == candidates["item_key"])
    for k in keys:
        same = same & F.col(f"in_{k}").eqNullSafe(F.col(f"of_{k}"))
    pairs = contained.join(candidates.withColumnsRenamed({k: f"of_{k}" for k in keys}), same, "left_semi")
    return (pairs.groupBy(*(F.col(f"in_{k}").alias(k) for k in keys), "item_id")
            .agg(F.max("n_shared").alias("n_shared"), F.max("n_item").alias("n_item")))


def contained_items(docs: DataFrame, items: DataFrame, words: int = WORDS, percent: int = PERCENT, bits: int = BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_shared, n_item) for every item (item_id, text) contained in a document."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return contained_in(docs, items, words, percent, bits)


def without_contaminated(docs: DataFrame, items: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` less the rows whose own text contains an item."""
    row_key = F.xxhash64("text")
    rows = docs.select(F.col("doc_id").cast("long"), row_key.alias("row_key"), text_of("text").alias("text"))
    found = (contained_in(rows, items, words, percent, BITS)
             .select(F.col("doc_id").alias("contaminated_id"), F.col("row_key").alias("contaminated_key")).distinct())
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("contaminated_id")) & (row_key == F.col("contaminated_key")), "left_anti")
