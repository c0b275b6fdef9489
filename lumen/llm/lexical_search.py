"""Ranked lexical search: exact inner-product search in sparse ball trees.

A document's score for an item is the sum, over the item's terms, of a whole-number weight times
a whole-number saturation of the term's count, i.e. an inner product of an item that is 1 on its
terms with a document vector.  Documents are packed into ball trees of at most ``TREE`` rows.  A
node keeps the centroid of its documents and a radius that holds all of them; with Cauchy and
Schwarz no document in it scores above <item, centroid> + |item| * radius.  Nodes are visited
best bound first, until the best bound left is below the item's tenth score so far.  Bounds are
doubles rounded upwards (radius and bound are widened by more than their rounding error), and
scores at the leaves are 64-bit integers, so the ranking is exact.

The items are the stated query set: they are searched in blocks of about ``BLOCK_CHARS``
characters, each against all documents, and a block's terms are what is broadcast.  For a block,
one pass over the texts keeps each document's counts of the block's terms; their statistics are
sums over all documents.  A first search over a 64th of the documents, by hash, gives a lower
bound of each item's tenth score, with which a task prunes and hands on few rows, however many
tasks there are.  The final ranking takes the first ten rows of each item.

Defined cases: a null text has no terms; an item without terms, or whose terms no document has,
has no rows; each row of documents is a document of its own, with a null doc_id ranked last among
equal scores; rows of items that share the text are searched once and answered each; empty tables
give no rows.  Whole texts are read; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumen.llm.shared import text_of, written

TOP = 10
#: Documents of a tree at most, and of a leaf.
TREE, LEAF = 4096, 128
#: Characters of item texts in a block.
BLOCK_CHARS = 1 << 18
#: One of so many documents is searched first.
FIRST_SHARE = 64
#: Words looked up at a time.
WORDS_AT_ONCE = 1 << 20
#: By how much bounds are widened, relative to the numbers they come from.
SLACK = 1e-9
#: Letters A-Z in lower case, other ASCII characters but digits and letters as spaces.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """A text's terms in order: runs of ASCII letters and digits and of any other characters, A-Z in lower case."""
    return text.encode().translate(TERM_BYTES).split()


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers of the ranges that begin at ``starts``, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class BallTree:
    """Documents of one tree: sparse rows (``first``, ``term``, ``value``) of values weighted by term.

    A node of more than ``LEAF`` documents is split by which of two documents far apart is nearer;
    leaves hold consecutive documents of ``order``.
    """

    def __init__(self, first: np.ndarray, term: np.ndarray, value: np.ndarray, vocabulary: int):
        self.first, self.term, self.value, self.vocabulary = first, term, value, vocabulary
        n = len(first) - 1
        self.norms = np.bincount(np.repeat(np.arange(n), np.diff(first)), value.astype(float) ** 2, n)
        self.children: list[tuple[int, int] | None] = []      # of each node, None for a leaf
        self.leaves: dict[int, tuple[int, int]] = {}          # of each leaf where its documents lie in ``order``
        centroids, radii, parts = [], [], []
        self._grow(np.arange(n), centroids, radii, parts)
        self.centroids, self.radii, self.order = np.array(centroids), np.array(radii), np.concatenate(parts)
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        # the entries by leaf and term, for the exact scores
        row = place[np.repeat(np.arange(n), np.diff(first))]
        self.number = {node: k for k, node in enumerate(self.leaves)}
        leaf = np.searchsorted([low for low, _ in self.leaves.values()], row, side="right") - 1
        by = np.argsort(leaf * vocabulary + term, kind="stable")
        self.keys, self.rows, self.values = (leaf * vocabulary + term)[by], row[by], value[by]

    def _dots(self, docs: np.ndarray, with_vector: np.ndarray) -> np.ndarray:
        lengths = self.first[docs + 1] - self.first[docs]
        at = ranges(self.first[docs], lengths)
        return np.bincount(np.repeat(np.arange(len(docs)), lengths), self.value[at] * with_vector[self.term[at]], len(docs))

    def _dense(self, docs: np.ndarray) -> np.ndarray:
        at = ranges(self.first[docs], self.first[docs + 1] - self.first[docs])
        return np.bincount(self.term[at], self.value[at], self.vocabulary)

    def _grow(self, docs: np.ndarray, centroids: list, radii: list, parts: list[np.ndarray]) -> int:
        node = len(self.children)
        self.children.append(None)
        centroid = self._dense(docs) / len(docs)
        length = float(centroid @ centroid)
        apart = self.norms[docs] - 2 * self._dots(docs, centroid) + length
        centroids.append(centroid)
        # differences of large squares: widened by what rounding can have taken
        radii.append(math.sqrt(max(apart.max(), 0.0) + SLACK * (self.norms[docs].max() + length)))
        if len(docs) <= LEAF:
            low = sum(map(len, parts))
            self.leaves[node] = low, low + len(docs)
            parts.append(docs)
            return node
        one = docs[int(apart.argmax())]
        to_one = self.norms[docs] - 2 * self._dots(docs, self._dense(docs[docs == one]))
        other = docs[int(to_one.argmax())]
        nearer = to_one + self.norms[one] - (self.norms[docs] - 2 * self._dots(docs, self._dense(docs[docs == other])) + self.norms[other])
        order = np.argsort(nearer, kind="stable")
        split = int((nearer < 0).sum())
        # a side of few documents would make the tree deep
        if not len(docs) // 16 < split < len(docs) - len(docs) // 16:
            split = len(docs) // 2
        self.children[node] = (self._grow(docs[order[:split]], centroids, radii, parts), self._grow(docs[order[split:]], centroids, radii, parts))
        return node

    def bounds(self, terms: np.ndarray) -> np.ndarray:
        """For each node what none of its documents exceeds."""
        found = self.centroids[:, terms].sum(axis=1) + math.sqrt(len(terms)) * self.radii
        return found * (1 + SLACK) + 1

    def leaf_scores(self, leaf: int, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leaf's documents and their exact scores."""
        wanted = self.number[leaf] * self.vocabulary + terms
        starts = np.searchsorted(self.keys, wanted, side="left")
        at = ranges(starts, np.searchsorted(self.keys, wanted, side="right") - starts)
        low, high = self.leaves[leaf]
        scores = np.zeros(high - low, np.int64)
        np.add.at(scores, self.rows[at] - low, self.values[at])
        return self.order[low:high], scores

    def search(self, terms: np.ndarray, least: int, best: list[tuple], ids: list, top: int = TOP) -> tuple[list[tuple], int]:
        """``best`` with this tree's documents, as (-score, id is null, id), and how many were scored.

        Documents below ``least`` may be left out.
        """
        bounds = self.bounds(terms)
        heap, scored = [(-bounds[0], 0)], 0
        while heap:
            bound, node = heapq.heappop(heap)
            floor = max(least, -best[-1][0] if len(best) == top else 1)
            if -bound < floor:
                break
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(heap, (-bounds[child], child))
                continue
            docs, scores = self.leaf_scores(node, terms)
            scored += len(docs)
            near = np.flatnonzero(scores >= floor)
            if len(near):
                rows = [(-int(scores[k]), ids[docs[k]] is None, ids[docs[k]] or 0) for k in near]
                best = sorted(best + rows)[:top]
        return best, scored


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts): each row's number of terms, and its counts of the vocabulary's terms."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, size = known.value.get, max(len(known.value), 1)
        for batch in batches:
            n, cells, counts = [], [], []
            words, rows = [], []

            def flush():
                keys = np.repeat(np.array(rows, np.int64), [len(w) for w in words]) * size
                found = np.fromiter((get(w, -1) for some in words for w in some), np.int64, len(keys))
                cell, count = np.unique((keys + found)[found >= 0], return_counts=True)
                cells.append(cell)
                counts.append(count)
                words.clear()
                rows.clear()

            held = 0
            for k, text in enumerate(batch.column(1)):
                words.append(terms_of(text.as_py()))
                rows.append(k)
                n.append(len(words[-1]))
                held += n[-1]
                if held >= WORDS_AT_ONCE:
                    flush()
                    held = 0
            flush()
            cell, count = np.concatenate(cells), np.concatenate(counts)
            first = pa.array(np.searchsorted(cell, np.arange(len(n) + 1) * size), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(first, pa.array(cell % size, pa.int32())),
                 pa.ListArray.from_arrays(first, pa.array(count, pa.int32()))], names=["doc_id", "n", "terms", "counts"])
    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


def found_in(rows: DataFrame, queries: list[np.ndarray], weights: np.ndarray, total: int, length: int, least: list[int]) -> DataFrame:
    """(query, doc_id, score): of each task's rows the best for every query."""
    session = rows.sparkSession.sparkContext
    given = session.broadcast((queries, weights, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight, floors = given.value
        best = [[] for _ in asked]
        for batch in batches:
            for at in range(0, batch.num_rows, TREE):
                part = batch.slice(at, TREE)
                ids, n = part.column(0).to_pylist(), part.column(1).to_numpy()
                terms, counts = part.column(2), part.column(3)
                first = terms.offsets.to_numpy().astype(np.int64)
                first -= first[0]
                term, tf = terms.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy().astype(np.int64)
                m = np.repeat(10 + (90 * n * total) // length, np.diff(first))
                tree = BallTree(first, term, weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m)), len(weight))
                for k, q in enumerate(asked):
                    best[k], _ = tree.search(q, floors[k], best[k], ids)
        out = [(k, None if null else doc, -score) for k, rows in enumerate(best) for score, null, doc in rows]
        columns = list(zip(*out, strict=True)) if out else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
                                         names=["query", "doc_id", "score"])
    return rows.where("n > 0").select("doc_id", "n", "terms", "counts").mapInArrow(run, "query int, doc_id long, score long")


def ranked(found: DataFrame, top: int = TOP) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def searched(docs: DataFrame, texts: list[tuple[str, str]]) -> DataFrame | None:
    """(item_key, rank, doc_id, score) of the items (item_key, text) of a block; None where they have no terms."""
    items = [(key, sorted(set(terms_of(text)))) for key, text in texts]
    items = [(key, terms) for key, terms in items if terms]
    vocabulary = {t: k for k, t in enumerate(sorted({t for _, terms in items for t in terms}))}
    if not vocabulary:
        return None
    rows = written(vectors(docs, vocabulary), "term-counts")
    total, length = rows.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    if not total:
        return None
    df = np.zeros(len(vocabulary), np.int64)
    for term, count in rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*")).collect():
        df[term] = count
    weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    queries = [np.array([vocabulary[t] for t in terms], np.int64) for _, terms in items]
    some = rows.where(F.pmod(F.xxhash64("doc_id", "n", "terms", "counts"), F.lit(FIRST_SHARE)) == 0)
    first = ranked(found_in(some, queries, weights, total, length, [1] * len(items)))
    least = [1] * len(items)
    for k, score in first.where(F.col("rank") == TOP).select("query", "score").collect():
        least[k] = score
    keys = docs.sparkSession.createDataFrame([(k, key) for k, (key, _) in enumerate(items)], "query int, item_key string")
    best = written(ranked(found_in(rows, queries, weights, total, length, least)), "best")
    return best.join(keys, "query").select("item_key", "rank", "doc_id", "score")


def search(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``TOP`` best documents (doc_id, text) of every item (item_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long"), text_of("text").alias("text"))
    items = items.select("item_id", text_of("text").alias("text")).withColumn("item_key", F.sha2("text", 256))
    texts = items.groupBy("item_key").agg(F.first("text").alias("text"))
    chars = items.agg(F.sum(F.length("text") + 16)).first()[0] or 0
    blocks, found = math.ceil(chars / BLOCK_CHARS), []
    for block in range(blocks):
        part = texts.where(F.pmod(F.xxhash64("item_key"), F.lit(blocks)) == block)
        best = searched(docs, sorted((r["item_key"], r["text"]) for r in part.collect()))
        if best is not None:
            found.append(best)
    if not found:
        return spark.createDataFrame([], f"item_id {dict(items.dtypes)['item_id']}, rank int, doc_id long, score long")
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    return items.select("item_id", "item_key").join(every, "item_key").select("item_id", "rank", "doc_id", "score")
