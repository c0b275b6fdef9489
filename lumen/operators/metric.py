"""Nearest valid match in a metric space: an index of pivots, cells and blocks.

Catalogue entries (vectors) are dealt to the cell of their nearest pivot, a pivot being an entry
drawn by hash; about sqrt(n) pivots, ``MOST_PIVOTS`` at most, so what is broadcast is bounded by
that parameter.  Inside a cell the entries lie in order of distance from the pivot, packed into
blocks of ``BLOCK`` entries with their least and greatest distance and greatest radius.

With d the distance of a probe from a pivot, no entry of a block is nearer than
max(0, d - greatest, least - d): the triangle inequality.  A probe visits only blocks whose bound
is no more than its distance from the nearest valid pivot, and no more than the greatest radius
of the block where entries have a radius.  Cells are ruled out first, by the same bound over the whole
cell; the blocks of the remaining ones come by an equi-join on the cell.  Visits are grouped by
block, a block with many probes in several groups, and each group is one small distance matrix;
the best of a probe's visits is a minimum with partial aggregates.  A catalogue of one block is
sent to the probes instead, and nothing is shuffled.

Bounds are widened by more than their rounding error, so the result equals comparing every pair.
Distances are euclidean.  A vector matches vectors of its own length without null or NaN only; a
probe without any match stays, with nulls.  Ties go to the least order key.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from lumen.operators.assemble import global_line_numbers
from lumen.operators.lineage import write_round

BLOCK = 512
MOST_PIVOTS = 1024
#: Probes of a block that one group compares.
PROBES = 8192
#: By how much bounds are widened.
SLACK = 1e-9
INF = float("inf")


def matrices(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each length among whole vectors; others are left out."""
    lists = vectors.to_pylist()
    by_length: dict[int, list[int]] = {}
    for k, v in enumerate(lists):
        if v is not None and None not in v:
            by_length.setdefault(len(v), []).append(k)
    for rows in by_length.values():
        matrix = np.array([lists[k] for k in rows], np.float64).reshape(len(rows), -1)
        whole = ~np.isnan(matrix).any(axis=1)
        if whole.any():
            yield np.array(rows)[whole], matrix[whole]


def distances(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of one from all rows of the other, a few rows at a time."""
    out = np.empty((len(one), len(other)))
    step = max(1, (1 << 20) // max(1, other.size))
    for k in range(0, len(one), step):
        apart = one[k:k + step, None, :] - other[None, :, :]
        out[k:k + step] = np.sqrt((apart * apart).sum(axis=2))
    return out


class Entries:
    """Entries of one length in order of their key."""

    def __init__(self, keys: list, items: list, radii: np.ndarray, matrix: np.ndarray):
        order = sorted(range(len(keys)), key=keys.__getitem__)
        self.keys, self.items = [keys[k] for k in order], [items[k] for k in order]
        self.radii, self.matrix = radii[order], matrix[order]

    def best(self, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each probe the distance of its nearest valid entry (inf: none) and the entry's place."""
        found = distances(probes, self.matrix)
        found[~(found <= self.radii)] = INF
        place = found.argmin(axis=1)                          # the first of equal ones: the least key
        return found[np.arange(len(probes)), place], place


def entries_of(keys: pa.Array, items: pa.Array, radii: pa.Array, vectors: pa.Array) -> dict[int, Entries]:
    keys, items = keys.to_pylist(), items.to_pylist()
    radii = np.array([-1.0 if r is None or r != r else r for r in radii.to_pylist()])
    return {m.shape[1]: Entries([keys[k] for k in rows], [items[k] for k in rows], radii[rows], m) for rows, m in matrices(vectors)}


def matched(probe_keys: pa.Array, vectors: pa.Array, known: dict[int, Entries], schema: pa.Schema) -> pa.RecordBatch:
    """Rows (probe key, score, order key, item) of the probes that match."""
    out = []
    for rows, matrix in matrices(vectors):
        if matrix.shape[1] in known:
            entries = known[matrix.shape[1]]
            score, place = entries.best(matrix)
            out += [(int(rows[k]), float(score[k]), entries.keys[place[k]], entries.items[place[k]]) for k in np.flatnonzero(score < INF)]
    return pa.RecordBatch.from_arrays([probe_keys.take(pa.array([r[0] for r in out], pa.int64())),
                                       *(pa.array([r[j] for r in out], schema.field(j).type) for j in (1, 2, 3))], schema=schema)


class Pivots:
    """The pivots, by length of vector, numbered over all."""

    def __init__(self, rows: list[tuple[list[float], float]]):
        lengths = sorted({len(v) for v, _ in rows})
        self.matrix = {n: np.array([v for v, _ in rows if len(v) == n], np.float64).reshape(-1, n) for n in lengths}
        self.radii = {n: np.array([r for v, r in rows if len(v) == n]) for n in lengths}
        self.first, at = {}, 0
        for n in lengths:
            self.first[n] = at
            at += len(self.matrix[n])


def with_cell(catalogue: DataFrame, pivots: Pivots) -> DataFrame:
    """The usable entries with ``__cell`` and ``__apart``, their distance from the cell's pivot.

    Entries of a length that no pivot has form a cell of their own, numbered -1 - length, that bounds nothing.
    """
    given = catalogue.sparkSession.sparkContext.broadcast(pivots)
    schema = StructType([*catalogue.schema.fields, StructField("__cell", IntegerType()), StructField("__apart", DoubleType())])
    at = catalogue.columns.index("__v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, matrix in matrices(batch.column(at)):
                n = matrix.shape[1]
                if n in given.value.matrix:
                    apart = distances(matrix, given.value.matrix[n])
                    place = apart.argmin(axis=1)
                    cell, near = place + given.value.first[n], apart[np.arange(len(matrix)), place]
                else:
                    cell, near = np.full(len(matrix), -1 - n), np.zeros(len(matrix))
                some = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(cell, pa.int32()), pa.array(near)], names=schema.names)
    return catalogue.mapInArrow(run, schema)


def visited_cells(probes: DataFrame, pivots: Pivots, cells: dict[int, tuple[float, float, float]]) -> DataFrame:
    """(probe, __cell, __d, __upto): the cells that a probe cannot rule out, its distance from the pivot and its bound."""
    given = probes.sparkSession.sparkContext.broadcast((pivots, cells))
    key = probes.schema["__probe"]
    schema = StructType([key, StructField("__cell", IntegerType()), StructField("__d", DoubleType()), StructField("__upto", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, ranges = given.value
        for batch in batches:
            for rows, matrix in matrices(batch.column(1)):
                n = matrix.shape[1]
                found = []
                if n in index.matrix:
                    apart = distances(matrix, index.matrix[n])
                    valid = np.where(apart <= index.radii[n], apart, INF)
                    upto = valid.min(axis=1) * (1 + SLACK)
                    for k in range(apart.shape[1]):
                        low, high, radius = ranges.get(k + index.first[n], (INF, -INF, -INF))
                        bound = np.maximum(apart[:, k] - high, low - apart[:, k]) - SLACK * (1 + apart[:, k])
                        for j in np.flatnonzero((bound <= upto) & (bound <= radius)):
                            found.append((rows[j], k + index.first[n], apart[j, k], upto[j]))
                elif -1 - n in ranges:
                    found = [(j, -1 - n, 0.0, INF) for j in rows]
                columns = list(zip(*found, strict=True)) if found else [()] * 4
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int32()),
                                                  pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.float64())], names=schema.names)
    return probes.mapInArrow(run, schema)


def nearest_valid(probes: DataFrame, probe_key: str, probe_vector: str, catalogue: DataFrame, *, order_key: str, vector: str, item: str,
                  radius: str | None = None, carry: list[str] | None = None, block: int = BLOCK, pivots: int | None = None,
                  visits_to: list | None = None) -> DataFrame:
    """(probe_key, carry..., score, item): each probe's nearest entry among those within whose radius it lies.

    Without ``radius`` every entry is valid.  ``probe_key`` identifies a probe, ``order_key`` an
    entry.  ``visits_to`` receives the number of visits of probes to blocks, for measurements.
    """
    spark, carried = probes.sparkSession, list(carry or [])
    limit = F.col(radius).cast("double") if radius else F.lit(INF)
    entries, n = write_round(catalogue.select(F.col(order_key).alias("__key"), F.col(item).alias("__item"), limit.alias("__radius"),
                                              F.col(vector).cast("array<double>").alias("__v")))
    asked = probes.select(F.col(probe_key).alias("__probe"), F.col(probe_vector).cast("array<double>").alias("__v"))
    result = StructType([asked.schema["__probe"], StructField("__score", DoubleType()), entries.schema["__key"], entries.schema["__item"]])
    arrow = spark.createDataFrame([], result).toArrow().schema
    columns = ["__key", "__item", "__radius", "__v"]
    if n <= block:
        held = entries.select(columns).toArrow()
        known = spark.sparkContext.broadcast(entries_of(*(held.column(c).combine_chunks() for c in columns)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield matched(batch.column(0), batch.column(1), known.value, arrow)
        found = asked.mapInArrow(run, result)
    else:
        found = _indexed(asked, entries, n, result, arrow, block, pivots, visits_to)
    best = found.groupBy("__probe").agg(F.min(F.struct("__score", "__key", "__item")).alias("__best"))
    return (probes.select(probe_key, *carried).join(best, F.col(probe_key) == F.col("__probe"), "left")
            .select(probe_key, *carried, F.col("__best.__score").alias("score"), F.col("__best.__item").alias(item)))


def _indexed(asked: DataFrame, entries: DataFrame, n: int, result: StructType, arrow: pa.Schema, block: int, pivots: int | None,
             visits_to: list | None) -> DataFrame:
    whole = "__v IS NOT NULL AND NOT exists(__v, x -> x IS NULL OR isnan(x))"
    drawn = (entries.where(whole).orderBy(F.xxhash64("__key"), "__key").limit(min(pivots or math.ceil(math.sqrt(n)), MOST_PIVOTS))
             .select("__v", "__radius").collect())
    index = Pivots([(list(r[0]), -1.0 if r[1] is None or r[1] != r[1] else r[1]) for r in drawn])
    placed, _ = write_round(with_cell(entries, index))
    numbered = global_line_numbers(placed, ["__cell", "__apart", "__key"], start=0, name="__row")
    blocked, _ = write_round(numbered.withColumn("__block", F.floor(F.col("__row") / block).cast("bigint")))
    least, most = F.min("__apart").alias("__low"), F.max("__apart").alias("__high")
    blocks = blocked.groupBy("__cell", "__block").agg(least, most, F.max("__radius").alias("__most"))
    blocks, _ = write_round(blocks)
    cells = {r["__cell"]: (0.0 if r["__cell"] < 0 else r["__low"], INF if r["__cell"] < 0 else r["__high"], r["__most"]) for r in
             blocks.groupBy("__cell").agg(F.min("__low").alias("__low"), F.max("__high").alias("__high"), F.max("__most").alias("__most")).collect()}
    nearer = F.greatest(F.col("__d") - F.col("__high"), F.col("__low") - F.col("__d")) - SLACK * (1 + F.col("__d"))
    left = (F.col("__cell") < 0) | ((nearer <= F.col("__upto")) & (nearer <= F.col("__most")))
    visits, n_visits = write_round(visited_cells(asked, index, cells).join(blocks, "__cell").where(left).select("__probe", "__cell", "__block"))
    if visits_to is not None:
        visits_to.append(n_visits)
    groups = visits.groupBy("__cell", "__block").agg(F.ceil(F.count("*") / PROBES).cast("int").alias("__n"))
    dealt = (visits.join(groups, ["__cell", "__block"]).withColumn("__group", F.pmod(F.xxhash64("__probe"), F.col("__n")).cast("int"))
             .join(asked, "__probe").select("__cell", "__block", "__group", "__probe", "__v"))
    shown = (blocked.join(groups, ["__cell", "__block"]).withColumn("__group", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
             .select("__cell", "__block", "__group", "__key", "__item", "__radius", "__v"))

    def compare(probes: pa.Table, held: pa.Table) -> pa.Table:
        if not probes.num_rows or not held.num_rows:
            return arrow.empty_table()
        known = entries_of(*(held.column(c).combine_chunks() for c in ("__key", "__item", "__radius", "__v")))
        return pa.Table.from_batches([matched(probes.column("__probe").combine_chunks(), probes.column("__v").combine_chunks(), known, arrow)])

    by = ["__cell", "__block", "__group"]
    return dealt.groupBy(*by).cogroup(shown.groupBy(*by)).applyInArrow(compare, result)
