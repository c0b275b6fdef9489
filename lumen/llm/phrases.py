"""Phrase collocation mining by weighted acyclic automata, for each language.

Texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at blanks and tabs into words, A-Z
in lower case.  Phrases of one to four words are counted level by level.  A task counts the
phrases of its texts, sorts them and builds count transducers whose paths are the language and
the words; the paths are cut at bounds of whole paths (drawn from a sample, shared by all tasks),
so a frequent first word falls into several ranges.  For each range the transducers of all tasks
are united and their weights summed; phrases that occur less than ``least`` times go, since
neither they nor anything that holds them can be a candidate or a part of one.

A phrase is counted only if a bitmap lets both its beginning and its end, each a word shorter,
through; the bitmap holds all phrases of the level before, has a fixed size, and lets some others
through at most, so counts stay exact.

A candidate's parts are looked up by composition: the distinct parts wanted in a range become a
transducer, composed with the range's count transducer.  Longer candidates that hold a shorter
one are reduced to their greatest count for each shorter phrase before they meet it.

Defined cases: a null text is empty, a null language is ``und``; texts without words add nothing;
rows count as often as they occur; an empty table gives no rows.  Whole texts are read, a block
at a time; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumen.llm.decontaminate import BITS, bitmap
from lumen.llm.shared import text_of, written
from lumen.llm.shingles import STEP, mixed
from lumen.llm.transducers import Transducer, summed, union

LEAST, PERCENT, TOP, LONGEST = 30, 80, 2000, 4
UNKNOWN = "und"
#: Breaks between pieces become line feeds, tabs blanks, A-Z lower case.
TEXT_BYTES = bytes(10 if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: The break among the words: no word holds a full stop.
BREAK = b"."
#: Bytes of text split into words at a time.
BLOCK_BYTES = 1 << 21
#: Words of the table, and distinct phrases, that a task holds before it hands on transducers.
HELD_WORDS, HELD_PHRASES = 400_000, 1_500_000
#: Sequences that a uniting task gathers before it unites them.
HELD_PATHS = 2_000_000
#: Texts, and phrases of each, drawn for the bounds of the ranges.
BOUND_TEXTS, BOUND_PHRASES = 4000, 16


def words_of(texts: list[bytes]) -> list[bytes]:
    """The words of texts in order, with a break between pieces."""
    return b"\n".join(texts).translate(TEXT_BYTES).replace(b"\n", b" . ").split()


def hash_of(language: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(language.encode()))


def phrase_hashes(columns: list[np.ndarray], start: np.uint64) -> np.ndarray:
    """One hash for each row of word hashes; columns: first words, second words, ..."""
    out = np.full(len(columns[0]), start)
    for column in columns:
        out = mixed(out * STEP + column)
    return out


def blocks(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """The texts of rows (lang, text), by language, about ``BLOCK_BYTES`` at a time."""
    held, size = defaultdict(list), defaultdict(int)
    for language, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        data = text.as_py().encode()
        held[language].append(data)
        size[language] += len(data)
        if size[language] >= BLOCK_BYTES:
            yield language, held.pop(language)
            size.pop(language)
    yield from held.items()


class Shard:
    """Counts of the phrases of ``n`` words in a task's texts."""

    def __init__(self, n: int, bounds: list[tuple[bytes, ...]], present: np.ndarray | None):
        self.n, self.bounds, self.present = n, bounds, present
        self.clear()

    def clear(self) -> None:
        self.table = defaultdict(count().__next__)
        self.table[BREAK]
        self.hashes = np.zeros(1, np.uint64)
        self.counts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        self.held = 0

    def add(self, language: str, texts: list[bytes]) -> None:
        words = words_of(texts)
        ids = np.fromiter(map(self.table.__getitem__, words), np.int64, len(words))
        if len(ids) < self.n:
            return
        if self.present is None:
            rows = np.flatnonzero(ids > 0)
        else:
            if len(self.table) > len(self.hashes):
                fresh = list(self.table)[len(self.hashes):]
                self.hashes = np.r_[self.hashes, np.fromiter(map(xxhash.xxh3_64_intdigest, fresh), np.uint64, len(fresh))]
            hashes, short = self.hashes[ids], self.n - 1
            upto = len(ids) - short + 1
            keys = phrase_hashes([hashes[k:k + upto] for k in range(short)], hash_of(language))
            known = self.present[(keys & np.uint64(len(self.present) - 1)).astype(np.int64)]
            for k in range(short):
                known &= ids[k:k + upto] > 0
            rows = np.flatnonzero(known[:-1] & known[1:])
        if not len(rows):
            return
        # two words to a number: tables stay far below 2^31 words
        pairs = [ids[rows] << 31 | ids[rows + 1] if self.n > 1 else ids[rows]]
        if self.n > 2:
            pairs.append(ids[rows + 2] << 31 | ids[rows + 3] if self.n > 3 else ids[rows + 2])
        found = self._summed(np.stack(pairs, axis=1), np.ones(len(rows), np.int64))
        self.counts[language].append(found)
        self.held += len(found[1])

    @staticmethod
    def _summed(pairs: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return summed(pairs, weights)

    def full(self) -> bool:
        if self.held > HELD_PHRASES:
            for language, parts in self.counts.items():
                self.counts[language] = [self._summed(np.concatenate([p for p, _ in parts]), np.concatenate([w for _, w in parts]))]
            self.held = sum(len(w) for parts in self.counts.values() for _, w in parts)
        return self.held > HELD_PHRASES // 2 or len(self.table) > HELD_WORDS

    def transducers(self) -> Iterator[tuple[int, bytes]]:
        """(range, transducer) of everything counted so far."""
        table = list(self.table)
        for language, parts in sorted(self.counts.items()):
            pairs = np.concatenate([p for p, _ in parts])
            columns = [part for k in range(pairs.shape[1]) for part in (pairs[:, k] >> 31, pairs[:, k] & 0x7FFFFFFF)]
            columns = [columns[1]] if self.n == 1 else [*columns[:2], columns[3]] if self.n == 3 else columns
            used = np.unique(np.concatenate(columns))
            names = [table[k] for k in used]
            order = sorted(range(len(names)), key=names.__getitem__)
            number = np.empty(len(used), np.int64)
            number[order] = np.arange(len(used))
            paths = np.stack([number[np.searchsorted(used, c)] for c in columns], axis=1)
            paths, weights = summed(paths, np.concatenate([w for _, w in parts]))
            names, first = [names[k] for k in order], language.encode()

            def path(k, names=names, paths=paths, first=first):
                return first, *(names[j] for j in paths[k])
            # the language is every path's first symbol, at its place in the table
            at = bisect_left(names, first)
            symbols = names if at < len(names) and names[at] == first else [*names[:at], first, *names[at:]]
            moved = paths + (paths >= at) if symbols is not names else paths
            moved = np.c_[np.full(len(moved), at), moved]
            cuts = [0, *(bisect_left(range(len(paths)), b, key=path) for b in self.bounds), len(paths)]
            symbols = pa.array(symbols, pa.binary())
            for part, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if low < high:
                    yield part, Transducer.of_sorted(symbols, moved[low:high], weights[low:high]).to_bytes()


def shards(docs: DataFrame, n: int, bounds: list[tuple[bytes, ...]], present: np.ndarray | None) -> DataFrame:
    """(part, automaton): count transducers of the phrases of ``n`` words in each task's texts."""
    session = docs.sparkSession.sparkContext
    given = session.broadcast((bounds, None if present is None else np.packbits(present)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, bits = given.value
        shard = Shard(n, cuts, None if bits is None else np.unpackbits(bits).view(bool))

        def handed_on() -> Iterator[pa.RecordBatch]:
            for part, data in shard.transducers():
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([data], pa.binary())], names=["part", "automaton"])
            shard.clear()

        for batch in batches:
            for language, texts in blocks(batch):
                shard.add(language, texts)
                if shard.full():
                    yield from handed_on()
        yield from handed_on()
    return docs.mapInArrow(run, "part int, automaton binary")


def united(parts: DataFrame, n: int, ranges: int, least: int) -> DataFrame:
    """(n, part, automaton, hashes, langs, totals): for each range the phrases that occur ``least`` times.

    hashes: one of each phrase; langs and totals: how often phrases of each language occurred, all counted.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[Transducer]] = defaultdict(list)
        paths: dict[int, int] = defaultdict(int)
        for batch in batches:
            for part, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one = Transducer.from_bytes(data)
                held[part].append(one)
                paths[part] += len(one.layers[-1][1])
                if paths[part] > HELD_PATHS and len(held[part]) > 1:
                    held[part] = [union(held[part])]
                    paths[part] = len(held[part][0].layers[-1][1]) // 2
        for part, automata in sorted(held.items()):
            every = union(automata)
            rows, weights = every.paths()
            firsts, place = np.unique(rows[:, 0], return_inverse=True)
            totals = np.zeros(len(firsts), np.int64)
            np.add.at(totals, place, weights)
            langs = [every.symbols[int(k)].as_py().decode() for k in firsts]
            kept = union([every], least)
            hashes = np.zeros(0, np.uint64)
            if kept:
                rows, _ = kept.paths()
                of_symbol = np.array([xxhash.xxh3_64_intdigest(s) for s in kept.symbols.to_pylist()], np.uint64)
                hashes = phrase_hashes([of_symbol[rows[:, k]] for k in range(1, n + 1)], of_symbol[rows[:, 0]])
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int32()), pa.array([part], pa.int32()), pa.array([kept.to_bytes() if kept else None], pa.binary()),
                 pa.array([hashes.view(np.int64)], pa.list_(pa.int64())), pa.array([langs], pa.list_(pa.string())),
                 pa.array([totals], pa.list_(pa.int64()))], names=["n", "part", "automaton", "hashes", "langs", "totals"])
    schema = "n int, part int, automaton binary, hashes array<long>, langs array<string>, totals array<long>"
    return parts.repartitionById(ranges, F.col("part")).mapInArrow(run, schema)


def sampled_paths(docs: DataFrame) -> list[tuple[bytes, ...]]:
    """Paths (language and four words) from texts drawn at random: they only set the ranges' bounds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = words_of([text.as_py().encode()])
                starts = range(0, len(words) - LONGEST + 1, max(1, len(words) // BOUND_PHRASES))
                found += [[language.encode(), *words[k:k + LONGEST]] for k in starts if BREAK not in words[k:k + LONGEST]]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.binary()))], names=["path"])
    share = min(1.0, 2 * BOUND_TEXTS / max(docs.count(), 1))
    some = docs.sample(share, 17).limit(BOUND_TEXTS)
    return sorted({tuple(bytes(w) for w in r["path"]) for r in some.mapInArrow(run, "path array<binary>").collect()})


def bounds_of(paths: list[tuple[bytes, ...]], n: int, ranges: int) -> list[tuple[bytes, ...]]:
    """Up to ``ranges - 1`` bounds between paths of ``n`` words."""
    short = sorted({p[:n + 1] for p in paths})
    return sorted({short[len(short) * k // ranges] for k in range(1, ranges)}) if short else []


def counted(docs: DataFrame, least: int) -> tuple[DataFrame, list[list[tuple[bytes, ...]]]]:
    """The united transducers of all levels, and each level's bounds."""
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    paths = sampled_paths(docs)
    levels, present, bounds = None, None, []
    for n in range(1, LONGEST + 1):
        bounds.append(bounds_of(paths, n, ranges))
        level = written(united(shards(docs, n, bounds[-1], present), n, len(bounds[-1]) + 1, least), f"phrases-{n}")
        levels = level if levels is None else levels.union(level)
        if n < LONGEST:
            present = bitmap(level.select(F.explode("hashes").alias("h")), BITS)
    return levels, bounds


def listed(levels: DataFrame) -> DataFrame:
    """(lang, words, f) of all phrases of the transducers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                one = Transducer.from_bytes(data)
                rows, weights = one.paths()
                symbols = one.symbols.cast(pa.string())
                width = rows.shape[1] - 1
                words = symbols.take(pa.array(rows[:, 1:].reshape(-1)))
                first = pa.array(np.arange(len(rows) + 1) * width, pa.int32())
                yield pa.RecordBatch.from_arrays([symbols.take(pa.array(rows[:, 0])), pa.ListArray.from_arrays(first, words), pa.array(weights)],
                                                 names=["lang", "words", "f"])
    return levels.where("automaton IS NOT NULL").select("automaton").mapInArrow(run, "lang string, words array<string>, f long")


def looked_up(asked: DataFrame, levels: DataFrame, bounds: list[list[tuple[bytes, ...]]]) -> DataFrame:
    """(lang, words, f) of distinct phrases (lang, words), by composition with the ranges' transducers."""
    given = asked.sparkSession.sparkContext.broadcast(bounds)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            parts = [bisect_right(given.value[len(words) - 1], (lang.encode(), *(w.encode() for w in words))) for lang, words in rows]
            sizes = [len(words) for _, words in rows]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int32()), pa.array(parts, pa.int32()), *batch.columns],
                                             names=["n", "part", "lang", "words"])

    def compose(wanted: pa.Table, known: pa.Table) -> pa.Table:
        schema = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("f", pa.int64())])
        automata = [data for data in known.column("automaton").to_pylist() if data]
        if not wanted.num_rows or not automata:
            return schema.empty_table()
        rows = sorted((lang.encode(), *(w.encode() for w in words)) for lang, words in
                      zip(wanted.column("lang").to_pylist(), wanted.column("words").to_pylist(), strict=True))
        table = sorted({s for row in rows for s in row})
        number = {s: k for k, s in enumerate(table)}
        requests = Transducer.of_sorted(pa.array(table, pa.binary()), np.array([[number[s] for s in row] for row in rows]), np.ones(len(rows), np.int64))
        f, here = Transducer.from_bytes(automata[0]).composed(requests)
        found = [(row[0].decode(), [w.decode() for w in row[1:]]) for row, ok in zip(rows, here, strict=True) if ok]
        return pa.table([pa.array([r[0] for r in found], pa.string()), pa.array([r[1] for r in found], pa.list_(pa.string())),
                         pa.array(f[here], pa.int64())], schema=schema)

    requests = asked.select("lang", "words").mapInArrow(placed, "n int, part int, lang string, words array<string>")
    known = levels.select("n", "part", "automaton")
    return requests.groupBy("n", "part").cogroup(known.groupBy("n", "part")).applyInArrow(compose, "lang string, words array<string>, f long")


def whole(column: str):
    """A count as a decimal, for products beyond 64 bits."""
    return F.col(column).cast("decimal(20,0)")


def scored(candidates: DataFrame, levels: DataFrame, bounds: list[list[tuple[bytes, ...]]]) -> DataFrame:
    """(lang, words, a, l, r, score): each candidate at its lowest-scoring cut."""
    size = F.size("words")
    cuts = candidates.select("lang", "words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("cut"))
    sides = F.array(F.struct(F.lit("l").alias("side"), F.expr("slice(words, 1, cut)").alias("part")),
                    F.struct(F.lit("r").alias("side"), F.expr("slice(words, cut + 1, size(words))").alias("part")))
    parts = cuts.select("lang", "words", "a", "cut", F.inline(sides))
    found = looked_up(parts.select("lang", F.col("part").alias("words")).distinct(), levels, bounds)
    found = written(found.withColumnsRenamed({"words": "part"}), "parts")
    counts = (parts.join(found, ["lang", "part"]).groupBy("lang", "words", "a", "cut")
              .agg(F.max(F.when(F.col("side") == "l", F.col("f"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("f"))).alias("r")))
    score = F.expr("(2000000 * cast(a AS decimal(20,0))) div (cast(l AS decimal(20,0)) + cast(r AS decimal(20,0)))")
    best = counts.groupBy("lang", "words", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))
    return best.select("lang", "words", "a", "best.l", "best.r", "best.score")


def not_covered(rows: DataFrame, candidates: DataFrame, percent: int) -> DataFrame:
    """``rows`` without those whose words lie inside a longer candidate of nearly their count."""
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("words") - 1), lambda k: F.transform(
        F.sequence(F.lit(1), F.size("words") - k + 1), lambda start: F.slice("words", start, k))))
    longer = (candidates.where(F.size("words") > 2).select("lang", F.col("a").alias("f"), F.explode(inner).alias("words"))
              .groupBy("lang", "words").agg(F.max("f").alias("longer")))
    left = rows.join(longer, ["lang", "words"], "left")
    return left.where(F.col("longer").isNull() | (100 * whole("longer") < percent * whole("a"))).drop("longer")


def collocations(docs: DataFrame, least: int = LEAST, percent: int = PERCENT, top: int = TOP, lang_col: str = "lang",
                 text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two to four words."""
    docs = docs.select(F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang"), text_of(text_col).alias("text"))
    levels, bounds = counted(docs, least)
    candidates = written(listed(levels.where("n > 1")).withColumnRenamed("f", "a"), "candidates")
    left = not_covered(scored(candidates, levels, bounds), candidates, percent)
    left = left.select("lang", F.concat_ws(" ", "words").alias("phrase"), "a", "l", "r", "score")
    totals = (levels.where("n = 1").select(F.inline(F.arrays_zip("langs", "totals"))).groupBy("langs")
              .agg(F.sum("totals").alias("n")).withColumnRenamed("langs", "lang"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
