"""Near-dedup by HyperMinHash: compressed registers, banding, estimate, exact check, components.

Sketch.  A document's set is its distinct word shingles.  Each of ``bands * rows`` registers
takes the least value of one hash function over the set and stores it compressed: its count of
leading zeros and the ``MANTISSA`` bits after the leading one, 16 bits in all.

Classes.  Documents with equal sets (by a 128-bit hash of the whole set) form one class, counted
with map-side aggregates; only one representative of each goes on, so copies cost nothing more.

Banding.  ``rows`` registers hash to one band key.  The number of bands follows from the
threshold so that a pair right at it misses every band with probability ``MISS`` at most.

Candidates.  In a bucket (equal band key) of m representatives not all m(m-1)/2 pairs are made.
Its least id is the pivot and is paired with each other member, which settles a group of
copies around one text.  What is left are pairs of members in different components:

* With D(x) the shingles in which x differs from the pivot, x and y differ in exactly D(x) xor
  D(y).  Similar x and y in different components share at least one element of D, and a known
  number of them, so the first elements of both, in one order for all, must meet (a prefix filter
  on what is left after the pivot is taken out).  A member far from the pivot lists no more
  elements than the shingles in which it may differ from a similar text, and one.
* Members that share a passage meet at each element of it.  A meeting goes when an element among
  the ``RECENT`` before is shared too: the two have met there, or before that, so the pair is not
  lost and is made about once.
* Where members meet, bitmaps of D(x) and D(y) must not differ in more bits than similar x and y
  in elements.  Copies edited in different places make no pairs, however many there are.

So no link that joins two components is lost, whatever a bucket's size, and no bucket is paired
as a whole.

Hot pivots.  A pivot's members are dealt to parts of about ``MEMBERS`` by their hash, as many as
its bands have members for, and its text, component and the like are joined once for each part,
so that a pivot of any number of members is spread over as many tasks as they need.

Check.  A member's differences from its pivot decide exactly whether the two are linked.  For
other pairs the Jaccard similarity is estimated from the registers, corrected for registers that
agree by chance; pairs below the threshold by ``SIGMAS`` standard errors go, the others are decided
on the full sets of both texts.

Defined cases: a text without words (null and empty too) has an empty set and is linked with
nothing; a document with null id is linked with nothing, its component_id is null and it is
kept; repeated rows of one document are all returned, with one component; rows that share an id
but not the text count as one document with the links of each.  Other columns are ignored.
Intermediate tables (texts among them) are deleted at the end of a run.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumen.llm.components import connected_components
from lumen.llm.shared import maybe_among, text_of, workspace, written
from lumen.llm.shingles import shingle_set

MANTISSA = 10
MISS = 1e-7
SIGMAS = 5
#: Shingles hashed at a time, for bounded memory on long texts.
BLOCK = 2048
#: 64-bit words of the bitmap of those differences.
BITMAP = 8
#: Elements before one that are compared to see whether two members have met already.
RECENT = 16
#: Sets a verifying task keeps.
KEPT_SETS = 64
#: Members of one pivot that are dealt to one part.
MEMBERS = 512


def bands_for(similarity: float, rows: int, miss: float = MISS) -> int:
    """Bands of ``rows`` registers that a pair at ``similarity`` all misses with probability ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log1p(-similarity**rows))


def compressed(values: np.ndarray) -> np.ndarray:
    """16-bit registers of 64-bit minima: leading zeros, then the mantissa."""
    # floats of 53 bits can round up to the next power of two: take the exponent from the upper half
    upper = (values >> np.uint64(11)).astype(np.float64)
    exponent = np.where(upper > 0, np.frexp(upper)[1], 0)
    zeros = 53 - exponent
    shift = np.clip(zeros + 1, 0, 63).astype(np.uint64)
    mantissa = (values << shift) >> np.uint64(64 - MANTISSA)
    return (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | mantissa.astype(np.uint16)


class Sketcher:
    """The registers of a set; the hash functions follow from the register's number."""

    def __init__(self, registers: int):
        draw = np.random.default_rng(20_240_229)
        self.xor = draw.integers(0, 1 << 64, (registers, 1), np.uint64)
        self.times = draw.integers(0, 1 << 64, (registers, 1), np.uint64) | np.uint64(1)

    def minima(self, hashes: np.ndarray) -> np.ndarray:
        least = np.full(len(self.xor), ~np.uint64(0))
        for at in range(0, len(hashes), BLOCK):
            np.minimum(least, ((hashes[at:at + BLOCK] ^ self.xor) * self.times).min(axis=1), out=least)
        return least

    def registers(self, hashes: np.ndarray) -> bytes:
        return compressed(self.minima(hashes)).tobytes() if len(hashes) else b""


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that registers of two disjoint sets of n and m elements agree."""
    total, out = n + m - 1.0, 0.0
    for zeros in range(48):
        low, high = 2.0 ** -(zeros + 1), 2.0**-zeros
        inside = np.exp(total * np.log1p(-low)) - (np.exp(total * np.log1p(-high)) if zeros else 0.0)
        out = out + low * 2.0**-MANTISSA * inside
    return n * m / total * out


def estimated(agreeing: np.ndarray, registers: int, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of agreeing registers, corrected for chance."""
    by_chance = chance(n.astype(float), m.astype(float))
    return (agreeing / registers - by_chance) / (1 - by_chance)


def sketch(docs: DataFrame, words: int, registers: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, registers) of rows (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(registers)
        for batch in batches:
            sets = (shingle_set(t.as_py(), words) for t in batch.column(1))
            rows = [(len(s), xxhash.xxh3_128_digest(s.tobytes()), sketcher.registers(s)) for s in sets]
            n, keys, found = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                                              pa.array(found, pa.binary())], names=["doc_id", "n_shingles", "set_key", "registers"])
    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, registers binary")


def estimates(pairs: DataFrame, reps: DataFrame, registers: int) -> DataFrame:
    """(a, b, n_a, n_b, estimate) of pairs (a, b)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, m = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
                one, two = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, registers) for k in (4, 5))
                found = estimated((one == two).sum(axis=1), registers, n, m)
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(found)], names=["a", "b", "n_a", "n_b", "estimate"])

    side = [reps.select(F.col("rep").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("registers").alias(f"r_{c}")) for c in "ab"]
    both = pairs.join(side[0], "a").join(side[1], "b").select("a", "b", "n_a", "n_b", "r_a", "r_b")
    return both.mapInArrow(run, "a long, b long, n_a long, n_b long, estimate double")


def likely(measured: DataFrame, similarity: float, registers: int) -> DataFrame:
    """The pairs whose estimate and sizes do not rule the similarity out."""
    floor = similarity - SIGMAS * math.sqrt(similarity * (1 - similarity) / registers)
    # a similarity is at most the ratio of the sizes
    sized = F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * similarity - 1e-6
    return measured.where((F.col("estimate") >= floor) & sized)


def compared(pairs: DataFrame, texts: DataFrame, words: int, percent: int, differences: bool) -> DataFrame:
    """(a, b, part, linked, delta, n, few, bits, tokens) of pairs (a, b, part), on the full sets of both texts.

    linked: 100 * intersection >= percent * union; delta: elements in one set only; n: of b's set.
    With ``differences`` tokens holds elements of delta, b's own first, each part in order of
    hash: as many as a partner of b can need, of which ``few`` suffice if b has the smaller delta;
    bits is a bitmap of all of delta.
    """
    share = (100 - percent) / (100 + percent)            # similar x, y differ in share * (|x| + |y|) elements at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: OrderedDict[str, np.ndarray] = OrderedDict()

        def set_of(text: str) -> np.ndarray:
            if text not in sets:
                sets[text] = shingle_set(text, words)
                if len(sets) > KEPT_SETS:
                    sets.popitem(last=False)
            sets.move_to_end(text)
            return sets[text]

        for batch in batches:
            rows = []
            for one, two in zip(batch.column(3), batch.column(4), strict=True):
                a, b = set_of(one.as_py()), set_of(two.as_py())
                own = np.setdiff1d(b, a, assume_unique=True)
                common = len(b) - len(own)
                delta = len(a) + len(b) - 2 * common
                near = 100 * common >= percent * (len(a) + len(b) - common)
                # the least number of shared differences that a similar partner of another component has
                if near:
                    need = math.ceil((delta - share * abs(len(b) - len(a))) / 2 - 1e-9)
                    few = delta - need + 1
                else:
                    most = share * (len(b) + len(b) * 100 / percent) + 1e-9
                    need = max(1, math.ceil((delta - most) / 2), delta - math.floor(most))
                    few = math.floor(most / 2) + 2
                every = np.concatenate([own, np.setdiff1d(a, b, assume_unique=True)]) if differences else own[:0]
                bits = np.zeros(64 * BITMAP, np.uint8)
                bits[(every % np.uint64(64 * BITMAP)).astype(np.int64)] = 1
                rows.append((near, delta, len(b), few, np.packbits(bits).view(np.int64), every[:delta - need + 1].view(np.int64)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(columns[0], pa.bool_()), *(pa.array(c, pa.int64()) for c in columns[1:4]),
                 *(pa.array(c, pa.list_(pa.int64())) for c in columns[4:])],
                names=["a", "b", "part", "linked", "delta", "n", "few", "bits", "tokens"])

    # the member's text first: it moves with its row, and the pivot's text moves once for each part, not for each member
    side = {c: texts.select(F.col("id").alias(c), F.col("text").alias(f"t_{c}")) for c in "ab"}
    pivots = pairs.select("a", "part").distinct().join(side["a"], "a")
    return (pairs.join(side["b"], "b").join(pivots, ["a", "part"]).select("a", "b", "part", "t_a", "t_b")
            .mapInArrow(run, "a long, b long, part long, linked boolean, delta long, n long, few long, bits array<long>, tokens array<long>"))


def component_of(rows: DataFrame, column: str, components: DataFrame, name: str) -> DataFrame:
    """``rows`` with the component of an id column; an id without links is its own."""
    known = components.select(F.col("id").alias(column), F.col("component").alias(name))
    return rows.join(known, column, "left").withColumn(name, F.coalesce(name, column))


def close_pairs(stars: DataFrame, components: DataFrame, share: float, folder: str) -> DataFrame:
    """Pairs (a, b) of members of other components that share enough of their differences from a pivot."""
    parts = stars.select("a", "part").distinct()
    placed = (component_of(stars, "b", components, "component")
              .join(component_of(parts, "a", components, "of_pivot"), ["a", "part"]))
    open_pivots = placed.where("component <> of_pivot").select("a").distinct()
    stars = written(placed.join(parts.join(open_pivots, "a"), ["a", "part"]).withColumnsRenamed({"a": "pivot", "b": "id"}), "open-stars", folder)
    # narrow rows find the elements that members of several components list; the wide columns come to those alone
    elements = stars.select("pivot", "id", "component", F.posexplode("tokens").alias("rank", "token"))
    several = (elements.groupBy("pivot", "token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
               .where("low <> high").select("pivot", "token"))
    ranks = (elements.select("pivot", "token", "id", "rank").join(several, ["pivot", "token"])
             .groupBy("pivot", "id").agg(F.collect_list("rank").alias("ranks")))
    listed = (stars.join(ranks, ["pivot", "id"]).select("*", F.explode("ranks").alias("rank")).withColumn("token", F.get("tokens", "rank"))
              .withColumn("recent", F.slice("tokens", F.greatest(F.col("rank") - (RECENT - 1), F.lit(1)), F.least(F.col("rank"), F.lit(RECENT))))
              .select("pivot", "id", "component", "delta", "n", "few", "bits", "rank", "token", "recent"))
    listed = written(listed, "differences", folder)
    left, right = (listed.withColumnsRenamed({c: f"{side}_{c}" for c in listed.columns if c not in ("pivot", "token")}) for side in "lr")
    small = right.where("r_rank < r_few")
    shared = F.greatest(F.lit(1), F.ceil((F.col("l_delta") + F.col("r_delta") - share * (F.col("l_n") + F.col("r_n"))) / 2 - 1e-9))
    larger = (F.col("l_delta") > F.col("r_delta")) | ((F.col("l_delta") == F.col("r_delta")) & (F.col("l_id") > F.col("r_id")))
    meet = (F.col("l_rank") <= F.col("l_delta") - shared) & (F.col("r_rank") <= F.col("r_delta") - shared)
    # two elements may share a bit, so bitmaps differ in no more bits than the sets in elements
    apart = sum((F.bit_count(F.get("l_bits", F.lit(k)).bitwiseXOR(F.get("r_bits", F.lit(k)))) for k in range(BITMAP)), F.lit(0))
    likewise = apart <= share * (F.col("l_n") + F.col("r_n")) + 1e-9
    first = ~F.arrays_overlap("l_recent", "r_recent")
    met = left.join(small, ["pivot", "token"]).where((F.col("l_component") != F.col("r_component")) & larger & meet & likewise & first)
    return met.select(F.least("l_id", "r_id").alias("a"), F.greatest("l_id", "r_id").alias("b"))


def near_components(docs: DataFrame, members: DataFrame, reps: DataFrame, same: DataFrame, words: int, percent: int,
                    registers: int, folder: str) -> DataFrame:
    """(id, component) of the ids that any link touches.

    members: (band, id, pivot, n) of shared bands of n members; same: (a, b) of an id and the representatives of its texts.
    """
    similarity = percent / 100
    wanted = written(members.select(F.col("id").alias("doc_id")).distinct(), "wanted", folder)
    # most texts are no member's: they stay where they are
    asked = maybe_among(docs, "doc_id", wanted, "asked").where("asked")
    texts = written(asked.join(wanted, "doc_id").select(F.col("doc_id").alias("id"), "text"), "texts", folder)
    part = F.pmod(F.xxhash64("b"), F.ceil(F.max("n") / MEMBERS)).alias("part")
    pairs = written(members.where("id <> pivot").groupBy(F.col("pivot").alias("a"), F.col("id").alias("b")).agg(part), "pairs", folder)
    stars = written(compared(pairs, texts, words, percent, True), "stars", folder)
    links = stars.where("linked").select("a", "b").union(same)
    components = written(connected_components(links, folder), "components", folder)
    more = (close_pairs(stars, components, (100 - percent) / (100 + percent), folder).distinct()
            .join(stars.select("a", "b"), ["a", "b"], "left_anti"))
    tested = likely(estimates(more, reps, registers), similarity, registers).select("a", "b", F.lit(0).cast("long").alias("part"))
    tested = written(tested, "tested", folder)
    crossing = written(compared(tested, texts, words, percent, False).where("linked").select("a", "b"), "crossing-links", folder)
    return components if crossing.isEmpty() else written(connected_components(links.union(crossing), folder), "components", folder)


def near_dedup(docs: DataFrame, words: int = 3, percent: int = 85, rows: int = 5, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * |intersection| >= percent * |union| of their shingle sets.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    with workspace(docs.sparkSession, "near-dedup") as folder:
        return written(linked_documents(docs, words, percent, rows, folder), "near-dedup")


def linked_documents(docs: DataFrame, words: int, percent: int, rows: int, folder: str) -> DataFrame:
    """``near_dedup`` of rows (doc_id, text), read from tables in ``folder``."""
    bands = bands_for(percent / 100, rows)
    sketches = written(sketch(docs, words, bands * rows), "sketches", folder)
    slim = sketches.select("doc_id", "n_shingles", "set_key")
    filled = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = written(filled.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"),
                                                 F.first("registers").alias("registers")), "classes", folder)
    size = 2 * rows
    band_keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)),
                            lambda j: F.xxhash64(j, F.substring(F.col("registers"), j * size + 1, F.lit(size))))
    banded = reps.select(F.col("rep").alias("id"), F.explode(band_keys).alias("band"))
    shared = (banded.groupBy("band").agg(F.min("id").alias("pivot"), F.max("id").alias("high"), F.count("*").alias("n"))
              .where("pivot <> high").select("band", "pivot", "n"))
    members = written(banded.join(shared, "band"), "band-members", folder)
    # ids with several texts, empty ones among them, link the classes of these
    key = F.xxhash64("set_key")
    several = written(slim.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(key).alias("low"), F.max(key).alias("high"))
                      .where("low <> high").select("doc_id"), "several", folder)
    same = written(slim.join(several, "doc_id").join(reps.select("set_key", "rep"), "set_key").where("doc_id <> rep")
                   .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct(), "same-id", folder)
    components = near_components(docs.where("doc_id IS NOT NULL"), members, reps.select("rep", "n_shingles", "registers"),
                                 same, words, percent, bands * rows, folder)
    classes = (reps.select("set_key", "rep").join(components, F.col("rep") == F.col("id"), "left")
               .select("set_key", F.coalesce("component", "rep").alias("component_id")))
    # an empty text has no class of its own: it goes with the other texts of its id
    of_several = components.join(several, F.col("id") == F.col("doc_id"), "left_semi").select("id", "component")
    empty = (slim.where("n_shingles = 0").join(of_several, F.col("doc_id") == F.col("id"), "left")
             .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
    # one row for each class; a class of many copies is split by the adaptive skew join
    filled = (slim.where("n_shingles > 0").join(classes, "set_key", "left")
              .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))
    return (filled.union(empty)
            .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))
