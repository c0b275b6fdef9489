"""Quality classifier by compression.

Two zstandard dictionaries are trained, one on good and one on bad labelled texts.  A text is
compressed piece by piece with each of them and without one; the normalised difference of the
two sizes, (bad - good) / (bad + good), says which kind of text it resembles, and the size
without a dictionary how repetitive it is.  A ridge logistic regression on both (with squares
and product) calibrates them to the probability of label 1.

Fitting uses a bounded sample: up to ``SAMPLE`` labelled texts of each class, the ones with the
least hash of their id among the rows outside the held-out fold (crc32 of the id as text mod 5
is 0).  Of a text of more than ``LONGEST_SAMPLE`` characters it has as many, in pieces from all
of the text.  The regression sees sizes from
dictionaries that were trained on the other half of the sample; the final dictionaries use all
of it.  Class weights restore the shares of the labels.  Every text is scored whole.

Defined cases: null text is the empty text; empty texts get a score like any other; with
labels of fewer than two classes every score is 0.5; labels that are null, or whose document is
missing, are not used; a null doc_id counts as held out.  Rows are scored one by one, so
ties, repeated rows and other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumen.llm.logistic import ridge_logistic
from lumen.llm.shared import drawn, text_of

#: Texts of each class that the classifier is fitted on, and the characters of each.
SAMPLE, LONGEST_SAMPLE = 2_000, 20_000
DICTIONARY_BYTES = 112_640
LEVEL = 3
#: Bytes compressed at a time, so that a dictionary matters as much in a long text.
PIECE = 1_000
#: Pieces of a sampled text, spread over all of it, that a dictionary is trained on, and their bytes.
TRAINED_PIECES, TRAINED_BYTES = 4, 500
RIDGE = 0.1
THRESHOLD = 0.3
FOLDS = 5


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def trained_pieces(text: str) -> list[bytes]:
    """All of a short text; of a longer one a piece of each of its equal parts, placed by the text's hash."""
    data = text.encode()
    if len(data) <= TRAINED_PIECES * TRAINED_BYTES:
        return [data[at:at + TRAINED_BYTES] for at in range(0, len(data), TRAINED_BYTES)]
    ends = [k * len(data) // TRAINED_PIECES for k in range(TRAINED_PIECES + 1)]
    starts = [low + xxhash.xxh3_64_intdigest(data, seed=low) % (high - low - TRAINED_BYTES + 1) for low, high in pairwise(ends)]
    return [data[at:at + TRAINED_BYTES] for at in starts]


def dictionary(texts: list[str]) -> bytes:
    """A zstandard dictionary of the texts; of few texts their plain content."""
    pieces = [p for t in texts for p in trained_pieces(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY_BYTES:]


class Sizes:
    """Compressed sizes of texts with a good, a bad and no dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        dictionaries = [zstandard.ZstdCompressionDict(d) for d in (good, bad)]
        for d in dictionaries:
            d.precompute_compress(level=LEVEL)
        self.compressors = [zstandard.ZstdCompressor(dict_data=d, **options) for d in dictionaries]
        self.compressors.append(zstandard.ZstdCompressor(**options))

    def features(self, text: str) -> tuple[float, float]:
        """The normalised size difference and the logarithm of the size ratio without a dictionary."""
        data, sizes = text.encode(), [2, 2, 2]
        for at in range(0, len(data), PIECE):
            piece = data[at:at + PIECE]
            for k, c in enumerate(self.compressors):
                sizes[k] += len(c.compress(piece)) - 2
        good, bad, plain = sizes
        return (bad - good) / (bad + good), float(np.log((plain + 2) / (len(data) + 2)))


def design(features: np.ndarray) -> np.ndarray:
    difference, ratio = features.T
    return np.column_stack([difference, ratio, difference**2, ratio**2, difference * ratio])


def fit(good: list[str], bad: list[str], share: float) -> dict | None:
    """The model from texts of both labels; share: of label 1 among the labelled rows."""
    if not good or not bad:
        return None
    halves = [[texts[k::2] or texts for k in (0, 1)] for texts in (good, bad)]
    features, labels = [], []
    for k in (0, 1):
        sizes = Sizes(dictionary(halves[0][1 - k]), dictionary(halves[1][1 - k]))
        for label, texts in ((1, good[k::2]), (0, bad[k::2])):
            features += [sizes.features(t) for t in texts]
            labels += [label] * len(texts)
    x, y = design(np.array(features)), np.array(labels, float)
    mean, deviation = x.mean(axis=0), x.std(axis=0) + 1e-9
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return {"good": dictionary(good), "bad": dictionary(bad), "mean": mean, "deviation": deviation,
            "coefficients": ridge_logistic((x - mean) / deviation, y, weight, RIDGE)}


def excerpt(column: str) -> Column:
    """A text, or of a longer one LONGEST_SAMPLE characters: a piece of each of its equal parts, placed by the text's hash."""
    text, parts = F.col(column), LONGEST_SAMPLE // PIECE
    n, pieces = F.length(text).cast("long"), []
    for k in range(parts):
        low, high = F.floor(n * k / parts), F.floor(n * (k + 1) / parts)
        moved = F.pmod(F.xxhash64(F.xxhash64(text), F.lit(k)), F.greatest(high - low - PIECE + 1, F.lit(1)))
        pieces.append(F.substring(text, (low + moved + 1).cast("int"), F.lit(PIECE)))
    return F.when(n <= LONGEST_SAMPLE, text).otherwise(F.concat(*pieces))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict | None:
    """A model from rows (doc_id, text) and (doc_id, quality)."""
    usable = labels.where(F.col("quality").isin(0, 1) & ~held_out()).select(F.col("doc_id").alias("labelled"), "quality")
    counts = {r[0]: r[1] for r in usable.groupBy("quality").count().collect()}          # two rows
    good, bad = (drawn(usable.where(F.col("quality") == q), "labelled", sample, counts.get(q, 0)) for q in (1, 0))
    chosen = good.union(bad).distinct()
    body = docs.select("doc_id", text_of("text").alias("text"))
    rows = (body.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))        # 2 * sample rows at most
            .select("quality", excerpt("text").alias("text"), (F.length("text") > LONGEST_SAMPLE).alias("long"), "doc_id")
            .orderBy(F.xxhash64("doc_id"), "text").limit(2 * sample).collect())
    # excerpts come last, so that they do not deal the other texts anew to the halves
    texts = [[r["text"] for r in sorted(rows, key=lambda r: r["long"]) if r["quality"] == q] for q in (0, 1)]
    return fit(texts[1], texts[0], counts.get(1, 0) / max(1, sum(counts.values())))


def scorer(docs: DataFrame, model: dict | None) -> Callable[[str], Column]:
    """A function from a text column to its score column."""
    if model is None:
        return lambda column: F.lit(0.5)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        sizes = Sizes(m["good"], m["bad"])
        for texts in batches:
            if texts.empty:
                yield pd.Series([], dtype="float64")
                continue
            x = (design(np.array([sizes.features(t) for t in texts])) - m["mean"]) / m["deviation"]
            yield pd.Series(1 / (1 + np.exp(-np.clip(m["coefficients"][0] + x @ m["coefficients"][1:], -500, 500))))

    return lambda column: score(text_of(column))


def with_quality(docs: DataFrame, model: dict | None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with columns score and predicted (1: good), in place of columns of those names."""
    score = scorer(docs, model)("text")
    return docs.withColumn("score", score).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
