"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

A word is a row of symbols.  Leaf i of the tree holds the rank of the pair (symbol i, its
right neighbour) with i as tie-break, every inner node the minimum of its two children, so the
root yields the leftmost merge of lowest rank.  A merge changes at most three leaves; each is
a point update along one path to the root.  The word is done when the root holds no rank.

Words of up to ``WIDEST`` bytes go through many trees at once (``merge_many``: one row of a
numpy table for each word's tree), longer ones through one (``merge_all``); both do the same
merges.  The tokenizer file (JSON of a byte-level BPE) is read on the driver and broadcast; a
file is a few megabytes whatever the input.  Each Python worker remembers recent words
(``REMEMBERED`` bytes in each of two generations).  Documents are encoded where they lie: no shuffle.

Defined cases: null text is the empty text and has no ids; added tokens (such as
``<|endoftext|>``) inside a text become their id; rows are independent, so ties, repeated
rows and other columns do not matter.  Very long words cost n log n.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumen.llm.recent import Recent
from lumen.llm.shared import text_of

# Fixed value: the word pattern of byte-level BPE files.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of words that a Python worker remembers, in each of two generations.
REMEMBERED = 60_000_000
#: Bytes of the longest word that is merged together with others.
WIDEST = 64
#: Rows handed to Arrow at a time.
SLICE = 128


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


def merge_all(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge the leftmost pair of lowest rank until no pair has a rank; ranks: pair -> (rank, merged)."""
    n = len(symbols)
    if n < 2:
        return symbols
    symbols, none = list(symbols), len(ranks) * n + n
    size = 1 << (n - 1).bit_length()
    tree = [none] * (2 * size)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))

    def leaf(i: int) -> int:
        found = ranks.get((symbols[i], symbols[right[i]])) if right[i] < n else None
        return none if found is None else found[0] * n + i

    def update(i: int, value: int) -> None:
        k = size + i
        tree[k] = value
        while k > 1:
            k >>= 1
            least = min(tree[2 * k], tree[2 * k + 1])
            if tree[k] == least:
                break
            tree[k] = least

    for i in range(n - 1):
        tree[size + i] = leaf(i)
    for k in range(size - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])
    while tree[1] < none:
        i = tree[1] % n
        j = right[i]
        symbols[i], symbols[j] = ranks[symbols[i], symbols[j]][1], -1
        right[i] = right[j]
        if right[j] < n:
            left[right[j]] = i
        update(j, none)
        update(i, leaf(i))
        if left[i] >= 0:
            update(left[i], leaf(left[i]))
    return [s for s in symbols if s >= 0]


class Merges:
    """The pair ranks as sorted arrays, for many words at once."""

    SHIFT = 20

    def __init__(self, ranks: dict[tuple[int, int], tuple[int, int]]):
        keys = np.array([a << self.SHIFT | b for a, b in ranks], np.int64)
        order = np.argsort(keys)
        rank, merged = np.array(list(ranks.values()), np.int64).reshape(-1, 2).T
        self.keys, self.ranks = np.append(keys[order], -1), rank[order]
        self.merged = np.zeros(max(rank, default=0) + 1, np.int64)
        self.merged[rank] = merged
        self.none = len(self.merged)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``none`` where it has none."""
        key = a << self.SHIFT | b
        at = np.searchsorted(self.keys[:-1], key)
        found = self.keys[at] == key
        return np.where(found, self.ranks[np.where(found, at, 0)], self.none)

    def merge_many(self, words: list[bytes], first: np.ndarray) -> list[bytes]:
        """``merge_all`` for words of much the same length; first: the symbol of each byte."""
        lengths = np.array([len(w) for w in words])
        width = int(lengths.max())
        end = (1 << self.SHIFT) - 1                      # the symbol after a word's last
        symbols = np.full((len(words), width + 1), end, np.int64)
        symbols[np.arange(width + 1) < lengths[:, None]] = first[np.frombuffer(b"".join(words), np.uint8)]
        left, right = (np.tile(np.arange(width + 1) + d, (len(words), 1)) for d in (-1, 1))
        right[:, width] = width
        size, nothing = 1 << (width - 1).bit_length(), self.none * width
        leaves = self.rank(symbols[:, :-1], symbols[:, 1:]) * width + np.arange(width)
        tree = np.full((len(words), 2 * size), nothing, np.int64)
        tree[:, size:size + width] = np.minimum(leaves, nothing)
        for k in range(size - 1, 0, -1):
            np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1], out=tree[:, k])

        def update(rows: np.ndarray, leaf: np.ndarray, value: np.ndarray | int) -> None:
            k = size + leaf
            tree[rows, k] = value
            while size > 1 and k[0] > 1:                 # all leaves are equally deep
                k = k >> 1
                tree[rows, k] = np.minimum(tree[rows, 2 * k], tree[rows, 2 * k + 1])

        def pair(rows: np.ndarray, leaf: np.ndarray) -> np.ndarray:
            return np.minimum(self.rank(symbols[rows, leaf], symbols[rows, right[rows, leaf]]) * width + leaf, nothing)

        rows = np.flatnonzero(tree[:, 1] < nothing)
        while len(rows):
            rank, i = np.divmod(tree[rows, 1], width)
            j = right[rows, i]
            symbols[rows, i], symbols[rows, j] = self.merged[rank], -1
            after = right[rows, j]
            right[rows, i] = after
            left[rows, after] = i
            update(rows, j, nothing)
            update(rows, i, pair(rows, i))
            inner = left[rows, i] >= 0
            if inner.any():
                before = left[rows, i][inner]
                update(rows[inner], before, pair(rows[inner], before))
            rows = rows[tree[rows, 1] < nothing]
        whole = (symbols >= 0) & (symbols != end)
        data, stops = symbols[whole].astype("<u4").tobytes(), (whole.sum(axis=1).cumsum() * 4).tolist()
        return [data[a:b] for a, b in zip([0, *stops], stops, strict=False)]


class Codec:
    """Encoder and decoder of one byte-level BPE file."""

    def __init__(self, file_text: str):
        file = json.loads(file_text)
        vocab, letters = file["model"]["vocab"], byte_letters()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in file["model"]["merges"]]
        self.ranks = {(vocab[a], vocab[b]): (k, vocab[a + b]) for k, (a, b) in reversed(list(enumerate(pairs)))}
        self.merges = Merges(self.ranks)
        self.first = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        byte_of = {letter: b for b, letter in letters.items()}
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.parts = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for token, i in vocab.items()}
        self.bytes_of |= {i: content.encode() for content, i in self.added.items()}
        self.pattern = regex.compile(WORD)
        self.recent = Recent(REMEMBERED, self.merged)

    def merged(self, words: list[str]) -> list[bytes]:
        """The ids of each word (or added token)."""
        out: list = [None] * len(words)
        alike: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            if word in self.added:
                out[k] = np.array([self.added[word]], "<u4").tobytes()
            elif len(word) * 4 <= WIDEST or len(word.encode()) <= WIDEST:
                alike.setdefault((len(word) - 1).bit_length(), []).append(k)
            else:
                out[k] = np.array(merge_all(self.first[np.frombuffer(word.encode(), np.uint8)].tolist(), self.ranks), "<u4").tobytes()
        for same in alike.values():
            for k, ids in zip(same, self.merges.merge_many([words[k].encode() for k in same], self.first), strict=True):
                out[k] = ids
        return out

    def words(self, text: str) -> list[str]:
        out = []
        for part in self.parts.split(text) if self.parts else [text]:
            out += [part] if part in self.added else self.pattern.findall(part)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        return self.recent.joined([self.words(t) for t in texts])

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def codec(file_text: str) -> Codec:
    """One codec for each file and Python worker."""
    return Codec(file_text)


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and the text decoded from them."""
    file = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_text())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(file.value)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                ids = bpe.encode(rows.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                     pa.array([bpe.decode(x) for x in ids], pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")
