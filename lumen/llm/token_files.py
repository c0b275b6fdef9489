"""Token ids in Arrow files of equal-length sequences.

Documents are put in ascending doc_id order by a range partitioning, encoded, closed with an
end id and laid end to end.  The ranges are cut by doc_id and the beginning of the text, which
keeps that order and spreads rows that share an id (or have none) over many tasks.  Each task cuts its stream into sequences of ``LENGTH`` ids and
writes them in the Arrow file format: record batches of ``ROWS`` sequences, each a fixed-size
list of ids and one of mask bits (false: padding, only at the end of a file).  As every
sequence has the same length, sequence k is row k mod ROWS of batch k div ROWS: a reader maps
the file and views it without a copy.  Beside each lies an index file (doc_id, n_tokens).

The manifest, a Parquet table, names the files.  A task writes under names of its own attempt
and only a finished task's files enter the manifest, so a lost executor or a task that runs
twice leaves no wrong file in it.  A file's place in the whole is the sum of the files before
it, from one manifest row for each file.

Defined cases: null text is the empty text, whose only id is the end id; a null doc_id sorts
first; repeated doc_ids are ordered by text (only those whose texts also begin with the same
``CUT_BY`` characters are sure to meet in one task); other columns are ignored; an empty table gives
an empty manifest.
"""

from __future__ import annotations

import functools
import uuid
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumen.llm.bpe import byte_letters
from lumen.llm.recent import Recent
from lumen.llm.shared import shared_path, text_of

LENGTH = 1024
ROWS = 64
#: Sequences after which a task begins a new file.
FILE_ROWS = 1 << 16
#: Bytes of parts, and of pieces, that a Python worker remembers in each of two generations.
REMEMBERED = 60_000_000
#: Rows encoded at a time.
SLICE = 256
#: Characters of a text that the ranges of equal doc_ids are cut by.
CUT_BY = 32
# The first letter after the Latin blocks, and ASCII punctuation that a part may end in
# without changing how its letters are encoded.
LATIN_END = "\u0250"
PUNCTUATION = ".,!#$%&*|?;:\"()-"
MANIFEST = "part long, seq long, path string, first_doc long, n_docs long, n_tokens long"


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder of the cluster."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


class Encoder:
    """The tokenizers library on the parts of a text between spaces and newlines.

    The tokenizer drops white space and no rule of it looks across white space, so a text's
    ids are those of its parts in turn.  A part that is letters and then ASCII punctuation is
    two pieces to the tokenizer, encoded one by one; Latin letters, whose normal form is
    themselves in lower case, go straight to the tokenizer's model.  Parts and pieces repeat,
    and the ids of recent ones are remembered.
    """

    def __init__(self, file_text: str, kind: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(file_text)
        self.library.no_truncation()
        self.library.no_padding()
        self.model, self.letters, self.kind = self.library.model, byte_letters(), kind
        self.recent, self.pieces = Recent(REMEMBERED, self.parts), Recent(REMEMBERED, self.ids)

    def ids(self, pieces: list[str]) -> list[bytes]:
        out: list = [None] * len(pieces)
        others = []
        for k, piece in enumerate(pieces):
            if piece.isascii():
                lower = piece.lower()
            else:
                lower = "".join(c.lower() for c in piece) if piece.isalpha() and max(piece) < LATIN_END else ""
            if lower.isalpha():                          # one letter's lower case has a mark, which is no letter
                letters = lower if lower.isascii() else "".join(map(self.letters.__getitem__, lower.encode()))
                out[k] = array(self.kind, [t.id for t in self.model.tokenize(letters)]).tobytes()
            else:
                others.append(k)
        for k, found in zip(others, self.library.encode_batch_fast([pieces[k] for k in others], add_special_tokens=False), strict=True):
            out[k] = array(self.kind, found.ids).tobytes()
        return out

    def parts(self, parts: list[str]) -> list[bytes]:
        words = [part.rstrip(PUNCTUATION) for part in parts]
        pieces = [(word.lower() if word.isascii() else word) if word.isalpha() else part for word, part in zip(words, parts, strict=True)]
        tails = [part[len(word):] if word.isalpha() else "" for word, part in zip(words, parts, strict=True)]
        known = self.pieces.table({*pieces, *tails}).__getitem__
        return [known(piece) + known(tail) if tail else known(piece) for piece, tail in zip(pieces, tails, strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.recent.joined([t.replace("\n", " ").split(" ") for t in texts])


@functools.lru_cache(maxsize=2)
def encoder(file_text: str, kind: str) -> Encoder:
    """One encoder for each file and Python worker; kind: an unsigned integer type, as of ``array``."""
    return Encoder(file_text, kind)


class Shard:
    """One file of sequences and its index."""

    def __init__(self, folder: str, kind: str, length: int, rows: int):
        self.kind, self.length, self.rows = np.dtype(kind), length, rows
        self.system, path = store(folder)
        self.path = f"{path}/{uuid.uuid4().hex}"
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(self.kind), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.out = self.system.open_output_stream(f"{self.path}.arrow")
        self.file = pa.ipc.new_file(self.out, self.schema)
        self.held, self.held_bytes = [], 0
        self.doc_ids, self.counts, self.tokens = [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // self.kind.itemsize
        self.doc_ids.append(doc_id)
        self.counts.append(n)
        self.tokens += n
        self.held.append(ids)
        self.held_bytes += len(ids)
        if self.held_bytes >= self.rows * self.length * self.kind.itemsize:
            self.flush(False)

    def flush(self, last: bool) -> None:
        data, full = b"".join(self.held), self.rows * self.length
        ids = np.frombuffer(data, self.kind)
        take = len(ids) if last else len(ids) // full * full
        for at in range(0, take, full):
            part = ids[at:min(at + full, take)]
            missing = -len(part) % self.length
            values = np.concatenate([part, np.zeros(missing, self.kind)]) if missing else part
            mask = np.arange(len(values)) < len(part)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (values, mask)]
            self.file.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.held = [data[take * self.kind.itemsize:]]
        self.held_bytes = len(self.held[0])

    def close(self) -> tuple:
        self.flush(True)
        self.file.close()
        self.out.close()
        index = pa.table({"doc_id": pa.array(self.doc_ids, pa.int64()), "n_tokens": pa.array(self.counts, pa.int64())})
        with self.system.open_output_stream(f"{self.path}.index.arrow") as out, pa.ipc.new_file(out, index.schema) as file:
            file.write_table(index)
        return self.path, self.doc_ids[0], len(self.doc_ids), self.tokens


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                      length: int = LENGTH, rows: int = ROWS, file_rows: int = FILE_ROWS) -> str:
    """Write the files; returns the manifest's path."""
    from pyspark import TaskContext
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    text = Path(tokenizer_path).read_text()
    kind = "H" if max(Tokenizer.from_str(text).get_vocab_size() - 1, end_id) < 1 << 16 else "I"
    file, end = spark.sparkContext.broadcast(text), array(kind, [end_id]).tobytes()
    folder = shared_path(spark, "token-files")
    system, path = store(folder)
    system.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part, seq, shard = encoder(file.value, kind), TaskContext.get().partitionId(), 0, None

        def closed() -> pa.RecordBatch:
            row = dict(zip(("path", "first_doc", "n_docs", "n_tokens"), shard.close(), strict=True))
            return pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], **{k: [v] for k, v in row.items()}}, schema=pa.schema(
                [(n, pa.string() if n == "path" else pa.int64()) for n in ("part", "seq", "path", "first_doc", "n_docs", "n_tokens")]))

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                doc_ids, texts = (batch.column(k).slice(at, SLICE).to_pylist() for k in (0, 1))
                for doc_id, ids in zip(doc_ids, code.encode(texts), strict=True):
                    if shard is None:
                        shard = Shard(folder, kind, length, rows)
                    shard.add(doc_id, ids + end)
                    if shard.tokens >= file_rows * length:
                        yield closed()
                        shard, seq = None, seq + 1
        if shard is not None:
            yield closed()

    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
               .repartitionByRange("doc_id", F.substring("text", 1, CUT_BY)).sortWithinPartitions("doc_id", "text"))
    manifest = f"{folder}-manifest"
    ordered.mapInArrow(run, MANIFEST).write.parquet(manifest)
    return manifest


def read_token_files(spark: SparkSession, manifest: str, length: int = LENGTH, rows: int = ROWS) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read from the files of a manifest."""
    files = spark.read.schema(MANIFEST).parquet(manifest)
    before = Window.orderBy(F.col("first_doc").asc_nulls_first(), "part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))
    folder = manifest.removesuffix("-manifest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = store(folder)
        for batch in batches:
            for path, start in zip(*(batch.column(k).to_pylist() for k in (0, 1)), strict=True):
                with system.open_input_file(f"{path}.index.arrow") as source:
                    index = pa.ipc.open_file(source).read_all()
                doc_ids, counts = index["doc_id"].to_pylist(), index["n_tokens"].to_pylist()
                local = isinstance(system, fs.LocalFileSystem)
                with (pa.memory_map(f"{path}.arrow") if local else system.open_input_file(f"{path}.arrow")) as source:
                    file = pa.ipc.open_file(source)
                    span, held, at, crcs = rows * length, (-1, None), 0, []
                    for n in counts:
                        crc, left = 0, n
                        while left:
                            if held[0] != at // span:
                                sequences = file.get_batch(at // span)
                                ids, mask = (sequences.column(k).flatten() for k in (0, 1))
                                held = (at // span, ids.to_numpy(zero_copy_only=True)[:mask.true_count])
                            piece = held[1][at % span:at % span + left]
                            if not len(piece):
                                raise ValueError(f"{path}.arrow ends before its index")
                            crc, at, left = zlib.crc32(piece.astype("<u4").tobytes(), crc), at + len(piece), left - len(piece)
                        crcs.append(crc)
                starts = start + np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(counts, pa.int64()),
                                                  pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = placed.repartition(max(1, files.count()))
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
