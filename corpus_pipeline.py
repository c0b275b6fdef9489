"""The training-corpus pipeline: stages over the documents table, each written as Parquet and read again.

1. quality: documents that the compression classifier rejects go.
2. line dedup: later copies of three-line windows go from the texts; n_chars follows.
3. near-dedup: of each component (five-word shingles, similarity 0.8) the least doc_id stays.
4. decontamination: documents that contain a benchmark item go.
5. BPE: ids of every text, and a digest of the text decoded from them.

Every stage works on all rows of its predecessor.  Stages 1 to 4 return the columns of the
documents table.  Rows with a null doc_id pass the stages on their own: they are never near-copies.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumen.llm import bpe, decontaminate, line_dedup, near_dedup, quality
from lumen.llm.shared import maybe_among, written
from lumen.sources.tables import load


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, load(spark, sf_dir, "labels", "doc_id", "quality"))
    return docs.where(quality.scorer(docs, model)("text") >= quality.THRESHOLD)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = line_dedup.dedup_lines(docs)
    chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", chars).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # all rows of an id are kept or none; ids that go are few, so most texts need not move to meet them
    found = near_dedup.near_dedup(docs, words=5, percent=80, rows=5)
    gone = written(found.where("NOT kept").select(F.col("doc_id").alias("gone_id")).distinct(), "gone")
    flagged = maybe_among(docs, "doc_id", gone, "maybe_gone")
    left = flagged.where("maybe_gone").join(gone, F.col("doc_id") == F.col("gone_id"), "left_anti")
    return flagged.where("NOT maybe_gone").union(left).select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, load(spark, sf_dir, "benchmark", "item_id", "text"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", keep_good), ("line-dedup", drop_repeated_lines), ("near-dedup", one_of_each),
          ("decontamination", decontaminated), ("bpe", encoded)]

#: The quality classifier is learned, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
