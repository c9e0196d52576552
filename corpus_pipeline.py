"""The corpus pipeline: quality, exact copies, near copies, benchmark leaks, tokens.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the columns of
``documents``. Stages handle nulls, empty and very long texts, repeated rows, empty tables and extra columns as their operators do.
"""

from __future__ import annotations

import pathlib
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from tidemill.llm import bpe, decontaminate, exact_dedup, minhash, quality  # noqa: E402
from tidemill.llm.common import read  # noqa: E402
from tidemill.session import settled  # noqa: E402


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    machine = quality.fit(docs, read(spark, sf_dir, "labels"))
    score = quality.scorer(machine)(F.col("text"), F.col("n_chars").cast("double"))
    return docs.where(score >= quality.THRESHOLD)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per text."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per group of near-duplicates: five-word shingles, similarity 0.8."""
    return minhash.drop_near_duplicates(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaking(docs, read(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of what they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, public_tokenizers.PATTERN)
    return ids.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", bpe.ids_digest("ids").alias("ids_sha256"),
                      F.sha2(bpe.decoder(path)(F.col("ids")), 256).alias("decoded_sha256"))


STAGES = [("quality", keep_quality), ("exact_dedup", drop_exact_copies), ("near_dedup", drop_near_copies),
          ("decontamination", drop_benchmark_leaks), ("bpe", to_tokens)]

#: The first stage is a trained model, which SQL cannot express; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
