"""The corpus pipeline: quality, near duplicates, benchmark leaks, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written and read again as the next stage's documents. All but the last return
the columns of documents; the last returns the placed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pairflow.llm import decontaminate, minhash, packing, quality, secrets
from pairflow.llm.common import staged, table


CACHED_PIECES = 200_000


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (10) accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class (1)."""
    return minhash.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage (5)."""
    return decontaminate.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced (8)."""
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents placed in sequences (2)."""
    # behind the other stages an executor's memory is taken, so a small memo
    return packing.pack(docs, cached=CACHED_PIECES)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

# Trained models, random walks and a tokeniser: not expressible in SQL. The
# stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
