"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

HELD_OUT_FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts the lineage
    and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """The fold that never trains: crc32(doc_id as text) mod 5 = 0. A null
    id belongs to no fold and is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_FOLDS == 0,
                      F.lit(False))


def hash_fraction(key: Column, bound: int, total: int, seed: int) -> Column:
    """True for about `bound` of `total` keys, the same ones on every run."""
    parts = 1_000_000
    keep = parts if total <= bound else max(1, int(parts * bound / total))
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(parts)) < keep


def labelled_texts(documents: DataFrame, labels: DataFrame, label: str, bound: int,
                   seed: int = 7) -> DataFrame:
    """(doc_id, text, label) of about `bound` labelled rows outside the held
    out fold. Null labels are no labels; a document labelled more than once
    counts as 1 if any of its labels is 1."""
    lab = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()
                       & ~held_out(F.col("doc_id")))
    total = lab.count()
    lab = (lab.where(hash_fraction(F.col("doc_id"), bound, total, seed))
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))
    # at most about `bound` narrow rows: small by the parameter
    return (documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(lab), "doc_id"))


def sub_batches(frames: Iterator[pd.DataFrame], column: str,
                rows: int = 400, chars: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches into pieces of bounded text, so that a task's memory
    depends on neither the batch size nor a run of long documents."""
    for frame in frames:
        sizes = frame[column].fillna("").str.len().to_numpy()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and (i - start >= rows or held + n > chars):
                yield frame.iloc[start:i]
                start, held = i, 0
            held += n
        if start < len(frame):
            yield frame.iloc[start:]
    give_back()


def give_back() -> None:
    """Return what a worker has freed to the machine: reused workers otherwise
    keep the largest amount that any of their tasks took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library than GNU's


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                rows: int = 400, chars: int = 4_000_000, memo: str | None = None):
    """(slice, texts) of Arrow batches, cut by the texts' bytes before any of
    them is decoded. Columns that only pass through stay Arrow data: ids keep
    their exact values next to nulls, which pandas would turn into doubles.

    Memos of other operators than the one named are dropped at the first
    batch, and freed memory is given back at the end of the task."""
    drop_memos(memo)
    try:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
            start, held, cuts = 0, 0, []
            for i, n in enumerate(sizes):
                if i > start and (i - start >= rows or held + n > chars):
                    cuts.append((start, i))
                    start, held = i, 0
                held += n
            if start < len(sizes):
                cuts.append((start, len(sizes)))
            for start, stop in cuts:
                part = batch.slice(start, stop - start)
                yield part, [t or "" for t in part.column(column).to_pylist()]
    finally:
        give_back()


MEMOS = "_pairflow_llm_memo"


def process_memo(name: str) -> dict:
    """A dictionary that a Python worker keeps between its tasks."""
    holder = sys.modules.setdefault(MEMOS, types.ModuleType(MEMOS))
    return holder.__dict__.setdefault(f"memo {name}", {})


def drop_memos(but: str | None) -> None:
    """Forget the memos of all operators but one."""
    held = vars(sys.modules.get(MEMOS, types.ModuleType(MEMOS)))
    for name in [n for n in held if n.startswith("memo ") and n != f"memo {but}"]:
        del held[name]


def logistic_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None,
                 l2: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Newton steps of ridge logistic regression; the last weight is the bias."""
    x1 = np.column_stack([x, np.ones(len(x))])
    weight = np.ones(len(y)) if weight is None else weight
    w = np.zeros(x1.shape[1])
    reg = np.full(len(w), l2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -35, 35)))
        grad = x1.T @ (weight * (p - y)) + reg * w
        hess = (x1 * (weight * p * (1 - p))[:, None]).T @ x1 + np.diag(reg + 1e-9)
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))
