"""Inputs that the tests of the training-data operators share."""

from __future__ import annotations

import random

from pyspark.sql import types as T

BIG = 2**60 + 1  # an id that no double holds

# extra columns with names that the operators use inside
CLASHES = ["score", "node", "size", "range", "rank", "label", "bucket", "key", "k1", "part",
           "quality_score", "text_key", "row", "id"]

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary):03d}ord" for _ in range(n)]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(words(rng, n)) + "."


def documents(spark, texts, clash: bool = False):
    """A documents table of (doc_id, text) pairs, on request with clashes."""
    rows = [(i, t, "en", f"s{k % 3}", None if t is None else len(t))
            for k, (i, t) in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    if clash:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])
    return df


def odd_texts():
    """Nulls, empty, tiny, very long, repeated and tied rows."""
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (BIG, prose(1, 300)),
            (BIG + 1, prose(1, 300)), (None, prose(2, 40)), (None, None), (9, prose(3, 30_000)),
            (10, prose(4, 60)), (10, prose(4, 60)), (11, "é" * 50 + " 😀 " * 20)]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
