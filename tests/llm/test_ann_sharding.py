"""Neighbour search against brute force; sharding against its law."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from pairflow.llm import ann, sharding
from pairflow.llm.common import table

from . import helpers as h

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, every=20):
    out = {}
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    for q in sorted({i for i in ids if i % every == 0}):
        own = x[np.flatnonzero(ids == q)[0]]
        scores = {}
        for i, v in zip(ids, x):
            if i != q:
                scores[i] = max(scores.get(i, -np.inf), float((own * v).sum()))
        out[q] = sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:k]
    return out


def test_recall_and_exact_scores(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = brute(rows, ann.NEAREST)
    got = {}
    for r in ann.search(df).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    hits = total = 0
    for q, best in want.items():
        found = got[q]
        assert sorted(found) == list(range(1, len(best) + 1))
        hits += len({i for i, _ in best} & {i for i, _ in found.values()})
        total += len(best)
        s = [found[k] for k in sorted(found)]
        assert s == sorted(s, key=lambda x: (-x[1], x[0]))
    assert hits / total >= 0.9


def test_clusters_need_few_probes():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(16, 32)) * 4
    x = np.vstack([c + rng.normal(size=(250, 32)) * 0.4 for c in centres])
    router = ann.fit_arrays(x, partitions=16)
    assert router.recall >= 0.95 and router.probes <= 6


def test_cut_is_balanced():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1000, 16))
    label = ann.balanced_cut(ann._nearest(x, x, 10, True), x, 8, rng)
    assert np.bincount(label).max() <= np.ceil(1.05 * 1000 / 8)


def test_odd_vectors_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROWS_PER_BLOCK", 7)
    monkeypatch.setattr(ann, "QUERIES_PER_BLOCK", 3)
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(60)]
    good += [(100 + i, good[20][1]) for i in range(50)]  # one vector, very common
    good += [good[40], good[41]]                         # repeated rows
    odd = [(200, None), (220, [0.0] * 4), (240, [1.0, None, 0.0, 0.0]),
           (260, [float("nan")] * 4), (280, [float("inf"), 0.0, 0.0, 0.0]), (300, [1.0, 2.0]),
           (None, [1.0] * 4), (320, [])]
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, v, 1) for i, v in good + odd], SCHEMA).withColumns(
        {c: F.lit(1) for c in ("part", "is_query", "score", "rank", "query_id")})
    got = {}
    for r in ann.search(df).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute(good, ann.NEAREST)
    assert got.keys() == want.keys()
    for q in want:
        assert [(i, s) for _, i, s in sorted(got[q])] == want[q]
    assert ann.search(spark.createDataFrame([], SCHEMA)).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1)], SCHEMA)
    assert [tuple(r) for r in ann.search(few).collect()] == [(0, 1, 1, 0.5)]


def check_shards(spark, rows, clash=False):
    docs = h.documents(spark, rows, clash)
    got = sharding.shards_digest(docs).collect()
    size = lambda t: len((t or "").encode()) + 8
    crc = lambda t: zlib.crc32((t or "").encode())
    key = str
    assert sorted([(r["doc_id"], r["size"], r["text_crc32"]) for r in got], key=key) == sorted(
        [(i, size(t), crc(t)) for i, t in rows], key=key)
    sums, slots = [0] * sharding.SHARDS, [[] for _ in range(sharding.SHARDS)]
    for r in got:
        sums[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    most = max((size(t) for _, t in rows), default=0)
    assert all(abs(s - sum(sums) / len(sums)) <= most for s in sums)
    assert {(r["law"], r["grown_shard"]) for r in got} <= {("bytes", None)}


def test_shards_near_equal(spark):
    rows = [(i, h.prose(i % 70, 20 + i % 90)) for i in range(600)]
    check_shards(spark, rows, clash=True)


def test_shards_with_one_hot_text(spark):
    check_shards(spark, [(i, h.prose(0, 50)) for i in range(300)] + [(1000, h.prose(1, 9))])


def test_shards_of_odd_rows(spark):
    check_shards(spark, h.odd_texts())
    assert sharding.shards_digest(h.empty(spark)).count() == 0


def test_shards_few_ranges(spark):
    """The result does not depend on the number of sampled ranges."""
    docs = h.documents(spark, [(i, h.prose(i, 30)) for i in range(200)])
    a = {tuple(r) for r in sharding.shard(docs, max_ranges=24).collect()}
    b = {tuple(r) for r in sharding.shard(docs, max_ranges=96).collect()}
    assert a == b


def test_boundaries_cut_a_range_by_binary_search(spark):
    cuts = [(-5, 3), (-5, 9), (0, 0), (7, 1)]
    rows = [(k1, k2) for k1 in (-9, -5, 0, 7, 8) for k2 in (0, 1, 3, 8, 9)]
    df = spark.createDataFrame(rows, "k1 long, k2 long")
    got = {(r["k1"], r["k2"]): r["x"] for r in df.select(
        "k1", "k2", sharding.range_of(cuts).alias("x")).collect()}
    assert got == {k: sum(c <= k for c in cuts) for k in rows}
    assert {r[0] for r in df.select(sharding.range_of([])).collect()} == {0}


def test_shards_of_repeated_rows_and_text_ids(spark):
    """A third of all rows are one row; ids may be text."""
    rows = [(7, "same text")] * 200 + [(i, h.prose(i, 8)) for i in range(400)]
    check_shards(spark, rows)
    df = h.documents(spark, rows)
    # every row has a key of its own, so any group can be cut
    assert sharding.keyed(df).select(*sharding.KEY).distinct().count() == 600
    named = df.withColumn("doc_id", F.concat(F.lit("a"), F.col("doc_id").cast("string")))
    out = sharding.shards_digest(named)
    assert out.select("shard", "slot").distinct().count() == 600
    assert out.where("doc_id = 'a7'").count() == 201
