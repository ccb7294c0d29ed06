from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException

from pairflow.llm import centroids as cc

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, rounds, dimension):
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
            if v is not None and len(v) == dimension
            and all(c is not None and math.isfinite(c) for c in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])  # noqa
    centroid = [v for _, v in sorted(kept, key=key)[:k]]

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroid))
    for _ in range(rounds):
        where = [place(v)[1] for _, v in kept]
        for j in range(len(centroid)):
            mine = [v for (_, v), w in zip(kept, where) if w == j]
            if mine:
                centroid[j] = [sum(c) // len(mine) for c in zip(*mine)]
    return sorted(((i is None, i or 0), j, d) for (i, v) in kept for d, j in [place(v)]), centroid


def run(spark, rows, k=5, rounds=3, dimension=4, block=8):
    df = spark.createDataFrame(rows, SCHEMA)
    out, centroid = cc.cluster(df, k=k, rounds=rounds, dimension=dimension, rows_per_block=block)
    return sorted(((r["vec_id"] is None, r["vec_id"] or 0), r["cluster"], r["distance"])
                  for r in out.collect()), centroid.tolist()


def cloud(seed, n, dimension):
    rng = random.Random(seed)
    return [(i, [rng.gauss(rng.choice([-1, 0, 2]), 0.3) for _ in range(dimension)])
            for i in range(n)]


def test_clusters_equal_brute_force(spark):
    rows = cloud(1, 300, 4)
    assert run(spark, rows) == brute(rows, 5, 3, 4)


def test_clusters_equal_brute_force_with_ties_and_copies(spark):
    rows = [(i, [float(i % 3), 0.0, 1.0, -1.0]) for i in range(60)] + [(7, [0.0] * 4)] * 90
    assert run(spark, rows) == brute(rows, 5, 3, 4)


def test_odd_vectors(spark):
    rows = cloud(2, 40, 4) + [(100, None), (101, [1.0]), (102, [1.0, None, 0.0, 0.0]),
                              (103, [float("nan")] * 4), (104, [float("inf"), 0.0, 0.0, 0.0]),
                              (None, [0.5] * 4), (None, [0.25] * 4), (105, [0.0] * 4), (106, [])]
    got, centroid = run(spark, rows)
    assert (got, centroid) == brute(rows, 5, 3, 4)
    assert len(got) == 43


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = cloud(3, 3, 4)
    assert run(spark, rows) == brute(rows, 5, 3, 4)
    assert run(spark, []) == ([], [])
    assert cc.clusters_digest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_too_large_components_are_refused(spark):
    with pytest.raises(PySparkException):
        run(spark, [(1, [1e9, 0.0, 0.0, 0.0])])


def test_bounds_never_lose_a_nearest_centroid():
    rng = np.random.default_rng(4)
    pruned = 0
    for _ in range(200):
        d, k = int(rng.integers(1, 9)), int(rng.integers(1, 20))
        box = rng.integers(-20, 21, (int(rng.integers(1, 30)), d))
        box = (box // int(rng.integers(1, 12))) + rng.integers(-15, 16, d)
        centroid = rng.integers(-20, 21, (k, d))
        some = cc.candidates(box.min(0), box.max(0), centroid)
        distance = ((box[:, None, :] - centroid[None]) ** 2).sum(2)
        for row in distance:  # all that tie for the least
            assert set(np.flatnonzero(row == row.min())) <= set(some)
        label, best = cc.nearest(box, box.min(0), box.max(0), centroid)
        assert (label == distance.argmin(1)).all() and (best == distance.min(1)).all()
        pruned += k - len(some)
    assert pruned > 500


@pytest.mark.parametrize("n,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(n, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n), -1).reshape(-1, n)
    place = cc.hilbert_position(cells, bits)
    assert sorted(place) == list(range(len(cells)))
    path = cells[np.argsort(place)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_blocks_hold_every_row_and_true_boxes(spark):
    rows = cloud(5, 100, 4) + [(1000 + i, [0.1] * 4) for i in range(60)]
    vectors = cc.usable(spark.createDataFrame(rows, SCHEMA), 4)
    blocks = cc.blocks_of(vectors, 4, rows_per_block=16).collect()
    ids = [i for b in blocks for i in b["ids"]]
    assert sorted(ids) == sorted(i for i, _ in rows)
    for b in blocks:
        v = np.frombuffer(b["vectors"], dtype=np.int32).reshape(-1, 4)
        assert len(v) <= 16 and len(v) == len(b["ids"])
        assert v.min(0).tolist() == b["low"] and v.max(0).tolist() == b["high"]


def test_separated_clusters_prune_most_comparisons(spark):
    rng = np.random.default_rng(6)
    centre = rng.normal(0, 20, (16, 8))
    rows = [(i, [float(x) for x in centre[i % 16] + rng.normal(0, 0.2, 8)]) for i in range(1600)]
    vectors = cc.usable(spark.createDataFrame(rows, SCHEMA), 8)
    blocks = cc.blocks_of(vectors, 8, rows_per_block=32).collect()
    whole = np.floor(centre * 256).astype(np.int64)
    left = [len(cc.candidates(np.array(b["low"]), np.array(b["high"]), whole)) for b in blocks]
    assert np.mean(left) < 6


def test_clashing_columns(spark):
    df = spark.createDataFrame([(i, v, "own", "own", "own") for i, v in cloud(7, 50, 64)],
                               SCHEMA + ", cluster string, distance string, place string")
    out = cc.clusters_digest(df)
    assert out.count() == 50
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                           "centroid_sha256"]
