"""Approximate nearest neighbours with learned partitions.

On a bounded sample, the neighbour graph is computed exactly and cut into
balanced partitions: every vertex moves to the partition of most of its
neighbours while no partition grows over its share. A small classifier learns
to predict the partitions of a vector's neighbours. It then places every row
of the table into its most probable partition, and routes each query to
several most probable ones. How many is calibrated on vectors that did not
train, so that the wanted recall is reached also where the data have little
structure. Routed queries and rows meet per partition, large partitions in
blocks of rows and of queries, and are ranked by the exact measure.

Equal vectors are scored once per block and only their smallest ids can be
among the nearest, so a vector that a third of all rows share costs nothing.

Defined cases: a row takes no part if its id or vector is null, or the vector
is zero, holds null or non-finite components or has another than the most
frequent length (the longer one at a tie). Rows of the query's own id are
never its neighbours; a repeated id counts once, with its best score. Ties go
to the smaller id. An empty table gives no row. Only the id and the vector are
read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import hash_fraction, staged

NEAREST = 20
SAMPLE = 8_000        # vectors that train and calibrate, about
PARTITIONS = 32
TARGET_RECALL = 0.95  # on vectors that did not train
ROWS_PER_BLOCK = 20_000
QUERIES_PER_BLOCK = 4_096


@dataclass
class Router:
    scale: float
    layers: list
    probes: int
    recall: float  # measured at calibration

    @property
    def partitions(self) -> int:
        return len(self.layers[1][1])

    def logits(self, x: np.ndarray) -> np.ndarray:
        (w1, b1), (w2, b2) = self.layers
        return np.maximum(x / self.scale @ w1 + b1, 0) @ w2 + b2


def usable(embeddings: DataFrame, id_column: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """(vec_id, embedding) of the rows that take part."""
    inf = F.lit(float("inf"))
    rows = embeddings.select(F.col(id_column).cast("long").alias("vec_id"),
                             F.col(vector).alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: F.coalesce((F.abs(x) < inf) & ~F.isnan(x),
                                                     F.lit(False)))
        & F.exists("embedding", lambda x: x != 0))
    top = (rows.groupBy(F.size("embedding").alias("d")).count()
           .orderBy(F.desc("count"), F.desc("d")).first())
    return rows.where(F.size("embedding") == (top["d"] if top else 0))


def _nearest(x: np.ndarray, y: np.ndarray, k: int, skip_diagonal: bool) -> np.ndarray:
    out = []
    for a in range(0, len(x), 512):
        s = x[a:a + 512] @ y.T
        if skip_diagonal:
            s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out.append(np.argpartition(-s, k - 1, axis=1)[:, :k])
    return np.vstack(out)


def balanced_cut(neighbours: np.ndarray, x: np.ndarray, parts: int, rng) -> np.ndarray:
    """Balanced partition of the neighbour graph by capacity-bound moves."""
    n = len(neighbours)
    capacity = int(np.ceil(1.05 * n / parts))
    adjacency = [[] for _ in range(n)]
    for i, row in enumerate(neighbours):
        for j in row:
            adjacency[i].append(j)
            adjacency[j].append(i)
    # start: nearest of random seeds, best fits first, within capacity
    near = x @ x[rng.choice(n, parts, replace=False)].T
    label, size = np.full(n, -1), np.zeros(parts, dtype=int)
    for i in np.argsort(-near.max(1)):
        for p in np.argsort(-near[i]):
            if size[p] < capacity:
                label[i] = p
                size[p] += 1
                break
    for _ in range(12):
        moved = 0
        for i in rng.permutation(n):
            votes = np.bincount(label[adjacency[i]], minlength=parts)
            votes = np.where((size < capacity) | (np.arange(parts) == label[i]), votes, -1)
            best = int(np.argmax(votes))
            if votes[best] > votes[label[i]]:
                size[label[i]] -= 1
                size[best] += 1
                label[i] = best
                moved += 1
        if moved < n // 200:
            break
    return label


def fit_arrays(x: np.ndarray, partitions: int = PARTITIONS, neighbours: int = 10,
               hidden: int = 96, epochs: int = 60, target: float = TARGET_RECALL,
               seed: int = 3) -> Router:
    """Cut the sample's neighbour graph, train the classifier, calibrate."""
    rng = np.random.default_rng(seed)
    scale = float(np.sqrt((x * x).sum(1).mean() / x.shape[1])) or 1.0
    x = np.unique(x, axis=0)
    rng.shuffle(x)
    partitions = max(1, min(partitions, len(x) // 40))
    if partitions == 1:
        d = x.shape[1]
        return Router(scale, [(np.zeros((d, 1)), np.zeros(1)), (np.zeros((1, 1)), np.zeros(1))],
                      1, 1.0)
    held = x[:max(60, len(x) // 4)]
    train = x[len(held):]
    graph = _nearest(train, train, min(neighbours, len(train) - 1), True)
    label = balanced_cut(graph, train, partitions, rng)
    soft = np.zeros((len(train), partitions))
    for j in range(graph.shape[1]):
        np.add.at(soft, (np.arange(len(train)), label[graph[:, j]]), 1.0)
    np.add.at(soft, (np.arange(len(train)), label), 2.0)
    soft /= soft.sum(1, keepdims=True)
    params = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
              rng.normal(0, np.sqrt(1 / hidden), (hidden, partitions)), np.zeros(partitions)]
    m, v, t = [np.zeros_like(a) for a in params], [np.zeros_like(a) for a in params], 0
    z = train / scale
    for _ in range(epochs):
        for chunk in np.array_split(rng.permutation(len(z)), max(1, len(z) // 256)):
            h = np.maximum(z[chunk] @ params[0] + params[1], 0)
            logit = h @ params[2] + params[3]
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            d = (p - soft[chunk]) / len(chunk)
            back = d @ params[2].T * (h > 0)
            grads = [z[chunk].T @ back, back.sum(0), h.T @ d, d.sum(0)]
            t += 1
            for i, grad in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * grad
                v[i] = 0.999 * v[i] + 0.001 * grad * grad
                params[i] = params[i] - 2e-3 * (m[i] / (1 - 0.9 ** t)) / (
                    np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8) - 1e-5 * params[i]
    router = Router(scale, [(params[0], params[1]), (params[2], params[3])], partitions, 1.0)
    logits = router.logits(held)
    true = _nearest(held, held, min(NEAREST, len(held) - 1), True)
    home = logits.argmax(1)[true]
    order = np.argsort(-logits, axis=1)
    place = np.argsort(order, axis=1)  # rank of each partition for each query
    needed = np.take_along_axis(place, home, 1) + 1
    for probes in range(1, partitions + 1):
        recall = float((needed <= probes).mean())
        if recall >= target:
            break
    router.probes, router.recall = probes, recall
    return router


def fit(rows: DataFrame, sample: int = SAMPLE, partitions: int = PARTITIONS) -> Router | None:
    """Fit on about `sample` of the usable rows."""
    total = rows.count()
    drawn = rows.where(hash_fraction(F.col("vec_id"), sample, total, 31)).toPandas()
    if not len(drawn):
        return None
    return fit_arrays(np.array(drawn["embedding"].tolist(), dtype=np.float64), partitions)


def _route(router: Router, every: int):
    def run(frames):
        for frame in frames:
            x = np.array(frame["embedding"].tolist(), dtype=np.float64)
            logits = router.logits(x)
            yield frame.assign(part=logits.argmax(1), is_query=False)
            asks = frame["vec_id"].to_numpy() % every == 0
            if asks.any():
                order = np.argsort(-logits[asks], axis=1)[:, :router.probes]
                queries = frame[asks]
                for j in range(order.shape[1]):
                    yield queries.assign(part=order[:, j], is_query=True)
    return run


def block_top(rows: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest of one block's rows for each of its queries, exactly."""
    columns = ["query_id", "vec_id", "score"]
    if not len(rows) or not len(queries):
        return pd.DataFrame({c: [] for c in columns}).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})
    x = np.array(rows["embedding"].tolist(), dtype=np.float64)
    code, _ = pd.factorize(np.array([r.tobytes() for r in x], dtype=object))
    same = pd.DataFrame({"code": code, "id": rows["vec_id"].to_numpy()}).drop_duplicates()
    same = same.sort_values(["code", "id"])
    same = same[same.groupby("code").cumcount() <= k]  # more equal vectors cannot rank
    first = pd.Series(np.arange(len(x))).groupby(code).first().to_numpy()
    u, ids = x[first], same["id"].to_numpy()
    sizes = np.bincount(same["code"], minlength=len(u))
    begin = np.cumsum(sizes) - sizes
    q, qid = np.array(queries["embedding"].tolist(), np.float64), queries["vec_id"].to_numpy()
    out, kk = [], min(k + 1, len(u))
    for a in range(0, len(q), 256):
        part = q[a:a + 256]
        s = part @ u.T
        cut = -np.partition(-s, kk - 1, axis=1)[:, kk - 1]
        qi, ui = np.nonzero(s >= (cut - 1e-9 * (1 + np.abs(cut)))[:, None])
        score = (part[qi] * u[ui]).sum(1)
        n = sizes[ui]
        at = np.repeat(begin[ui], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        got = pd.DataFrame({"q": np.repeat(qi, n), "query_id": qid[a + np.repeat(qi, n)],
                            "vec_id": ids[at], "score": np.repeat(score, n)})
        got = got[got["vec_id"] != got["query_id"]]
        got = got.sort_values(["q", "score", "vec_id"], ascending=[True, False, True])
        out.append(got[got.groupby("q").cumcount() < k][columns])
    return pd.concat(out)


def search(embeddings: DataFrame, k: int = NEAREST, every: int = 20,
           router: Router | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query,
    the rows whose id is divisible by `every`."""
    rows = usable(embeddings)
    router = router or fit(rows)
    schema = "query_id long, rank int, vec_id long, score double"
    if router is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    element = rows.schema["embedding"].dataType.simpleString()
    routed = staged(rows.mapInPandas(
        _route(router, every), f"vec_id long, embedding {element}, part int, is_query boolean"),
        "routed")
    sizes = {(r["part"], r["is_query"]): r["count"]
             for r in routed.groupBy("part", "is_query").count().collect()}  # 2 x partitions rows
    parts = range(router.partitions)
    blocks = {True: [1 + sizes.get((p, True), 0) // QUERIES_PER_BLOCK for p in parts],
              False: [1 + sizes.get((p, False), 0) // ROWS_PER_BLOCK for p in parts]}

    def count(of_queries):
        return F.element_at(F.lit(blocks[of_queries]), F.col("part") + 1)

    own = F.xxhash64("vec_id")

    def every_block(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))

    asks = routed.where("is_query").withColumn("qb", F.pmod(own, count(True))).withColumn(
        "rb", every_block(count(False)))
    has = routed.where("NOT is_query").withColumn("rb", F.pmod(own, count(False))).withColumn(
        "qb", every_block(count(True)))

    def cell(frame):
        asked = frame["is_query"].to_numpy(bool)
        return block_top(frame[~asked], frame[asked], k)

    found = (asks.unionByName(has).groupBy("part", "rb", "qb")
             .applyInPandas(cell, "query_id long, vec_id long, score double"))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order).cast("int"))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
