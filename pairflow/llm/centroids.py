"""Centroid clustering over space-filling-curve zone maps.

Vectors of exactly ``dimension`` finite components become integer vectors
floor(256 x). They are ordered along a Hilbert curve through their most
spread dimensions and cut into blocks of about 256 neighbours; each block is
stored once with its zone map, the least and greatest value of every
dimension. A round reads the blocks. From a block's box alone follow the
centroids that can be nearest to any vector in it:

* by distance bounds: a centroid whose least distance to the box exceeds the
  least of all greatest distances is out;
* against that best centroid z: over the box, |x - c|^2 - |x - z|^2 is linear
  in x and least at one corner; if it is positive there, c is out.

The vectors of the block are then compared with the candidates exactly, in
integers. Both tests are exact and keep every tie, so the result is that of
comparing with all centroids.

A round sends count and component sums of each centroid from every task, and
brings one row per centroid to the driver. Blocks are cut from ranges of the
curve; equal vectors are told apart by their place in the input, so however
many copies a vector has, they are dealt over as many blocks as they fill.

Defined cases: a vector takes no part if it is null, has another number of
components, or holds a null or non-finite one; with a null id it is assigned
but starts no centroid unless ids run out; equal ids take their place by the
vector. With fewer vectors than centroids there are as many centroids as
vectors; an empty table gives no row. Components of 2^27 or more in size
(|x| >= 524,288) would not fit the squared distances into a long: such a table
is refused with an error. Only the id and the vector are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

DIMENSION = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
SEED = 2
ROWS_PER_BLOCK = 256
ROWS_PER_RANGE = 200_000
CURVE_DIMENSIONS, CURVE_BITS = 9, 7  # of a curve position that fits a long
LIMIT = 2**27
SLICE_ROWS = 4_096


def usable(embeddings: DataFrame, dimension: int = DIMENSION, id_column: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """(vec_id, v) of the vectors that take part, v = floor(256 x)."""
    inf = F.lit(float("inf"))
    rows = embeddings.select(F.col(id_column).alias("vec_id"),
                             F.col(vector).cast("array<double>").alias("x"))
    kept = rows.where(F.col("x").isNotNull() & (F.size("x") == dimension)
                      & F.forall("x", lambda c: F.coalesce((F.abs(c) < inf) & ~F.isnan(c),
                                                           F.lit(False))))

    def whole(c: Column) -> Column:
        n = F.floor(c * F.lit(float(SCALE)))
        far = F.abs(c) >= F.lit(float(LIMIT // SCALE))
        return F.when(far, F.raise_error(F.lit("a component of 2^27 or more"))).otherwise(n) \
            .cast("int")
    return kept.select("vec_id", F.transform("x", whole).alias("v"))


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """Rows of a list column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dimension)


def spread(vectors: DataFrame, dimension: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Least and greatest value of each dimension, its variance, and the
    number of vectors: one row per task, added up on the executors."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, None, None
        s, s2 = np.zeros(dimension), np.zeros(dimension)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column(0), dimension).astype(float)
            n += len(v)
            low = v.min(0) if low is None else np.minimum(low, v.min(0))
            high = v.max(0) if high is None else np.maximum(high, v.max(0))
            s, s2 = s + v.sum(0), s2 + (v * v).sum(0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dimension), pa.int32()), pa.array([n] * dimension, pa.int64()),
                 *[pa.array(a, pa.float64()) for a in (low, high, s, s2)]],
                names=["d", "n", "low", "high", "s", "s2"])

    rows = (vectors.select("v")
            .mapInArrow(part, "d int, n bigint, low double, high double, s double, s2 double")
            .groupBy("d").agg(F.sum("n").alias("n"), F.min("low").alias("low"),
                              F.max("high").alias("high"), F.sum("s").alias("s"),
                              F.sum("s2").alias("s2")).orderBy("d").collect())
    if not rows:
        zero = np.zeros(dimension)
        return zero, zero, zero, 0
    n, low, high, s, s2 = (np.array([r[c] for r in rows]) for c in ("n", "low", "high", "s", "s2"))
    return low, high, s2 / n - (s / n) ** 2, int(n[0])


def hilbert_position(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cell coordinates on the Hilbert curve, by undoing
    the curve's reflections and rotations bit by bit."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            set_bit = (x[i] & q) != 0
            swap = np.where(set_bit, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(set_bit, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[n - 1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | ((x[i] >> bit) & 1)
    return place


BLOCKS = ("ids array<bigint>, vectors binary, low array<int>, high array<int>")


def blocks_of(vectors: DataFrame, dimension: int = DIMENSION,
              rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Zone-mapped blocks (ids, vectors, low, high) in the curve's order. The
    blocks are to be written before use."""
    low, high, variance, rows = spread(vectors, dimension)
    if not rows:
        return vectors.sparkSession.createDataFrame([], BLOCKS)
    dims = np.argsort(-variance, kind="stable")[:CURVE_DIMENSIONS]
    cells, start = (1 << CURVE_BITS) - 1, low[dims]
    width = np.maximum(high[dims] - start, 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                v = matrix(part.column("v"), dimension)
                cell = np.floor((v[:, dims] - start) / width * cells).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("v"), part.column("row"),
                     pa.array(hilbert_position(cell, CURVE_BITS))],
                    names=["vec_id", "v", "row", "place"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a block is at most rows_per_block neighbours of one batch
        for batch in batches:
            for at in range(0, batch.num_rows, rows_per_block):
                part = batch.slice(at, rows_per_block)
                v = np.ascontiguousarray(matrix(part.column("v"), dimension), dtype=np.int32)
                listed = pa.array([0, part.num_rows], pa.int32())
                box = pa.array([0, dimension], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(listed, part.column("vec_id")),
                     pa.array([v.tobytes()], pa.binary()),
                     pa.ListArray.from_arrays(box, pa.array(v.min(0), pa.int32())),
                     pa.ListArray.from_arrays(box, pa.array(v.max(0), pa.int32()))],
                    names=["ids", "vectors", "low", "high"])

    ordered = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "v",
                             F.monotonically_increasing_id().alias("row"))
    placed = ordered.mapInArrow(place, "vec_id bigint, v array<int>, row bigint, place bigint")
    ranges = max(1, -(-rows // ROWS_PER_RANGE))
    return (placed.repartitionByRange(ranges, "place", "row")
            .sortWithinPartitions("place", "row").select("vec_id", "v").mapInArrow(cut, BLOCKS))


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Ascending numbers of the centroids that may be nearest to a vector of
    the box, ties included."""
    low, high = low.astype(np.int64), high.astype(np.int64)
    outside = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    far = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    least, most = (outside ** 2).sum(1), (far ** 2).sum(1)
    best = int(np.argmin(most))
    near = np.flatnonzero(least <= most[best])
    c, z = centroids[near], centroids[best]
    corner = np.where(c > z, high, low)
    gap = ((corner - c) ** 2 - (corner - z) ** 2).sum(1)
    return near[gap <= 0]


def nearest(vectors: np.ndarray, low: np.ndarray, high: np.ndarray,
            centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (the smaller at a tie) and the squared
    distance, for a block."""
    some = candidates(low, high, centroids)
    x, best, label = vectors.astype(np.int64), None, None
    for k in some:
        d = ((x - centroids[k]) ** 2).sum(1)
        if best is None:
            best, label = d, np.full(len(x), k, dtype=np.int32)
        else:
            closer = d < best
            best, label = np.where(closer, d, best), np.where(closer, np.int32(k), label)
    return label, best


def _blocks(batch: pa.RecordBatch, dimension: int):
    for ids, data, low, high in zip(*(batch.column(c) for c in ("ids", "vectors", "low", "high"))):
        yield (ids.values, np.frombuffer(data.as_py(), dtype=np.int32).reshape(-1, dimension),
               low.values.to_numpy(), high.values.to_numpy())


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors with the smallest sha256 of 'seed:vec_id'."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = (vectors.select(key.alias("key"), "v").orderBy(F.asc_nulls_last("key"), "v")
            .limit(k).collect())  # k rows, a parameter
    return np.array([r["v"] for r in rows], dtype=np.int64)


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: componentwise floor of the exact means;
    a centroid without vectors stays."""
    dimension = centroids.shape[1]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids), dtype=np.int64)
        total = np.zeros(centroids.shape, dtype=np.int64)
        for batch in batches:
            for _, v, low, high in _blocks(batch, dimension):
                label, _ = nearest(v, low, high, centroids)
                count += np.bincount(label, minlength=len(centroids))
                for k in np.unique(label):
                    total[k] += v[label == k].sum(0, dtype=np.int64)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(count[some]),
             pa.array(list(total[some]), pa.list_(pa.int64()))], names=["cluster", "n", "s"])

    sums = (blocks.mapInArrow(part, "cluster int, n bigint, s array<bigint>")
            .groupBy("cluster")
            .agg(F.sum("n").alias("n"),
                 *[F.sum(F.col("s")[d].cast("decimal(30,0)")).alias(f"s{d}")
                   for d in range(dimension)]).collect())  # a row per centroid
    out = centroids.copy()
    for r in sums:
        out[r["cluster"]] = [int(r[f"s{d}"]) // r["n"] for d in range(dimension)]
    return out


def assigned(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance)."""
    dimension = centroids.shape[1]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, v, low, high in _blocks(batch, dimension):
                label, distance = nearest(v, low, high, centroids)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(label, pa.int32()), pa.array(distance, pa.int64())],
                    names=["vec_id", "cluster", "distance"])

    return blocks.mapInArrow(part, "vec_id bigint, cluster int, distance bigint")


def cluster(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED,
            dimension: int = DIMENSION, id_column: str = "vec_id", vector: str = "embedding",
            rows_per_block: int = ROWS_PER_BLOCK) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector, and the final centroids."""
    vectors = usable(embeddings, dimension, id_column, vector)
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        spark = embeddings.sparkSession
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), centroids
    blocks = staged(blocks_of(vectors, dimension, rows_per_block), "zone-blocks")
    for _ in range(rounds):
        centroids = moved(blocks, centroids)
    return staged(assigned(blocks, centroids), "assigned"), centroids


def clusters_digest(embeddings: DataFrame) -> DataFrame:
    """With each cluster's inertia, that of all, and the centroid's checksum."""
    rows, centroids = cluster(embeddings)
    inertia = {r["cluster"]: r["d"] for r in rows.groupBy("cluster")
               .agg(F.sum("distance").alias("d")).collect()}  # a row per centroid
    sha = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    table = rows.sparkSession.createDataFrame(
        [(c, d, sum(inertia.values()), sha[c]) for c, d in sorted(inertia.items())],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(table), "cluster").select(  # at most k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    """The rounds written out, each comparing every vector with every
    centroid."""
    ctes = [f"""
x AS (SELECT row_number() OVER () AS row, vec_id,
             list_transform(embedding, lambda c: CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT))
               AS v
      FROM embeddings
      WHERE len(embedding) = {DIMENSION}
        AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = {DIMENSION})""",
            f"""
c0 AS (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST, v) - 1 AS k, v
       FROM x QUALIFY k < {CENTROIDS})"""]
    for i in range(ROUNDS + 1):
        ctes.append(f"""
a{i} AS MATERIALIZED (
  SELECT row, vec_id, x.v, c.k, c.v AS centroid,
         list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))
           :: BIGINT AS distance
  FROM x, c{i} c
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, c.k) = 1)""")
        if i < ROUNDS:
            ctes.append(f"""
s{i} AS (SELECT k, d, sum(e) :: BIGINT AS s, count(*) AS n
         FROM (SELECT k, unnest(v) AS e, unnest(range({DIMENSION})) AS d FROM a{i}) GROUP BY k, d),
m{i} AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY d) AS v FROM s{i} GROUP BY k),
c{i + 1} AS MATERIALIZED (SELECT c{i}.k, coalesce(m{i}.v, c{i}.v) AS v
                          FROM c{i} LEFT JOIN m{i} USING (k))""")
    return f"""
WITH {','.join(ctes)}
SELECT vec_id, CAST(k AS INTEGER) AS cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(centroid, ',')) AS centroid_sha256
FROM a{ROUNDS}
"""


ORACLE_SQL = _oracle()
