"""Near-duplicate groups by ProbMinHash.

A text is the weighted set of its five-word shingles; one that occurs c times
weighs 1 + ln(c), so that a repeated line counts more than once but does not
make texts alike that share nothing else. Each shingle is a Poisson process of
rate equal to its weight: its points arrive after exponential
steps, drawn from a generator seeded with the shingle, and every point falls
on a random register. A register keeps the shingle of its earliest point, so
two texts agree on a register with the probability Jaccard similarity of
their weighted shingles. A process stops as soon as its next point comes later
than the latest register, which few processes reach, so a text of n shingles
costs about n + m*ln(m) points for m registers.

Registers are cut into bands; texts that share a band are candidates:

1. Every text of a bucket is paired with the bucket's least and greatest
   text, and the pairs are verified on the exact weighted shingles. Verified
   pairs are joined into components.
2. In buckets that still hold several components, texts of different
   components meet in tiles of bounded size. A tile holds up to 256 hashes of
   each text's shingles: the whole set of most texts, whose similarity it
   knows exactly and of whose links it returns a spanning forest; the least
   hashes of longer ones, of which it returns the pairs that can reach the
   similarity (within four standard errors) for exact verification. Texts
   with weights other than 1 are judged by their registers in the same way.

So a group of any size costs a few rows per text, and no pair that shares a
band is lost. At similarity 0.8 a pair misses all bands with probability 3e-6.

Texts with the same words in the same order are one node, whatever their
number. Components come from alternating star contraction over written
tables; nothing but counts reaches the driver.

Defined cases: null text counts as empty; texts without words are copies of
each other; a text of one to four words is one shingle; repeated rows get the
same class each; a null doc_id is never a class id unless its class has no
other (then the class id is null); an empty table gives no row. Only doc_id
and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, sub_batches, text_slices

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
TILE = 512             # texts of a bucket that one tile compares with another 512
LEAST = 256            # hashes of a text that a tile holds
CACHED_WORDS = 150_000
GOLD = np.uint64(0x9E3779B97F4A7C15)


# --- shingles and signatures -------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def weighted_shingles(texts: list[list[str]], memo: dict):
    """(shingle hash, text number, weight) of all texts, sorted by text."""
    lengths = np.array([len(w) for w in texts], dtype=np.int64)
    hashes = np.empty(int(lengths.sum()), dtype=np.uint64)
    at = 0
    for words in texts:
        out = []
        for w in words:
            h = memo.get(w)
            if h is None:
                if len(memo) >= CACHED_WORDS:
                    memo.clear()
                h = memo[w] = xxhash.xxh64_intdigest(w)
            out.append(h)
        hashes[at:at + len(out)] = out
        at += len(out)
    n = np.maximum(lengths - SHINGLE + 1, (lengths > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(texts)), n)
    first = np.cumsum(lengths) - lengths
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    stop = np.repeat(first + lengths, n)
    key = np.zeros(len(doc), dtype=np.uint64)
    for i in range(SHINGLE):
        inside = start + i < stop
        word = np.zeros(len(doc), dtype=np.uint64)
        word[inside] = hashes[start[inside] + i]
        key = _mix(key * GOLD + word + np.uint64(i))
    order = np.lexsort((key, doc))
    key, doc = key[order], doc[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    return key[begin], doc[begin], 1 + np.log(np.diff(np.append(begin, len(key))))


def stream(step: int) -> np.uint64:
    """What is added to an element's hash for its step-th draw."""
    return np.uint64((step + 1) * int(GOLD) & 0xFFFFFFFFFFFFFFFF)


def prob_minhash(key: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int,
                 registers: int = REGISTERS) -> np.ndarray:
    """Register contents (shingle hashes) of each text; 0 without shingles."""
    earliest = np.full(n_docs * registers, np.inf)
    content = np.zeros(n_docs * registers, dtype=np.uint64)
    latest = np.full(n_docs, np.inf)
    time = np.zeros(len(key))
    step = 0
    while len(key):
        draw = _mix(key + stream(step))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53) / weight
        go = time < latest[doc]  # a process behind the latest register has ended
        key, doc, weight, time, draw = key[go], doc[go], weight[go], time[go], draw[go]
        if not len(key):
            break
        register = ((_mix(draw) >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32))
        slot = doc * registers + register.astype(np.int64)
        np.minimum.at(earliest, slot, time)
        won = earliest[slot] == time
        content[slot[won]] = key[won]
        latest = earliest.reshape(n_docs, registers).max(1)
        step += 1
    return content.reshape(n_docs, registers)


def bands_of(content: np.ndarray) -> np.ndarray:
    parts = content.reshape(len(content), BANDS, ROWS)
    h = np.arange(BANDS, dtype=np.uint64)[None, :] * GOLD  # arrays wrap around
    for i in range(ROWS):
        h = _mix(h * GOLD + parts[:, :, i])
    return h.astype(np.int64)


def sketch_of(content: np.ndarray) -> np.ndarray:
    return (_mix(content) >> np.uint64(56)).astype(np.uint8)


def probability_jaccard(a, wa, b, wb) -> float:
    """Exact probability Jaccard of two sorted weighted sets: over the common
    elements i, the sum of 1 / sum_j max(a_j / a_i, b_j / b_i)."""
    if not len(a) and not len(b):
        return 1.0
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    x, y = wa[ia].astype(float), wb[ib].astype(float)
    ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    # j with a larger ratio count by a_j / a_i, the others by b_j / b_i
    above = np.searchsorted(ratio, ratio, side="right")
    from_a = np.append(np.cumsum(x[::-1])[::-1], 0)[above] + only_a
    from_b = np.append(0, np.cumsum(y))[above] + only_b
    return float(np.sum(1 / (from_a / x + from_b / y)))


# --- Spark side ---------------------------------------------------------------------

def text_key():
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def _sign(batches):
    memo: dict = {}
    for part, texts in text_slices(batches, rows=200, chars=2_000_000):
        texts = [words_of(t) for t in texts]
        key, doc, weight = weighted_shingles(texts, memo)
        content = prob_minhash(key, doc, weight, len(texts))
        bands, sketch = bands_of(content), sketch_of(content)
        yield pa.RecordBatch.from_arrays([
            part.column("doc_id"), part.column("text_key"),
            pa.array([hashlib.md5(" ".join(w).encode("utf-8", "replace")).digest() for w in texts],
                     pa.binary()),
            pa.array([b if w else [] for b, w in zip(bands, texts)], pa.list_(pa.int64())),
            pa.array([s.tobytes() for s in sketch], pa.binary())],
            names=["doc_id", "text_key", "node", "bands", "sketch"])


def least_hashes(key: np.ndarray) -> bytes:
    """The least 32-bit shingle hashes, sorted; all of them if they fit."""
    return np.unique((_mix(key) >> np.uint64(32)).astype(np.uint32))[:LEAST].tobytes()


def _shingle_rows(frames):
    memo: dict = {}
    for frame in sub_batches(frames, "text", rows=200, chars=2_000_000):
        texts = [words_of(t) for t in frame["text"]]
        key, doc, weight = weighted_shingles(texts, memo)
        cuts = np.searchsorted(doc, np.arange(1, len(texts)))
        keys, weights = np.split(key, cuts), np.split(weight, cuts)
        # weights that are all 1 are left out
        yield pd.DataFrame({
            "node": frame["node"].to_numpy(), "keys": [k.astype(np.int64) for k in keys],
            "weights": [[] if (w == 1).all() else w for w in weights],
            "least": [least_hashes(k) for k in keys], "n": [len(k) for k in keys]})


def _verify(similarity):
    def lists(column):
        """Offsets and values of a list column, without a copy."""
        return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)

    def run(batches):
        for batch in batches:
            (ao, ka), (bo, kb) = lists(batch.column("ka")), lists(batch.column("kb"))
            (xo, wa), (yo, wb) = lists(batch.column("wa")), lists(batch.column("wb"))
            ka, kb = ka.view(np.uint64), kb.view(np.uint64)
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                a, b = ka[ao[i]:ao[i + 1]], kb[bo[i]:bo[i + 1]]
                x, y = wa[xo[i]:xo[i + 1]], wb[yo[i]:yo[i + 1]]
                keep[i] = probability_jaccard(a, x if len(x) else np.ones(len(a)),
                                              b, y if len(y) else np.ones(len(b))) >= similarity
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def verified(pairs: DataFrame, shingles: DataFrame, similarity: float) -> DataFrame:
    left = shingles.select(F.col("node").alias("a"), F.col("keys").alias("ka"),
                           F.col("weights").alias("wa"))
    right = shingles.select(F.col("node").alias("b"), F.col("keys").alias("kb"),
                            F.col("weights").alias("wb"))
    both = pairs.join(left, "a").join(right, "b")
    return both.mapInArrow(_verify(similarity), "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b); the root is the least
    node of the component. Alternates large-star and small-star until the
    edges stay, each round over a written table."""
    def star(e, large):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn(
            "m", F.least("u", "m"))
        linked = both.join(least, "u")
        if large:
            out = linked.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
                least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def directed(e):
        return e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))

    now, seen = staged(directed(edges).where("a <> b").distinct(), "edges"), None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(mark) == seen or mark[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = tuple(mark)
        now = staged(star(directed(star(now, True)), False), "edges")


def set_similarity(at: int, flat, first, size, n):
    """Jaccard similarity of text `at` of a tile to all its texts, from their
    least hashes, and the standard error of each (0: exact).

    Below the smaller of two texts' greatest kept hashes both sets are
    complete, so the similarity there is a sample of the whole."""
    mine = flat[first[at]:first[at] + size[at]]
    cut = n > size  # texts of which only the least hashes are here
    last = np.where(cut, flat[first + size - 1], np.uint32(0xFFFFFFFF))
    inside = np.isin(flat, mine, assume_unique=False)
    common = np.add.reduceat(inside.astype(np.int64), first)
    top = np.minimum(last, last[at])
    a = np.searchsorted(mine, top, side="right")
    owner = np.repeat(np.arange(len(first)), size)
    b = np.bincount(owner, weights=flat <= top[owner], minlength=len(first))
    union = np.maximum(a + b - common, 1)
    value = common / union
    whole = np.maximum(n + n[at] - value * (n + n[at]) / (1 + value), union)
    error = np.sqrt(0.25 / union * np.maximum(0, 1 - union / whole))
    return value, np.where(cut | cut[at], error, 0.0)


def tile_links(members, same_block: bool, similarity: float):
    """(pairs, sure) of one tile: a spanning forest of its exactly known links
    between components, and the pairs to verify."""
    rows = [i for i, m in enumerate(members) if m["n"]]
    members = [members[i] for i in rows]
    if len(members) < 2:
        return [], []
    kept = [np.frombuffer(bytes(m["least"]), np.uint32) for m in members]
    flat, size = np.concatenate(kept), np.array([len(k) for k in kept])
    first, n = np.cumsum(size) - size, np.array([m["n"] for m in members])
    sketch = np.frombuffer(b"".join(bytes(m["sketch"]) for m in members),
                           np.uint8).reshape(len(members), REGISTERS)
    block = np.array([m["block"] for m in members])
    loose = np.array([m["loose"] for m in members])
    plain = np.array([not m["weighted"] for m in members])
    root = pd.factorize(np.array([bytes(m["root"]) for m in members], dtype=object))[0]
    margin = similarity - 4 * np.sqrt(similarity * (1 - similarity) / REGISTERS)
    pairs, sure, open_pairs = [], [], []
    for x in np.flatnonzero(loose):
        fit = (root != root[x]) & (~loose | (np.arange(len(members)) > x))
        if not same_block:
            fit &= block != block[x]
        if not fit.any():
            continue
        value, error = set_similarity(x, flat, first, size, n)
        exact = plain & plain[x] & (error == 0)
        for y in np.flatnonzero(fit & exact & (value >= similarity)):
            if root[y] != root[x]:
                pairs.append((x, y))
                sure.append(True)
                root[root == root[y]] = root[x]
        agree = (sketch == sketch[x]).mean(1) >= margin
        near = np.where(plain & plain[x], value + 4 * error >= similarity, agree)
        open_pairs += [(x, y) for y in np.flatnonzero(fit & ~exact & near)]
    open_pairs = [(x, y) for x, y in open_pairs if root[x] != root[y]]
    node = [bytes(m["node"]) for m in members]
    ends = [(max(node[x], node[y]), min(node[x], node[y])) for x, y in pairs + open_pairs]
    return ends, sure + [False] * len(open_pairs)


def _tile(similarity):
    def run(batches):
        for batch in batches:
            ends, sure = [], []
            i, j = batch.column("i").to_pylist(), batch.column("j").to_pylist()
            for k in range(batch.num_rows):  # one tile at a time in Python's memory
                members = batch.column("members").slice(k, 1).to_pylist()[0]
                e, s = tile_links(members, i[k] == j[k], similarity)
                ends += e
                sure += s
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[0] for e in ends], pa.binary()),
                 pa.array([e[1] for e in ends], pa.binary()), pa.array(sure, pa.bool_())],
                names=["a", "b", "sure"])
    return run


def classes(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_key, class_id, kept) of every row: the least doc_id of its
    near-duplicate class, and whether the row's text is the one that stays."""
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                             text_key().alias("text_key"))
    kind = documents.schema["doc_id"].dataType.simpleString()
    signed = staged(texts.mapInArrow(
        _sign, f"doc_id {kind}, text_key binary, node binary, bands array<long>, sketch binary"),
        "signatures")

    nodes = staged(signed.groupBy("node").agg(
        F.min(F.struct("text_key", "doc_id")).alias("pick"), F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch")), "nodes")
    banded = nodes.select("node", F.explode("bands").alias("band"))
    reps = (banded.groupBy("band").agg(F.min("node").alias("rep"), F.max("node").alias("high"),
                                       F.count(F.lit(1)).alias("n")).where("n > 1"))
    members = staged(banded.join(reps, "band"), "members")
    first = (members.select(F.col("node").alias("a"), F.explode(F.array("rep", "high")).alias("b"))
             .where("a <> b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    # shingles of the candidates only, from one text of each
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select(
        "node", F.col("pick.text_key").alias("key"), F.col("pick.doc_id").alias("id"))
    shingles = staged(
        texts.join(wanted, (F.col("text_key") == F.col("key"))
                   & F.col("doc_id").eqNullSafe(F.col("id")))
        .dropDuplicates(["node"]).select("node", "text")
        .mapInPandas(_shingle_rows, "node binary, keys array<long>, weights array<double>, "
                     "least binary, n int"),
        "shingles")
    edges = staged(verified(first, shingles, similarity), "verified")
    roots = components(edges)

    # buckets that still hold several components; two texts were settled above
    def root_of(df, node, name):
        pair = roots.select(F.col("node").alias(node), F.col("root").alias(name))
        return df.join(pair, node, "left").withColumn(name, F.coalesce(name, node))

    rooted = staged(root_of(root_of(members.where("n > 2").drop("high"), "node", "root"),
                            "rep", "rep_root")
                    .withColumn("loose", F.col("root") != F.col("rep_root")), "rooted")
    open_bands = rooted.where("loose").select("band").distinct()
    blocks = F.ceil(F.col("n") / TILE)
    about = nodes.select("node", "sketch").join(
        shingles.select("node", "least", F.col("n").alias("size"),
                        (F.size("weights") > 0).alias("weighted")), "node")
    open_members = (rooted.join(open_bands, "band", "left_semi").join(about, "node")
                    .withColumn("block", F.pmod(F.xxhash64("node"), blocks)))
    tiles = (open_members
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
             .withColumn("i", F.least("block", "other"))
             .withColumn("j", F.greatest("block", "other"))
             .groupBy("band", "i", "j")
             .agg(F.collect_list(F.struct("node", "root", "loose", "sketch", "block", "least",
                                          F.col("size").alias("n"), "weighted"))
                  .alias("members")))  # about two blocks of TILE texts
    second = staged(tiles.mapInArrow(_tile(similarity), "a binary, b binary, sure boolean")
                    .distinct(), "second")
    tested = first.select("a", "b")
    unsure = second.where("NOT sure").select("a", "b").join(tested, ["a", "b"], "left_anti")
    more = staged(verified(unsure, shingles, similarity)
                  .unionByName(second.where("sure").select("a", "b")), "verified")
    if more.take(1):
        roots = components(edges.unionByName(more))

    grouped = staged(root_of(signed.select("doc_id", "text_key", "node"), "node", "root"), "grouped")
    least = grouped.groupBy("root").agg(
        F.min("doc_id").alias("class_id"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_key")).alias("stays"))
    return grouped.join(least, "root").select(
        "doc_id", "text_key", "class_id",
        (F.col("doc_id").eqNullSafe(F.col("stays.doc_id"))
         & (F.col("text_key") == F.col("stays.text_key"))).alias("kept"))


def keep_one(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, with its own columns: the one with the
    least id, once even where its row is repeated."""
    keep = (classes(documents, similarity).where("kept")
            .select(F.col("doc_id").alias("keep_id"), F.col("text_key").alias("keep_key"))
            .distinct())
    return (documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns])
                             .alias("row"),
                             F.col("doc_id").alias("id"), text_key().alias("key"))
            .join(keep, F.col("id").eqNullSafe(F.col("keep_id"))
                  & (F.col("key") == F.col("keep_key")), "left_semi")
            .dropDuplicates(["id", "key"]).select("row.*"))
