r"""Source divergence audit over term counts.

For each language the vocabulary holds the terms that occur in at least
``min_df`` of its documents; its size is not limited. Each document is a
sparse count vector; the vectors of a (lang, source) group are summed
coordinate by coordinate, as Summarizer sums them (sum and number of
non-zeros), and smoothed integer shares of the sums are compared: every source
with every other one of its language over all kept terms, and every source
with its language term by term.

The vocabulary is a table, not an array on the driver, and is applied to the
group sums instead of to the documents: dropping coordinates and adding
vectors commute, the sums have one row per (lang, source, term) instead of one
per document and term, and nothing whose size grows with the texts has to
be broadcast. A document belongs to one group, so the numbers of non-zeros of
a language's groups add up to its document frequencies.

Pairs are evaluated sparsely. With b the share of a term that a group lacks,

    sum over all V terms |p - q| = V |b - c|
        + sum over the terms of the one  (|p - c| - |b - c|)   [one-sided]
        + sum over the terms of the other (|q - b| - |b - c|)  [one-sided]
        + sum over the terms of both     (|p - q| - |p - c| - |q - b| + |b - c|)

The one-sided sums come from histograms of p, the last one from blocks of
about 2,000 terms and tiles of about 512 sources, in numpy. A block returns a
row per pair, so no row per (pair, term) is ever made.

All arithmetic is on integers.

Defined cases: null text, lang and source are empty strings; empty texts give
a group without terms; a language without kept terms gives value 0 for its
pairs; repeated rows count each; a language with one source has no pairs; an
empty table gives no row. Only text, lang and source are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged

MIN_DF = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
TERMS_PER_BLOCK = 2_048
SOURCES_PER_TILE = 512
SALTS = 16
SLICE_BYTES = 1_000_000
VECTORS_PER_BATCH = 400

# Of a term are ASCII letters (A-Z as a-z) and all bytes of other characters.
TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                   for b in range(256))

VECTORS = "lang string, source string, terms array<string>, counts array<bigint>"


def sparse_vector(text: bytes) -> Counter:
    """Term counts of a whole UTF-8 text, a slice at a time."""
    vector: Counter = Counter()
    start = 0
    while start < len(text):
        stop = start + SLICE_BYTES
        words = text[start:stop].translate(TERM_BYTES)
        if stop < len(text) and not words.endswith(b" "):  # give a cut term back, or finish it
            cut = words.rfind(b" ")
            if cut <= 0:
                while stop < len(text) and TERM_BYTES[text[stop]] != 0x20:
                    stop += 1
                words = text[start:stop].translate(TERM_BYTES)
            else:
                words, stop = words[:cut], start + cut
        vector.update(words.split())
        start = stop
    return vector


def document_vectors(documents: DataFrame) -> DataFrame:
    """(lang, source, terms, counts): one sparse vector per document."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, VECTORS_PER_BATCH):
                part = batch.slice(at, VECTORS_PER_BATCH)
                terms, counts, offsets = [], [], [0]
                for value in part.column("text").cast(pa.binary()):
                    vector = sparse_vector(value.as_py())
                    terms.extend(vector.keys())
                    counts.extend(vector.values())
                    offsets.append(len(terms))
                ends = pa.array(offsets, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), part.column("source"),
                     pa.ListArray.from_arrays(ends, pa.array(terms, pa.binary()).cast(pa.string())),
                     pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))],
                    names=["lang", "source", "terms", "counts"])

    return _named(documents, "text").mapInArrow(build, VECTORS)


def _named(documents: DataFrame, *more: str) -> DataFrame:
    return documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                              for c in ("lang", "source", *more)])


def group_sums(vectors: DataFrame) -> DataFrame:
    """(lang, source, term, count, documents): the vectors of each group added
    up, combined on the map side."""
    return (vectors.select("lang", "source", F.explode(F.arrays_zip("terms", "counts")).alias("e"))
            .groupBy("lang", "source", F.col("e.terms").alias("term"))
            .agg(F.sum("e.counts").alias("count"), F.count(F.lit(1)).alias("documents")))


def share(count: str, n: str, v: str) -> Column:
    """1 + floor(SCALE (count + SMOOTHING) / (n + SMOOTHING v)), exactly."""
    above = f"CAST({count} + {SMOOTHING} AS DECIMAL(20,0)) * CAST({SCALE} AS DECIMAL(10,0))"
    below = f"CAST(nullif({n} + {SMOOTHING} * {v}, 0) AS DECIMAL(20,0))"
    return F.expr(f"1 + ({above}) div ({below})")


def vocabulary(sums: DataFrame, min_df: int = MIN_DF) -> DataFrame:
    """(lang, term, df, total) of the kept terms."""
    return (sums.groupBy("lang", "term")
            .agg(F.sum("documents").alias("df"), F.sum("count").alias("total"))
            .where(F.col("df") >= min_df))


def group_table(documents: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per occurring (lang, source): n, and of its language v, lang_n
    and the number of sources; base is the share of a term it lacks."""
    groups = _named(documents).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    langs = (kept.groupBy("lang", "term").agg(F.first("total").alias("total"))
             .groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n")))
    sources = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    zero = F.lit(0).cast("long")
    joined = (groups.join(own, ["lang", "source"], "left").join(sources, "lang")
              .join(langs, "lang", "left")
              .select("lang", "source", "sources", F.coalesce("n", zero).alias("n"),
                      F.coalesce("v", zero).alias("v"), F.coalesce("lang_n", zero).alias("lang_n")))
    return joined.withColumn("base", F.coalesce(share("0", "n", "v"), zero))


def pair_block(rows: pa.Table) -> pa.Table:
    """Sums over the terms that both sources of a pair have, for one block of
    terms and one pair of tiles: (lang, source, other, shared), source < other
    within a tile, source of the lower tile otherwise."""
    source, names = pd.factorize(rows["source"].to_numpy())
    term, terms = pd.factorize(rows["term"].to_numpy())
    p = np.zeros((len(names), len(terms)), dtype=np.int64)  # a share is 1 at least
    p[source, term] = rows["p"].to_numpy()
    base = np.zeros(len(names), dtype=np.int64)
    base[source] = rows["base"].to_numpy()
    tile = np.zeros(len(names), dtype=np.int64)
    tile[source] = rows["tile"].to_numpy()
    low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
    left, right = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
    place = np.empty(len(names), dtype=np.int64)
    place[np.argsort(names)] = np.arange(len(names))
    found = {"source": [], "other": [], "shared": []}
    for a in left:
        others = right if low != high else right[place[right] > place[a]]
        q, c = p[others], base[others][:, None]
        both = (p[a] > 0) & (q > 0)
        d = (np.abs(p[a] - q) - np.abs(p[a] - c) - np.abs(q - base[a]) + np.abs(base[a] - c))
        meet = both.any(1)
        found["source"].extend([names[a]] * int(meet.sum()))
        found["other"].extend(names[others[meet]])
        found["shared"].extend(np.where(both, d, 0).sum(1)[meet].tolist())
    found["lang"] = [rows["lang"][0].as_py()] * len(found["shared"])
    return pa.table({c: pa.array(found[c], pa.int64() if c == "shared" else pa.string())
                     for c in ("lang", "source", "other", "shared")})


def shared_sums(weighted: DataFrame) -> DataFrame:
    """(lang, source, other, shared) in both directions: the sparse sums over
    the terms that both sources have."""
    tiles = F.ceil(F.col("sources") / F.lit(SOURCES_PER_TILE)).cast("int")
    blocks = F.ceil(F.col("v") / F.lit(TERMS_PER_BLOCK)).cast("int")
    placed = weighted.select(
        "lang", "source", "term", "p", "base",
        F.pmod(F.xxhash64("term"), blocks).alias("block"),
        F.pmod(F.xxhash64("source"), tiles).cast("int").alias("tile"),
        F.explode(F.sequence(F.lit(0), tiles - 1)).alias("met"))
    sums = (placed.withColumns({"low": F.least("tile", "met"), "high": F.greatest("tile", "met")})
            .groupBy("lang", "block", "low", "high")
            .applyInArrow(pair_block, "lang string, source string, other string, shared bigint")
            .groupBy("lang", "source", "other").agg(F.sum("shared").alias("shared")))
    return sums.unionByName(sums.select("lang", F.col("other").alias("source"),
                                        F.col("source").alias("other"), "shared"))


def _salts() -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))


def one_sided(weighted: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, other_base, alone): for a source and a base of its
    language, the sum over the source's terms of |p - other base| - |base -
    other base|, from a histogram of its shares. Salted, so that a language
    is not one task."""
    histogram = (weighted.groupBy("lang", "source", "base", "p")
                 .agg(F.count(F.lit(1)).alias("terms"))
                 .withColumn("salt", F.pmod(F.xxhash64("source", "p"), F.lit(SALTS))))
    bases = (groups.select("lang", F.col("base").alias("other_base")).distinct()
             .withColumn("salt", F.explode(_salts())))
    gap = (F.abs(F.col("p") - F.col("other_base")) - F.abs(F.col("base") - F.col("other_base")))
    return (histogram.join(bases, ["lang", "salt"]).groupBy("lang", "source", "other_base")
            .agg(F.sum(gap * F.col("terms")).alias("alone")))


def pair_values(weighted: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of sources of a
    language."""
    zero = F.lit(0).cast("long")
    a = groups.select("lang", "source", "v", "base",
                      F.pmod(F.xxhash64("source"), F.lit(SALTS)).alias("salt"))
    b = groups.select("lang", F.col("source").alias("other"), F.col("base").alias("other_base"),
                      F.explode(_salts()).alias("salt"))
    alone = one_sided(weighted, groups)
    swapped = alone.select("lang", F.col("source").alias("other"),
                           F.col("other_base").alias("base"), F.col("alone").alias("other_alone"))
    return (a.join(b, ["lang", "salt"]).where("source <> other")
            .join(alone, ["lang", "source", "other_base"], "left")
            .join(swapped, ["lang", "other", "base"], "left")
            .join(shared_sums(weighted), ["lang", "source", "other"], "left")
            .select("lang", "source", F.col("other").alias("item"),
                    (F.col("v") * F.abs(F.col("base") - F.col("other_base"))
                     + F.coalesce("alone", zero) + F.coalesce("other_alone", zero)
                     + F.coalesce("shared", zero)).alias("value")))


def audit(documents: DataFrame, min_df: int = MIN_DF, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): part 'pair' ranks the other
    sources of the language by distance, part 'term' the terms that the source
    uses more than its language does."""
    sums = staged(group_sums(document_vectors(documents)), "term-sums")
    kept = sums.join(vocabulary(sums, min_df), ["lang", "term"]) \
        .select("lang", "source", "term", "count", "total")
    kept = staged(kept, "kept-terms")
    groups = staged(group_table(documents, kept), "term-groups")
    weighted = staged(
        kept.join(groups, ["lang", "source"])
        .select("lang", "source", "term", "base", "v", "sources",
                share("count", "n", "v").alias("p"), share("total", "lang_n", "v").alias("q")),
        "term-shares")

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_values(weighted, groups).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value",
        F.row_number().over(by_value).alias("rank"))
    terms = (weighted.where("p > q")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                     (F.col("p") - F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(by_value))
             .where(F.col("rank") <= top_terms))
    return pairs.unionByName(terms)


ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
o AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
vocabulary AS (SELECT lang, term, count(*) AS total FROM o
               GROUP BY lang, term HAVING count(DISTINCT row) >= {MIN_DF}),
langs AS (SELECT lang, count(*) AS v, CAST(sum(total) AS BIGINT) AS n FROM vocabulary GROUP BY lang),
counted AS (SELECT o.lang, source, term, count(*) AS c
            FROM o JOIN vocabulary USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, source, CAST(sum(c) AS BIGINT) AS n FROM counted GROUP BY ALL),
groups AS (SELECT lang, source, coalesce(s.n, 0) AS n
           FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN sizes s USING (lang, source)),
shares AS (
  SELECT g.lang, g.source, w.term, coalesce(c.c, 0) AS c,
         1 + CAST(({SCALE} * (coalesce(c.c, 0) + {SMOOTHING}) :: HUGEINT)
                  // (g.n + {SMOOTHING} * l.v) AS BIGINT) AS p,
         1 + CAST(({SCALE} * (w.total + {SMOOTHING}) :: HUGEINT)
                  // (l.n + {SMOOTHING} * l.v) AS BIGINT) AS q
  FROM groups g JOIN langs l USING (lang) JOIN vocabulary w USING (lang)
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = w.term),
pairs AS (
  SELECT g.lang, g.source, h.source AS item,
         CAST(coalesce(max(d.value), 0) AS BIGINT) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN (SELECT a.lang, a.source, b.source AS other, sum(abs(a.p - b.p)) AS value
             FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term GROUP BY ALL) d
    ON d.lang = g.lang AND d.source = g.source AND d.other = h.source
  GROUP BY ALL),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER)
         AS rank
FROM ranked
QUALIFY part = 'pair' OR rank <= {TOP_TERMS}
"""
