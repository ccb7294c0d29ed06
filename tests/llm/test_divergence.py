from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairflow.llm import divergence
from tests.llm import helpers

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, min_df, top):
    """The audit computed densely, from (text, lang, source)."""
    docs = [(lang or "", source or "", Counter(TERM.findall(lower(text or ""))))
            for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        df, sums = Counter(), defaultdict(Counter)
        for a, source, vector in docs:
            if a == lang:
                df.update(vector.keys())
                sums[source].update(vector)
        kept = [t for t, n in df.items() if n >= min_df]
        v = len(kept)

        def shares(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (n + 5 * v) for t in kept}
        p = {s: shares(c) for s, c in sums.items()}
        q = shares(sum(sums.values(), Counter()))
        for s in p:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in p if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if sums[s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(found, 1):
                    if part == "pair" or rank <= top:
                        out.add((lang, s, part, item, value, rank))
    return out


def run(spark, rows, min_df=3, top=5):
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    return {tuple(r) for r in divergence.audit(df, min_df, top)
            .select("lang", "source", "part", "item", "value", "rank").collect()}


def corpus(seed, n, sources):
    rng = random.Random(seed)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["É", "ünd"]
    return [(" ".join(rng.choice(vocabulary[:rng.randrange(5, 122)])
                      for _ in range(rng.randrange(1, 60))),
             rng.choice(["en", "de"]), f"s{min(rng.randrange(sources), rng.randrange(sources))}")
            for _ in range(n)]


def test_audit_equals_dense_computation(spark):
    rows = corpus(1, 220, 9)
    assert run(spark, rows) == brute(rows, 3, 5)


def test_blocks_and_tiles_equal_dense_computation(spark, monkeypatch):
    rows = corpus(2, 160, 14)
    monkeypatch.setattr(divergence, "TERMS_PER_BLOCK", 11)
    monkeypatch.setattr(divergence, "SOURCES_PER_TILE", 3)
    assert run(spark, rows) == brute(rows, 3, 5)


def test_odd_rows(spark):
    rows = [(None, None, None), ("", "en", None), ("!!! 123", "en", "a"), ("Aa aA x_y", "en", "b"),
            ("Éé ÉÉ", None, "c"), ("rare", "fr", "one")] + [("same same other", "en", "a")] * 40 \
        + [("word " * 30_000, "en", "b")] * 4 + [("ties tied", "en", f"t{i}") for i in range(6)]
    assert run(spark, rows) == brute(rows, 3, 5)


def test_language_without_kept_terms_has_zero_values(spark):
    out = run(spark, [("a b", "xx", "s"), ("c", "xx", "r"), ("", "xx", "q")])
    assert {(r[1], r[3], r[4], r[5]) for r in out} == {
        ("s", "q", 0, 1), ("s", "r", 0, 2), ("r", "q", 0, 1), ("r", "s", 0, 2),
        ("q", "r", 0, 1), ("q", "s", 0, 2)}


def test_empty_and_clashing_columns(spark):
    assert divergence.audit(helpers.empty(spark)).count() == 0
    df = helpers.documents(spark, [(i, "one two") for i in range(4)], clash=True)
    for c in ("term", "count", "value", "salt", "base", "p", "item"):
        df = df.withColumn(c, F.lit("own"))
    assert {r["value"] for r in divergence.audit(df, 2).where("part = 'pair'").collect()} == {0}


@pytest.mark.parametrize("step", [1, 7, 64])
def test_sparse_vector_in_slices(monkeypatch, step):
    text = "Alpha beta  ALPHAé gam" * 9 + "中文" * 40 + "- tail"
    whole = Counter(t.encode() for t in TERM.findall(lower(text)))
    monkeypatch.setattr(divergence, "SLICE_BYTES", step)
    assert divergence.sparse_vector(text.encode()) == whole
    assert divergence.sparse_vector(b"") == Counter()


def test_pair_block_against_the_formula():
    rows = pa.table({"lang": ["en"] * 5, "source": list("aabbc"), "term": list("xyxzy"),
                     "p": [9, 5, 4, 7, 3], "base": [2, 2, 1, 1, 3], "tile": [0] * 5,
                     "low": [0] * 5, "high": [0] * 5})
    out = {(r["source"], r["other"]): r["shared"]
           for r in divergence.pair_block(rows).to_pylist()}
    assert out == {("a", "b"): abs(9 - 4) - abs(9 - 1) - abs(4 - 2) + abs(2 - 1),
                   ("a", "c"): abs(5 - 3) - abs(5 - 3) - abs(3 - 2) + abs(2 - 3)}
