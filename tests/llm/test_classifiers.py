"""Quality (positive-unlabelled) and toxicity (segments): held-out accuracy,
brute-force segments, odd inputs."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairflow.llm import quality, toxicity
from pairflow.llm.common import held_out, table
from pairflow.llm.queries import QUERIES

from . import helpers as h

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("key,label,least", [("op10_quality", "quality", 0.95),
                                             ("op7_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, key, label, least):
    out = QUERIES[key](spark, SF)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    got = out.join(table(spark, SF, "labels"), "doc_id").where("held_out").toPandas()
    assert (got["predicted"] == got[label]).mean() >= least
    assert out.count() == table(spark, SF, "documents").count()
    assert got["score"].between(0, 1).all()


def test_held_out_fold(spark):
    df = spark.createDataFrame([(i,) for i in range(200)] + [(None,)], "doc_id long")
    got = {r["doc_id"]: r["x"] for r in df.select("doc_id", held_out(F.col("doc_id")).alias("x"))
           .collect()}
    assert got.pop(None) is False
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in got}


def toy(spark, clash=False):
    """Clean prose, prose with abuse, and shouting junk."""
    rng, texts, labs = random.Random(5), [], []
    for i in range(300):
        toxic, junk = i % 6 == 0, i % 5 == 4
        w = h.words(rng, 60)
        if toxic:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(["villain", "rubbish", "crook"]))
        text = " ".join(x.upper() + "!!" for x in w[:5] * 8) if junk else " ".join(w) + "."
        texts.append((100 + i, text))
        labs.append((100 + i, int(not junk), int(toxic)))
    return h.documents(spark, texts + h.odd_texts(), clash), h.labels(
        spark, labs + [(None, 1, 1), (100, 1, None), (5, None, None)])


@pytest.mark.parametrize("fn,label", [(quality.quality_scores, "quality"),
                                      (toxicity.toxicity_scores, "toxic")])
def test_odd_rows_are_scored(spark, fn, label):
    docs, labs = toy(spark, clash=True)
    rows = fn(docs, labs).collect()
    assert len(rows) == 300 + len(h.odd_texts())
    assert {r["doc_id"] for r in rows} >= {h.BIG, h.BIG + 1, None}
    assert all(0 <= r["score"] <= 1 for r in rows)
    twins = [r["score"] for r in rows if r["doc_id"] in (h.BIG, h.BIG + 1)]
    assert twins[0] == twins[1]
    empties = {r["score"] for r in rows if r["doc_id"] in (1, 2)}
    assert len(empties) == 1
    assert fn(h.empty(spark), labs).count() == 0


@pytest.mark.parametrize("fn", [quality.quality_scores, toxicity.toxicity_scores])
def test_without_labels_every_score_is_half(spark, fn):
    docs = h.documents(spark, h.odd_texts())
    none = h.labels(spark, [])
    assert {r["score"] for r in fn(docs, none).collect()} == {0.5}


def test_keep_good_returns_own_columns(spark):
    docs, labs = toy(spark, clash=True)
    kept = quality.keep_good(docs, labs)
    assert kept.schema == docs.schema
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    good = {r["doc_id"] for r in labs.where("quality = 1 AND doc_id >= 100").collect()}
    bad = {r["doc_id"] for r in labs.where("quality = 0").collect()}
    assert len(good - ids) <= 2 and len(bad & ids) <= 2
    assert {r["quality_score"] for r in kept.select("quality_score").collect()} == {
        "own quality_score"}


def test_prior_estimate():
    rng = np.random.default_rng(1)
    p = rng.normal(2, 1, (4000, 1))
    u = np.vstack([rng.normal(2, 1, (2400, 1)), rng.normal(-2, 1, (1600, 1))])
    assert abs(quality.estimate_prior(p, u) - 0.6) < 0.08


def brute_segments(scores):
    """All maximal scoring segments by their recursive definition: the best
    stretch (leftmost, then shortest, at a tie), then the same on both sides."""
    best = None
    for a in range(len(scores)):
        total = 0.0
        for b in range(a, len(scores)):
            total += scores[b]
            if total > 0 and (best is None or total > best[2] + 1e-9):
                best = (a, b, total)
    if best is None:
        return []
    a, b, total = best
    left = brute_segments(scores[:a])
    right = [(x + b + 1, y + b + 1, s) for x, y, s in brute_segments(scores[b + 1:])]
    return left + [(a, b, total)] + right


def test_segments_equal_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 40)
        scores = [rng.choice([-0.4, -0.4, -0.4, 1.13, 0.71, 2.37]) for _ in range(n)]
        values = [(i, s) for i, s in enumerate(scores) if s > 0]
        got = toxicity.segments(values, n)
        want = brute_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_passages_are_found(spark):
    docs, labs = toy(spark)
    model = toxicity.fit(docs, labs)
    text = " ".join(h.words(random.Random(1), 500)) + " villain rubbish crook villain " + " ".join(
        h.words(random.Random(2), 500))
    row = toxicity.passages(h.documents(spark, [(1, text)]), model).first()
    assert any({"villain", "rubbish"} <= set(p["text"].split()) for p in row["passages"])
    assert all(p["last_word"] - p["first_word"] < 30 for p in row["passages"])
