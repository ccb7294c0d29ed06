"""Near-duplicate groups against all-pairs brute force."""

from __future__ import annotations

import collections
import math
import random

import numpy as np
import pytest

from pairflow.llm import minhash as m
from pairflow.llm.common import table

from . import helpers as h


def exact(a: list[str], b: list[str]) -> float:
    """Probability Jaccard of the weighted five-word shingles, by its definition."""
    def bag(w):
        n = max(1, len(w) - 4) if w else 0
        counts = collections.Counter(tuple(w[i:i + 5]) for i in range(n))
        return {k: 1 + math.log(c) for k, c in counts.items()}
    x, y = bag(a), bag(b)
    if not x and not y:
        return 1.0
    total = 0.0
    for i in x.keys() & y.keys():
        total += 1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys())
    return total


def brute_classes(rows):
    texts = [m.words_of(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if exact(texts[i], texts[j]) >= m.SIMILARITY:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(doc, least.get(find(i))) for i, (doc, _) in enumerate(rows)]


def changed(text: str, rng, edits: int) -> str:
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


def groups():
    """Copies, chains of near copies, a shared passage and unrelated texts."""
    rng, rows, n = random.Random(11), [], 0
    passage = h.prose(77, 60)
    for g in range(12):
        base = h.prose(100 + g, 120)
        for k in range(8):
            rows.append((n, changed(base, rng, k % 4)))
            n += 1
    chain = h.prose(500, 150)
    for k in range(10):  # each link is near, the ends are not
        rows.append((n, chain))
        chain = changed(chain, rng, 2)
        n += 1
    for g in range(40):
        rows.append((n, h.prose(900 + g, 50) + " " + passage))
        n += 1
    line = "the same line again and "
    rows += [(n, line * 30), (n + 1, line * 29), (n + 2, line * 3 + h.prose(5, 30))]
    return rows


def check(spark, rows, clash=False):
    got = m.classes(h.documents(spark, rows, clash)).collect()
    want = brute_classes(rows)
    key = str
    assert sorted(((r["doc_id"], r["class_id"]) for r in got), key=key) == sorted(want, key=key)
    return got


def test_equals_brute_force(spark):
    got = check(spark, groups(), clash=True)
    assert sum(r["kept"] for r in got) == len({r["class_id"] for r in got})


def test_odd_rows(spark):
    check(spark, h.odd_texts())
    assert m.classes(h.empty(spark)).count() == 0


@pytest.mark.parametrize("least", [256, 40])
def test_tile_knows_or_asks(monkeypatch, least):
    """A tile returns links only, connects all it knows exactly, and asks for
    every other pair that is a link."""
    monkeypatch.setattr(m, "LEAST", least)
    rng = random.Random(9)
    texts = []
    for g in range(6):
        base = h.prose(g, 100)
        texts += [changed(base, rng, k % 5) for k in range(12)]
    texts = [m.words_of(t) for t in texts]
    key, doc, weight = m.weighted_shingles(texts, {})
    content = m.prob_minhash(key, doc, weight, len(texts))
    sketch, members = m.sketch_of(content), []
    for i in range(len(texts)):
        mine = key[doc == i]
        members.append({"node": bytes([i]) * 16, "root": bytes([i]) * 16, "loose": True,
                        "sketch": sketch[i].tobytes(), "block": 0, "weighted": False,
                        "least": m.least_hashes(mine), "n": len(mine)})
    ends, sure = m.tile_links(members, True, m.SIMILARITY)
    links = {(j, i) for j in range(len(texts)) for i in range(j)
             if exact(texts[i], texts[j]) >= m.SIMILARITY}
    got = {(a[0], b[0]): s for (a, b), s in zip(ends, sure)}
    assert all(p in links for p, s in got.items() if s)
    if least == 256:
        assert all(sure) and len(sure) < len(texts)
    joined = brute_join(len(texts), [p for p in got if p in links])
    assert joined == brute_join(len(texts), links)


def brute_join(n, links):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def test_tiles_find_links_that_stars_miss(spark, monkeypatch):
    """Strangers share a long passage and so the buckets; the pairs among them
    that are near must still be found, in more than one tile."""
    monkeypatch.setattr(m, "TILE", 8)
    rng, rows = random.Random(4), []
    passage = h.prose(1, 90)
    for g in range(30):
        text = h.prose(2000 + g, 18) + " " + passage
        rows.append((10 * g, text))
        if g % 3 == 0:
            rows.append((10 * g + 1, changed(text, rng, 1)))
    check(spark, rows)


def test_keep_one(spark):
    rows = [(5000 + i, t) for i, t in groups()] + h.odd_texts()
    rows.append(rows[2])
    docs = h.documents(spark, rows, clash=True)
    kept = m.keep_one(docs)
    assert kept.schema == docs.schema
    assert all(r[c] == f"own {c}" for r in kept.collect() for c in h.CLASHES)
    out = [(r["doc_id"], r["text"]) for r in kept.select("doc_id", "text").collect()]
    classes = brute_classes(rows)
    assert len(out) == len({c for _, c in classes})
    ids = [i for i, _ in out if i is not None]
    assert sorted(ids) == sorted({c for _, c in classes if c is not None})


def test_signature_estimates_probability_jaccard():
    rng = random.Random(2)
    a = h.words(rng, 400, 60)
    b = a[:300] + h.words(rng, 100, 60)
    key, doc, weight = m.weighted_shingles([a, b], {})
    content = m.prob_minhash(key, doc, weight, 2, registers=4000)
    estimate = (content[0] == content[1]).mean()
    cut = np.searchsorted(doc, 1)
    value = m.probability_jaccard(key[:cut], weight[:cut], key[cut:], weight[cut:])
    assert value == pytest.approx(exact(a, b), abs=1e-12)
    assert abs(estimate - value) < 0.04


def test_early_termination_changes_nothing():
    """Registers equal those of processes run far past the last register."""
    key, doc, weight = m.weighted_shingles([h.words(random.Random(1), 80)], {})
    best, content = {}, {}
    for k, w in zip(key, weight):
        time = 0.0
        for step in range(400):
            draw = m._mix(np.array([k]) + m.stream(step))
            time -= np.log((float(draw[0] >> np.uint64(11)) + 1) * 2.0 ** -53) / w
            r = int((m._mix(draw)[0] >> np.uint64(32)) * np.uint64(m.REGISTERS) >> np.uint64(32))
            if time < best.get(r, np.inf):
                best[r], content[r] = time, k
    got = m.prob_minhash(key, doc, weight, 1)[0]
    assert [content[r] for r in range(m.REGISTERS)] == got.tolist()


def test_driver_table_equals_brute_force_links(spark):
    """sf0.001: every class of the query is what all pairs give."""
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    short = [(i, t) for i, t in rows if len((t or "").split()) < 400]
    check(spark, short)
