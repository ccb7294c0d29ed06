"""Packing: an exact round trip of the ids, placement and padding."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pairflow.llm import packing as p

from . import helpers as h


def check(spark, docs, rows, window=p.WINDOW, unit=p.UNIT):
    """Every id in exactly one piece; pieces fill their sequences gaplessly."""
    tokenizer = Tokenizer.from_file(p.default_tokenizer())
    got = p.pack(docs, window, unit, with_ids=True).withColumn(
        "doc_id", F.col("doc_id").cast("string")).toPandas()
    own = {}
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        own.setdefault(i, []).append(ids)
    total = sum(len(x) for v in own.values() for x in v)
    assert int(got["length"].sum()) == total
    for i, texts in own.items():
        rows_i = got[got["doc_id"].isna()] if i is None else got[got["doc_id"] == str(i)]
        need = sorted(texts)
        pieces = sorted(zip(rows_i["start"], rows_i["length"], rows_i["ids"], rows_i["ids_crc32"]))
        assert sum(int(x[1]) for x in pieces) == sum(map(len, need))
        for start, length, ids, crc in pieces:
            ids = np.frombuffer(ids, "<u4")
            assert len(ids) == length and zlib.crc32(ids.tobytes()) == crc
            assert any(t[start:start + length] == ids.tolist() for t in need)
        if len(need) == 1:
            assert [y for x in pieces for y in np.frombuffer(x[2], "<u4").tolist()] == need[0]
    got = got.sort_values(["sequence_id", "offset"])
    before = got.groupby("sequence_id")["length"].cumsum() - got["length"]
    assert (before == got["offset"]).all()
    lengths = got.groupby("sequence_id")["length"].sum()
    assert lengths.max() <= window
    return lengths


def test_round_trip_and_padding(spark):
    rng = random.Random(8)
    rows = [(i, h.prose(i, rng.choice([3, 40, 200, 700, 2500]))) for i in range(250)]
    lengths = check(spark, h.documents(spark, rows, clash=True), rows)
    assert sum(p.WINDOW - lengths) <= 0.02 * p.WINDOW * len(lengths)


def test_odd_rows(spark):
    check(spark, h.documents(spark, h.odd_texts()), h.odd_texts())
    assert p.pack(h.empty(spark)).count() == 0


def test_one_length_for_all(spark):
    """A length that all documents share is cut, not padded."""
    rows = [(i, h.prose(1, 700)) for i in range(80)]
    lengths = check(spark, h.documents(spark, rows), rows)
    assert (lengths < p.WINDOW).sum() <= 3


def test_small_windows(spark):
    rows = [(i, h.prose(i, 20 + i)) for i in range(30)]
    check(spark, h.documents(spark, rows), rows, window=256, unit=16)
    with pytest.raises(ValueError):
        p.pack(h.documents(spark, rows), 100, 7)


def test_encoder_equals_tokenizer():
    tokenizer = Tokenizer.from_file(p.default_tokenizer())
    encode = p.encoder(p.default_tokenizer())
    for text in ["", "  ", "It's fine, isn't it? We'll see...", "ÉTÉ été Straße ΟΔΟΣ. ΟΔΟΣ",
                 "ábc é. 12,345.67 x.", "<|endoftext|> hi <|startoftext|>",
                 "word, word. w​x", "😀😀, ok.", "tab\tnew\nline\r\n\x1c end.", "e\u0301te\u0301*** don't'll a1b22c",
                 "x_y-z@w.com 3.14e-10 ½ ² Ⅷ ١٢ हिन्दी 漢字かな İstanbul. \u00a0a\u2003b\u0085c",
                 "###??!!--word## ''s 's' <|x|> a<|endoftext|>b"]:
        assert encode([text])[0].tolist() == tokenizer.encode(
            text, add_special_tokens=False).ids + [1], text


def test_encoder_equals_tokenizer_behind_marks():
    """Letters that normalising or lower case takes apart, before signs."""
    tokenizer = Tokenizer.from_file(p.default_tokenizer())
    texts = ["\u0130. a\u0130, b\u0130!c \u0130x.", "\u0915\u093c. \u0958. \u0958, a\u0958!", "\u0558. B\u088f,",
             "Word, WORD. word\u1e9e. \u00c9T\u00c9, \u039f\u0394\u039f\u03a3. .,., , .", "a\x1db. c\x1c, D."]
    rows = p.encoder(p.default_tokenizer())(texts + [""] + texts)
    assert len(rows) == 2 * len(texts) + 1 and rows[len(texts)].tolist() == [p.END_ID]
    for text, ids in zip(texts + [""] + texts, rows):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [1], text


def test_memo_holds_a_word_once():
    """Spellings in capitals and before stops share an entry; long runs, which
    would make the memo's size depend on the texts, have none."""
    from pairflow.llm.common import drop_memos, process_memo
    drop_memos(None)
    rng = random.Random(5)
    words = list({"".join(rng.choices("abcdefgh", k=9)) for _ in range(500)})
    line = " ".join(f"{w} {w.upper()} {w}. {w.title()}, {w}!" for w in words)
    encode = p.encoder(p.default_tokenizer())
    first = encode([line, "x" * 5000 + " 7."])
    memo = process_memo(p.default_tokenizer())
    assert sum(w in memo for w in words) == len(words)
    assert len(memo) <= 2 * len(words) + 10  # a word and its spelling before "!"
    assert max(map(len, memo)) <= p.LONGEST_KEPT
    drop_memos(None)
    small = p.encoder(p.default_tokenizer(), cached=3)
    assert all((a == b).all() for a, b in zip(first, small([line, "x" * 5000 + " 7."])))


def test_nnls_equals_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(20):
        a, b = rng.random((6, 4)), rng.random(6)
        best = min((np.linalg.norm(a @ np.array(x) - b) for x in _active_sets(a, b)))
        assert np.linalg.norm(a @ p.nnls(a, b) - b) == pytest.approx(best, abs=1e-8)


def _active_sets(a, b):
    n = a.shape[1]
    for mask in range(1 << n):
        on = [i for i in range(n) if mask >> i & 1]
        x = np.zeros(n)
        if on:
            x[on] = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
        if (x >= 0).all():
            yield x


def test_plan_places_every_rank_once():
    rng = random.Random(3)
    for _ in range(10):
        counts = {k: rng.randint(0, 40) for k in range(1, 32)}
        plan = p.solve(counts, 32, 4)
        used = {}
        for combo, n in plan:
            assert sum(combo) == 32
            for k in combo:
                used[k] = used.get(k, 0) + n
        assert all(used[k] <= counts[k] for k in used)
        left = [k for k in counts for _ in range(counts[k] - used.get(k, 0))]
        rest = {k: left.count(k) for k in left}
        assert not any(all(rest[k] >= c.count(k) for k in c)
                       for c in p.combinations(32, 4, list(rest)))
