"""lead_lag_features against a plain-Python implementation of its stated
semantics on random inputs (NULL closes, missing days, unmatched ref rows)."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import types as T

from pairflow.operators.pairing import lead_lag_features

BASE_T = T.StructType([T.StructField(n, t) for n, t in [
    ("ts_minute_utc", T.TimestampNTZType()), ("execution_date", T.DateType()),
    ("close", T.DoubleType()), ("volume", T.DoubleType()), ("high", T.DoubleType()),
    ("low", T.DoubleType()), ("price_change_pct", T.DoubleType())]])
REF_T = T.StructType([f for f in BASE_T.fields if f.name != "price_change_pct"])
D0 = dt.date(2024, 1, 1)
REF_COLS = ("close", "volume", "high", "low")


def gen(seed):
    rng = random.Random(seed)
    val = lambda: None if rng.random() < 0.15 else float(rng.randint(0, 50))
    base, ref = [], []
    for d in range(6):
        day = D0 + dt.timedelta(days=d)
        if rng.random() < 0.15:
            continue                                     # no base rows at all
        for m in sorted(rng.sample(range(60), rng.randint(1, 25))):
            ts = dt.datetime.combine(day, dt.time()) + dt.timedelta(minutes=m)
            base.append((ts, day, val(), val(), val(), val(), val()))
        if rng.random() < 0.3:
            continue                                     # ref absent this day
        for m in sorted(rng.sample(range(60), rng.randint(1, 15))):
            off = 30 if rng.random() < 0.1 else 0        # off the minute grid
            ts = dt.datetime.combine(day, dt.time()) + dt.timedelta(minutes=m, seconds=off)
            ref.append((ts, day, val(), val(), val(), val()))
    return base, ref


def pct(cur, prev):
    return None if cur is None or prev is None or prev == 0 else (cur - prev) / prev * 100


def seed_for(ref, day, mode):
    if mode == "previous_day":
        prev = sorted([r for r in ref if r[1] == day - dt.timedelta(days=1)])
        return dict(zip(REF_COLS, prev[-1][2:])) if prev else dict.fromkeys(REF_COLS)
    earlier = sorted([r for r in ref if r[1] < day])          # last_known, per column
    return {c: next((r[2 + i] for r in reversed(earlier) if r[2 + i] is not None), None)
            for i, c in enumerate(REF_COLS)}


def brute(base, ref, k, mode="previous_day"):
    out = []
    for day in sorted({b[1] for b in base}):
        rows = sorted([b for b in base if b[1] == day])
        obs = {r[0]: r for r in ref if r[1] == day}
        seed = seed_for(ref, day, mode)
        has_ref = any(r[1] == day for r in ref)
        last, filled = dict.fromkeys(REF_COLS), []
        for b in rows:
            o = obs.get(b[0])
            for i, c in enumerate(REF_COLS):
                if o is not None and o[2 + i] is not None:
                    last[c] = o[2 + i]
            filled.append({c: last[c] if last[c] is not None else seed[c] for c in REF_COLS})
        n = len(rows)
        at = lambda seq, j: seq[j] if 0 <= j < n else None
        bc = [b[2] for b in rows]
        rc = [f["close"] for f in filled]
        for i, b in enumerate(rows):
            rec = {"ts_minute_utc": b[0], "execution_date": day, "base_close": b[2],
                   "base_volume": b[3], "base_high": b[4], "base_low": b[5],
                   "base_change_pct": b[6], "ref_market_open":
                       obs.get(b[0]) is not None and obs[b[0]][2] is not None}
            rec.update({f"ref_{c}": filled[i][c] for c in REF_COLS})
            for j in range(1, k + 1):
                rec[f"base_close_lag_{j}"] = at(bc, i - j)
                rec[f"base_close_lead_{j}"] = at(bc, i + j)
                rec[f"base_volume_lag_{j}"] = at([r[3] for r in rows], i - j)
                rec[f"ref_close_lag_{j}"] = at(rc, i - j) if has_ref else None
                rec[f"ref_close_lead_{j}"] = at(rc, i + j) if has_ref else None
            rec["base_return_1m"] = pct(bc[i], at(bc, i - 1))
            rec["ref_return_1m"] = pct(rc[i], at(rc, i - 1)) if has_ref else None
            if rec["base_close_lag_1"] is not None:
                out.append(rec)
    return out


@pytest.mark.parametrize("seed,mode", [(1, "previous_day"), (2, "previous_day"),
                                       (3, "previous_day"), (4, "previous_day"),
                                       (5, "last_known"), (6, "last_known")])
def test_features_equal_brute_force(spark, seed, mode):
    base, ref = gen(seed)
    got = lead_lag_features(spark.createDataFrame(base, BASE_T),
                            spark.createDataFrame(ref, REF_T), max_lag=3, seed=mode)
    want = brute(base, ref, 3, mode)
    cols = got.columns
    key = lambda r: r["ts_minute_utc"]
    g = sorted((r.asDict() for r in got.collect()), key=key)
    w = sorted(want, key=key)
    assert len(g) == len(w)
    for a, b in zip(g, w):
        assert {c: a[c] for c in cols} == {c: b[c] for c in cols}
