"""Property checks against brute force: segmented whole-history windows
equal a global window; LOCF is idempotent; lag/lead invert each other."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from pairflow.operators.timeseries import locf, whole_history_shift


def random_series(spark, seed, n=400, null_rate=0.3):
    rng = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    minutes = sorted(rng.sample(range(0, 60 * 24 * 12), n))  # 12 days, gaps, empty days
    rows = [(t0 + dt.timedelta(minutes=m),
             None if rng.random() < null_rate else round(rng.uniform(1, 100), 2),
             None if rng.random() < null_rate else round(rng.uniform(1, 100), 2))
            for m in minutes if not (3 * 1440 <= m < 5 * 1440)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, a double, b double")


def test_whole_history_shift_equals_global_window(spark):
    for seed in range(3):
        df = random_series(spark, seed)
        got = whole_history_shift(df, ["a", "b"], ts="ts")
        w = Window.orderBy("ts")
        want = df.select("*", *[f(c, 1).over(w).alias(f"{c}_{n}_1_calc")
                                for c in ("a", "b") for f, n in ((F.lag, "lag"), (F.lead, "lead"))])
        assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())


def test_locf_is_idempotent_and_matches_brute_force(spark):
    df = random_series(spark, 7).withColumn("d", F.col("ts").cast("date"))
    once = locf(df, ["a", "b"], order="ts", by=["d"])
    twice = locf(once, ["a", "b"], order="ts", by=["d"])
    assert sorted(once.collect()) == sorted(twice.collect())
    rows = sorted(df.collect(), key=lambda r: r["ts"])
    last, expect = {}, {}
    for r in rows:
        if r["d"] not in last:
            last[r["d"]] = None
        if r["a"] is not None:
            last[r["d"]] = r["a"]
        expect[r["ts"]] = last[r["d"]]
    assert {r["ts"]: r["a"] for r in once.collect()} == expect


def test_lag_of_lead_is_identity_inside_a_partition(spark):
    df = random_series(spark, 11, null_rate=0.0).withColumn("d", F.col("ts").cast("date"))
    w = Window.partitionBy("d").orderBy("ts")
    x = df.withColumn("nxt", F.lead("a", 2).over(w)).withColumn("back", F.lag("nxt", 2).over(w))
    bad = x.where(F.col("back").isNotNull() & (F.col("back") != F.col("a"))).count()
    assert bad == 0


def test_multi_pair_features_equal_per_pair_runs(spark, sf_dir):
    """``by=`` keys: two pairs in one frame give exactly each pair alone."""
    from pairflow.operators.pairing import lead_lag_features
    from pairflow.plans import fixtures as fx
    base, ref = fx.base_candles(spark, sf_dir), fx.scenario_ref(fx.ref_candles(spark, sf_dir))
    b2 = base.withColumn("pair", F.lit("p1")).unionByName(
        base.withColumn("close", F.col("close") * 2).withColumn("pair", F.lit("p2")))
    r2 = ref.withColumn("pair", F.lit("p1")).unionByName(
        ref.where(F.col("execution_date") != F.lit("2024-01-05").cast("date"))
           .withColumn("pair", F.lit("p2")))
    both = lead_lag_features(b2, r2, by=["pair"])
    for p in ("p1", "p2"):
        alone = lead_lag_features(b2.where(F.col("pair") == p), r2.where(F.col("pair") == p),
                                  by=["pair"])
        mine = both.where(F.col("pair") == p)
        assert mine.exceptAll(alone).count() == 0 and alone.exceptAll(mine).count() == 0
    assert both.where("pair = 'p1'").drop("pair").exceptAll(lead_lag_features(base, ref)).count() == 0


def test_whole_history_shift_by_key(spark):
    a = random_series(spark, 21).withColumn("k", F.lit(1))
    b = random_series(spark, 22).withColumn("k", F.lit(2))
    df = a.unionByName(b)
    got = whole_history_shift(df, ["a"], ts="ts", by=["k"])
    w = Window.partitionBy("k").orderBy("ts")
    want = df.select("*", F.lag("a", 1).over(w).alias("a_lag_1_calc"),
                     F.lead("a", 1).over(w).alias("a_lead_1_calc")).select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_dedup_matches_brute_force_with_ties(spark):
    from pairflow.operators.dedup import dedup
    rng = random.Random(5)
    rows = [(rng.randint(0, 20), rng.randint(0, 3), rng.choice("abc"), rng.randint(0, 9))
            for _ in range(600)]                      # few keys: heavy repetition and ties
    df = spark.createDataFrame(rows, "k int, o int, x string, y int")
    for keep, pick in (("last", max), ("first", min)):
        want = {}
        for k, o, x, y in rows:
            want[k] = pick(want.get(k, (o, x, y)), (o, x, y))
        got = {r["k"]: (r["o"], r["x"], r["y"]) for r in dedup(df, ["k"], ["o"], keep=keep).collect()}
        assert got == want


def test_upsert_matches_brute_force_with_null_keys(spark):
    from pairflow.operators.upsert import upsert
    rng = random.Random(9)
    key = lambda: None if rng.random() < 0.2 else rng.randint(0, 30)
    target = [(key(), f"t{i}", float(i)) for i in range(120)]
    # target keys are unique apart from NULLs (a keyed table)
    seen, t_rows = set(), []
    for k, s, v in target:
        if k is None or k not in seen:
            t_rows.append((k, s, v))
            seen.add(k)
    batch = [(key(), float(100 + i), rng.randint(0, 3)) for i in range(80)]
    t = spark.createDataFrame(t_rows, "k int, s string, v double")
    b = spark.createDataFrame(batch, "k int, v double, ver int")
    # brute force: latest version per key (ties: greatest value), NULL keys grouped
    best = {}
    for k, v, ver in batch:
        best[k] = max(best.get(k, (ver, v)), (ver, v))
    want = []
    for k, s, v in t_rows:
        hit = k is not None and k in best
        want.append((k, s, best[k][1] if hit else v))
    present = {k for k, _, _ in t_rows if k is not None}
    want += [(k, None, vv) for k, (_, vv) in best.items() if k is None or k not in present]
    got = [tuple(r) for r in upsert(t, b, ["k"], order=["ver"]).collect()]
    norm = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2]))
    assert norm(got) == norm(want)


def test_to_candles_matches_brute_force(spark):
    from pairflow.operators.candles import to_candles
    rng = random.Random(3)
    t0 = dt.datetime(2024, 1, 1, 9, 0)
    secs = sorted(rng.sample(range(0, 3 * 3600), 500))        # unique tick times, 3 hours
    ticks = [(rng.choice("AB"), t0 + dt.timedelta(seconds=s, microseconds=rng.randint(0, 999)),
              None if rng.random() < 0.1 else float(rng.randint(1, 100)), rng.randint(1, 5))
             for s in secs]
    df = spark.createDataFrame(ticks, "symbol string, ts timestamp_ntz, price double, size bigint")
    for minutes in (1, 5):
        want = {}
        for sym, ts, p, z in sorted(ticks, key=lambda r: r[1]):
            start = ts.replace(second=0, microsecond=0)
            start -= dt.timedelta(minutes=(start.hour * 60 + start.minute) % minutes)
            c = want.setdefault((sym, start), {"prices": [], "vol": 0.0, "n": 0})
            c["n"] += 1
            c["vol"] += z
            if p is not None:
                c["prices"].append(p)
        got = {(r["symbol"], r["ts_minute_utc"]): r for r in
               to_candles(df, minutes=minutes).collect()}
        assert set(got) == set(want)
        for key, c in want.items():
            r, ps = got[key], c["prices"]
            assert (r["open"], r["close"]) == ((ps[0], ps[-1]) if ps else (None, None))
            assert (r["high"], r["low"]) == ((max(ps), min(ps)) if ps else (None, None))
            assert (r["volume"], r["trades"]) == (c["vol"], c["n"])
