"""Hand-made rows for the behaviours that change data (the quirks the
reference's pipeline exhibits), checked against values worked out by hand."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairflow.functions.numeric import safe_corr
from pairflow.operators.candles import candle_metrics, to_candles
from pairflow.operators.pairing import lead_lag_features, pair_join
from pairflow.operators.upsert import insert_new_rows, merge_append, upsert
from pairflow.operators.dedup import dedup
from pairflow.plans.models import daily_correlation

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
CANDLE = T.StructType([T.StructField(n, t) for n, t in [
    ("ts_minute_utc", T.TimestampNTZType()), ("execution_date", T.DateType()),
    ("open", T.DoubleType()), ("high", T.DoubleType()), ("low", T.DoubleType()),
    ("close", T.DoubleType()), ("volume", T.DoubleType())]])


def minute(day, m):
    return dt.datetime(day.year, day.month, day.day) + dt.timedelta(minutes=m)


def candles(spark, rows):
    df = spark.createDataFrame(
        [(minute(d, m), d, *[None if x is None else float(x) for x in (o, h, lo, c, v)])
         for d, m, o, h, lo, c, v in rows], CANDLE)
    return candle_metrics(df)


def test_fixture_closes_return_warmup_and_columns(spark):
    """Six base minutes (closes 42050..42200): first return, one warm-up
    row dropped, 5 lag and 5 lead columns of the close."""
    closes = [42050.0, 42100.0, 42080.0, 42120.0, 42150.0, 42200.0]
    base = candles(spark, [(D1, i, c - 10, c + 50, c - 50, c, 100.0) for i, c in enumerate(closes)])
    ref = candles(spark, [])
    f = lead_lag_features(base, ref, max_lag=5, seed="none").orderBy("ts_minute_utc").collect()
    assert len(f) == 5
    assert f[0]["base_return_1m"] == pytest.approx((42100 - 42050) / 42050 * 100)
    cols = f[0].asDict()
    assert sum(1 for c in cols if c.startswith("base_close_lag_")) == 5
    assert sum(1 for c in cols if c.startswith("base_close_lead_")) == 5
    assert f[0]["base_close_lead_4"] == 42200.0 and f[0]["base_close_lead_5"] is None


def test_price_change_pct_null_open_is_zero(spark):
    df = spark.createDataFrame([(None, 2.0), (0.0, 2.0), (4.0, 5.0)], "open double, close double")
    got = [r["price_change_pct"] for r in candle_metrics(
        df.withColumn("high", F.lit(1.0)).withColumn("low", F.lit(1.0))).collect()]
    assert got == [0.0, 0.0, 25.0]


def test_seed_fills_until_first_observation_then_locf(spark):
    base = candles(spark, [(D2, m, 1.0, 1.0, 1.0, 10.0 + m, 1.0) for m in range(5)])
    ref = candles(spark, [(D1, 1000, 1, 9, 1, 7.0, 3.0),       # last of day 1 -> seed
                          (D1, 900, 1, 9, 1, 6.0, 2.0),
                          (D2, 2, 1, 9, 1, 8.0, 4.0)])          # observed at minute 2 of day 2
    f = lead_lag_features(base, ref, seed="previous_day", drop_warmup=False) \
        .orderBy("ts_minute_utc").collect()
    assert [r["ref_close"] for r in f] == [7.0, 7.0, 8.0, 8.0, 8.0]
    assert [r["ref_market_open"] for r in f] == [False, False, True, False, False]
    assert [r["ref_return_1m"] for r in f][1:3] == [0.0, pytest.approx((8 - 7) / 7 * 100)]


def test_ref_absent_day_keeps_seed_but_nulls_shifts(spark):
    base = candles(spark, [(D2, m, 1, 1, 1, 10.0 + m, 1.0) for m in range(4)])
    ref = candles(spark, [(D1, 10, 1, 9, 1, 7.0, 3.0)])
    f = lead_lag_features(base, ref, drop_warmup=False).collect()
    assert {r["ref_close"] for r in f} == {7.0}
    assert all(r["ref_close_lag_1"] is None and r["ref_return_1m"] is None for r in f)
    assert not any(r["ref_market_open"] for r in f)


def test_no_seed_day_is_all_null(spark):
    base = candles(spark, [(D2, m, 1, 1, 1, 10.0 + m, 1.0) for m in range(3)])
    ref = candles(spark, [(dt.date(2023, 12, 30), 10, 1, 9, 1, 7.0, 3.0)])
    f = lead_lag_features(base, ref, drop_warmup=False).collect()
    assert all(r["ref_close"] is None for r in f)


def test_last_known_seed_crosses_empty_days(spark):
    base = candles(spark, [(D2, m, 1, 1, 1, 10.0 + m, 1.0) for m in range(3)])
    ref = candles(spark, [(dt.date(2023, 12, 30), 10, 1, 9, 1, 7.0, 3.0)])
    f = lead_lag_features(base, ref, seed="last_known", drop_warmup=False).collect()
    assert {r["ref_close"] for r in f} == {7.0}


def test_zero_variance_correlation_is_null(spark):
    df = spark.createDataFrame([(D1, 0.1, 0.0), (D1, 0.2, 0.0), (D1, 0.4, 0.0),
                                (D2, 0.1, 0.1), (D2, 0.2, 0.3), (D2, 0.3, 0.2)],
                               "execution_date date, base_return_1m double, ref_return_1m double")
    got = {r["execution_date"]: r["correlation_1m"] for r in daily_correlation(df).collect()}
    assert got[D1] is None
    assert got[D2] == pytest.approx(0.5)


def test_safe_corr_matches_pearson(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.5), (3.0, 5.5), (4.0, 9.0)], "a double, b double")
    (c,) = df.agg(safe_corr("a", "b")).first()
    (ref,) = df.agg(F.corr("a", "b")).first()
    assert c == pytest.approx(ref)


def test_pair_join_left_semantics(spark):
    base = candles(spark, [(D1, m, 1, 1, 1, 1.0 * m, 1.0) for m in range(3)])
    ref = candles(spark, [(D1, 1, 1, 1, 1, 5.0, 1.0), (D1, 7, 1, 1, 1, 6.0, 1.0)])
    got = {r["ts_minute_utc"].minute: (r["ref_close"], r["ref_market_open"])
           for r in pair_join(base, ref).collect()}
    assert got == {0: (None, False), 1: (5.0, True), 2: (None, False)}


def test_to_candles_ignores_null_prices(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    ticks = spark.createDataFrame(
        [(t0 + dt.timedelta(seconds=s), p, 1) for s, p in [(1, None), (2, 5.0), (3, 7.0), (4, None)]],
        "ts timestamp_ntz, price double, size bigint")
    (r,) = to_candles(ticks, symbol="X").collect()
    assert (r["open"], r["high"], r["low"], r["close"], r["trades"], r["volume"]) == \
        (5.0, 7.0, 5.0, 7.0, 4, 4.0)


def test_upsert_update_insert_and_null_keys(spark):
    target = spark.createDataFrame([(1, "a", 10.0), (2, "b", 20.0), (None, "n", 0.0)],
                                   "k int, s string, v double")
    batch = spark.createDataFrame([(2, 21.0, 1), (2, 22.0, 2), (3, 30.0, 1), (None, 9.0, 1)],
                                  "k int, v double, ver int")
    got = sorted(upsert(target, batch, ["k"], order=["ver"]).collect(),
                 key=lambda r: (r["k"] is None, r["k"] or 0, r["v"]))
    assert [(r["k"], r["s"], r["v"]) for r in got] == [
        (1, "a", 10.0), (2, "b", 22.0), (3, None, 30.0), (None, "n", 0.0), (None, None, 9.0)]


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([(1, 10.0), (2, 20.0)], "k int, v double")
    batch = spark.createDataFrame([(2, 21.0), (3, 30.0)], "k int, v double")
    once = upsert(target, batch, ["k"])
    twice = upsert(once, batch, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_insert_new_rows_null_safe_and_keeps_batch_duplicates(spark):
    target = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    batch = spark.createDataFrame([(1, None), (3, "y"), (3, "y")], "a int, b string")
    got = sorted(insert_new_rows(target, batch).collect(), key=lambda r: (r["a"], r["b"] or ""))
    assert [(r["a"], r["b"]) for r in got] == [(1, None), (2, "x"), (3, "y"), (3, "y")]


def test_merge_append_priorities(spark):
    e = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    i = spark.createDataFrame([(2, 9.0), (3, 3.0)], "k int, v double")
    keep_e = dict((r["k"], r["v"]) for r in merge_append(e, i, ["k"]).collect())
    keep_i = dict((r["k"], r["v"]) for r in merge_append(e, i, ["k"], keep="incoming").collect())
    assert keep_e == {1: 1.0, 2: 2.0, 3: 3.0}
    assert keep_i == {1: 1.0, 2: 9.0, 3: 3.0}


def test_dedup_is_deterministic_on_ties(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 4, "z")], "k int, o int, x string")
    assert [tuple(r) for r in dedup(df, ["k"], ["o"]).collect()] == [(1, 5, "b")]
    assert [tuple(r) for r in dedup(df, ["k"], ["o"], keep="first").collect()] == [(1, 4, "z")]


def test_upsert_with_only_key_in_common_inserts_absent_keys(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    batch = spark.createDataFrame([(2, 7), (3, 8)], "k int, other int")
    got = sorted(tuple(r) for r in upsert(target, batch, ["k"]).collect())
    assert got == [(1, "a"), (2, "b"), (3, None)]
