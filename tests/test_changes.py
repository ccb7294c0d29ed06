"""Change intervals: what is recomputed equals the whole, and is little."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pairflow.operators import changes
from pairflow.operators.pairing import lead_lag_features
from pairflow.plans import fixtures as fx
from pairflow.session import scratch_path
from pairflow.streaming import streams

SCHEMA = ("ts_minute_utc timestamp_ntz, close double, volume double, high double, low double, "
          "execution_date date")
KEYS = ["execution_date", "ts_minute_utc"]
DAYS, MINUTES = 4, 40


def series(rng, chance, null=0.0):
    out = {}
    for d in range(DAYS):
        for m in range(MINUTES):
            if rng.random() < chance:
                out[d, m] = candle(rng, d, m, null)
    return out


def candle(rng, d, m, null=0.0):
    at = dt.datetime(2024, 1, 1 + d) + dt.timedelta(minutes=m)
    value = lambda: None if rng.random() < null else float(rng.randrange(1, 50))
    return (at, value(), value(), value(), value(), at.date())


@pytest.mark.parametrize("seed_mode", ["previous_day", "none"])
def test_any_change_equals_full_recomputation(spark, seed_mode):
    """Random inserts and updates on both sides, days without ref rows and
    NULL-bearing candles, many tables at once (one pair each)."""
    rng = random.Random(11)
    before, after, touched = [], [], []
    for pair in range(60):
        base, ref = series(rng, 0.8, 0.05), series(rng, rng.choice([0.0, 0.1, 0.5]), 0.2)
        for side, rows in ((0, base), (1, ref)):
            before += [(f"p{pair}", side, *r) for r in rows.values()]
        for _ in range(rng.randrange(1, 4)):
            side, d, m = rng.randrange(2), rng.randrange(DAYS), rng.randrange(MINUTES)
            (base, ref)[side][d, m] = r = candle(rng, d, m, 0.2)
            touched.append((f"p{pair}", side, *r))
        for side, rows in ((0, base), (1, ref)):
            after += [(f"p{pair}", side, *r) for r in rows.values()]
    full = "pair string, side int, " + SCHEMA
    frame = lambda rows, side: (spark.createDataFrame(rows, full)
                                .where(F.col("side") == side).drop("side").cache())
    old = lead_lag_features(frame(before, 0), frame(before, 1), max_lag=3, seed=seed_mode,
                            by=["pair"])
    base, ref = frame(after, 0), frame(after, 1)
    keys = ["pair", *KEYS]
    new, minutes = changes.changed_features(
        base, ref, frame(touched, 0).select(*keys).distinct(),
        frame(touched, 1).select(*keys).distinct(), max_lag=3, seed=seed_mode, by=["pair"])
    got = changes.replaced(old, new, minutes, keys).cache()
    want = lead_lag_features(base, ref, max_lag=3, seed=seed_mode, by=["pair"]).select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert 0 < minutes.count() < base.count() / 2


def test_one_minute_recomputes_a_small_part(spark, sf_dir):
    root = scratch_path(spark, "one-minute")
    base, ref = fx.base_candles(spark, sf_dir), fx.ref_candles(spark, sf_dir)
    base.write.parquet(f"{root}/base/1")
    ref.write.parquet(f"{root}/ref/1")

    def run():
        read = lambda n, df: (spark.readStream.schema(df.schema)
                              .option("recursiveFileLookup", True).parquet(f"{root}/{n}"))
        streams.features_stream(read("base", base), read("ref", ref), f"{root}/b", f"{root}/r",
                                f"{root}/f", f"{root}/ck",
                                changes_table=f"{root}/c").awaitTermination()
        return spark.read.parquet(f"{root}/f")
    rows = run().count()
    # one base minute is revised; a second batch revises one ref minute and
    # brings a row without a minute
    row = base.orderBy("ts_minute_utc").offset(300).limit(1).withColumn("close", F.lit(1.0))
    row.write.parquet(f"{root}/base/2")
    base2 = base.join(row.select("ts_minute_utc"), "ts_minute_utc", "left_anti").unionByName(row)
    got = run()
    want = lead_lag_features(base2, ref).select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    recomputed = spark.read.parquet(f"{root}/c").agg(F.sum("recomputed")).first()[0]
    assert 0 < recomputed < 0.05 * rows

    bad = row.withColumn("ts_minute_utc", F.lit(None).cast("timestamp_ntz"))
    bad.write.parquet(f"{root}/base/3")
    assert run().count() == got.count()
    assert spark.read.parquet(f"{root}/b-rejects").count() == 1
