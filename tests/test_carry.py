"""Stored last-known snapshots against full recomputation; the export job."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from pairflow import jobs, session
from pairflow.operators.pairing import lead_lag_features, side_columns
from pairflow.sources import carry, files, publish, sinks

SCHEMA = ("pair string, dt date, ts_minute_utc timestamp_ntz, open double, high double, "
          "low double, close double, volume double")
DAYS = [dt.date(2024, 1, d) for d in range(1, 9)]


def scratch_path(spark, name):
    return session.scratch_path(spark, name).removeprefix("file:")


def candles(spark, seed, days=DAYS, gaps=0.0, pairs=("a", "b", None)):
    rng = random.Random(seed)
    value = lambda: None if rng.random() < gaps else round(rng.uniform(1, 9), 3)
    rows = [(p, d, dt.datetime.combine(d, dt.time(14, m)), *[value() for _ in range(5)])
            for p in pairs for d in days if not gaps or rng.random() < 0.6 for m in range(4)
            if not gaps or rng.random() < 0.7]
    return spark.createDataFrame(rows, SCHEMA)


def seeds_of(df):
    return {tuple(r[:-1]): tuple(r["_s"]) for r in df.collect()}


def states(spark, path):
    return sorted(map(str, files.read_layer(spark, path, marked=True).collect()))


def fresh(spark, ref, days):
    path = scratch_path(spark, "fresh")
    carry.update_carry(ref, path, days, by=["pair"])
    return states(spark, path)


def test_snapshots_follow_corrections_of_any_day(spark):
    path, names = scratch_path(spark, "carry"), [str(d) for d in DAYS]
    ref = candles(spark, 0, gaps=0.6).cache()
    assert carry.update_carry(ref, path, names, by=["pair"])
    for n, day in enumerate([3, 0, 7, 1]):
        new = candles(spark, 10 + n, [DAYS[day]], gaps=0.5)
        ref = ref.where(F.col("dt") != F.lit(DAYS[day])).unionByName(new).cache()
        carry.update_carry(ref, path, [names[day]], by=["pair"])
        assert states(spark, path) == fresh(spark, ref, names)
    # a day without rows stands for the days before it
    ref = ref.where(F.col("dt") != F.lit(DAYS[4]))
    carry.update_carry(ref, path, [names[4]], by=["pair"])
    have = [r["close"] for r in files.read_layer(spark, path).where(
        (F.col("dt") == F.lit(DAYS[4])) & (F.col("pair") == "a")).collect()]
    before = [r["close"] for r in files.read_layer(spark, path).where(
        (F.col("dt") == F.lit(DAYS[3])) & (F.col("pair") == "a")).collect()]
    assert have == before
    assert carry.update_carry(ref, path, names, by=["pair"]) == []  # nothing differs


def test_a_hidden_correction_stops_early(spark):
    path, names = scratch_path(spark, "early"), [str(d) for d in DAYS]
    ref = candles(spark, 1)
    carry.update_carry(ref, path, names, by=["pair"])
    new = ref.withColumn("close", F.when(F.col("dt") == F.lit(DAYS[2]), F.col("close") + 1)
                         .otherwise(F.col("close")))
    assert carry.update_carry(new, path, [names[2]], by=["pair"]) == [names[2]]


@pytest.mark.parametrize("by", [["pair"], []])
def test_seeds_give_the_features_of_the_whole_history(spark, by):
    path, names = scratch_path(spark, "seeds"), [str(d) for d in DAYS]
    pairs = ("a", "b", None) if by else ("a",)
    base, ref = candles(spark, 2, pairs=pairs), candles(spark, 3, gaps=0.5, pairs=pairs)
    base = base.withColumn("price_change_pct", F.lit(0.0))
    carry.update_carry(ref, path, names[:5], by=by)
    carry.update_carry(ref, path, names[5:], by=by)
    day = lambda df: df.withColumnRenamed("dt", "execution_date")
    want = lead_lag_features(day(base), day(ref), max_lag=2, seed="last_known", by=by)
    seeds = carry.carried_seeds(spark, path, names, side_columns("ref", False), ref.schema, by=by)
    got = lead_lag_features(day(base), day(ref), max_lag=2, seed="last_known", by=by, seeds=seeds)
    assert want.where("ref_close IS NOT NULL").count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_no_earlier_day_no_seed(spark):
    path = scratch_path(spark, "none")
    ref = candles(spark, 4)
    args = (side_columns("ref", False), ref.schema)
    assert seeds_of(carry.carried_seeds(spark, path, ["2024-01-03"], *args, by=["pair"])) == {}
    carry.update_carry(ref, path, ["2024-01-03"], by=["pair"])
    assert seeds_of(carry.carried_seeds(spark, path, ["2024-01-03"], *args, by=["pair"])) == {}
    got = seeds_of(carry.carried_seeds(spark, path, ["2024-01-04", "2024-02-01"], *args,
                                       by=["pair"]))
    assert {k[1] for k in got} == {dt.date(2024, 1, 4), dt.date(2024, 2, 1)} and len(got) == 6


def test_a_run_reads_its_days_and_one_snapshot(spark):
    path, ref_path = scratch_path(spark, "plan-carry"), scratch_path(spark, "plan-ref")
    ref = candles(spark, 5)
    publish.publish_layer(ref, ref_path)
    assert len(jobs.carry_job(spark, ref_path, path, by=["pair"])) == len(DAYS)
    assert jobs.carry_job(spark, ref_path, path, by=["pair"]) == []
    seeds = carry.carried_seeds(spark, path, ["2024-01-06"], side_columns("ref", False),
                                ref.schema, by=["pair"])
    assert seeds.count() == 3
    scan = [x for x in seeds._jdf.queryExecution().executedPlan().toString().split("\n")
            if "FileScan" in x]
    assert len(scan) == 1 and "2024-01-05" in scan[0].split("PartitionFilters: [")[1]


def test_late_correction_through_the_jobs(spark):
    base, ref, state, out, want = (scratch_path(spark, n) for n in ("jb", "jr", "js", "jo", "jw"))
    b = candles(spark, 6).withColumn("price_change_pct", F.lit(0.0))
    names = [str(d) for d in DAYS]
    publish.publish_layer(b, base)
    publish.publish_layer(candles(spark, 7, gaps=0.5), ref)
    jobs.carry_job(spark, ref, state, by=["pair"])
    publish.publish_layer(candles(spark, 8, DAYS[1:2]), ref)
    jobs.features_job(spark, base, ref, out, names[3:], seed="last_known", by=["pair"], state=state)
    jobs.features_job(spark, base, ref, want, names[3:], seed="last_known", by=["pair"])
    got, full = (spark.read.parquet(p).drop("processed_at_utc") for p in (out, want))
    assert full.count() and got.exceptAll(full).count() == 0 == full.exceptAll(got).count()


def test_export_spills_and_recovers(spark):
    usage, ledger, spill, store = (scratch_path(spark, n) for n in ("eu", "el", "es", "et"))
    rows = candles(spark, 9).withColumnRenamed("dt", "execution_date")
    sinks.write_layer(rows, usage, "execution_date")
    names = [str(d) for d in DAYS]

    def broken(_):
        raise OSError("no warehouse")
    for _ in range(2):  # a second failure replaces the spill of its days
        assert jobs.export_job(spark, usage, ledger, spill, names[-1], broken) == (
            "fallback", names[:-1])
    assert spark.read.option("header", True).csv(spill).count() == 3 * 4 * 7
    keep = lambda r: r.write.mode("append").parquet(store)
    assert jobs.export_job(spark, usage, ledger, spill, names[-1], keep)[0] == "primary"
    assert not [f for f in os.listdir(spill) if f.startswith("execution_date=")]
    assert jobs.export_job(spark, usage, ledger, spill, names[-1], keep) == ("nothing", [])
    assert jobs.export_job(spark, usage, ledger, spill, "2024-02-01", keep) == (
        "primary", names[-1:])
    stored = spark.read.parquet(store)
    assert stored.count() == rows.count()
    assert stored.where("source_file IS NULL OR loaded_at_utc IS NULL").count() == 0


def test_documents_fall_back_to_json(spark):
    usage, ledger, out, spill = (scratch_path(spark, n) for n in ("du", "dl", "do", "ds"))
    rows = candles(spark, 11, DAYS[:3], pairs=("a",)).withColumnRenamed("dt", "execution_date")
    rows = rows.withColumn("close", F.lit(float("nan")))
    sinks.write_layer(rows, usage, "execution_date")

    def broken(_):
        raise OSError("no search service")
    with pytest.raises(OSError):
        jobs.documents_job(spark, usage, out, ledger, "2024-02-01", load=broken)
    for _ in range(2):  # the days stay pending and replace their own folders
        assert not jobs.documents_job(spark, usage, out, ledger, "2024-02-01", load=broken,
                                      fallback=spill)
    back = spark.read.json(spill)
    assert back.count() == 12 and back.where("close IS NOT NULL").count() == 0
    loaded = []
    assert jobs.documents_job(spark, usage, out, ledger, "2024-02-01", load=loaded.append)
    assert loaded == [out] and spark.read.text(out).count() == 12
    assert spark.read.parquet(ledger).count() == 3


def test_landing_takes_the_newest_of_each_response(spark):
    import json
    kl, qu, raw_k, raw_q = (scratch_path(spark, n) for n in ("pk", "pq", "rk", "rq"))
    t0 = 1_704_067_200_000
    kline = lambda m: [t0 + 60_000 * m, *["1.0"] * 5, t0 + 60_000 * m + 59_999, "1.0", 1,
                       "1.0", "1.0", "0"]
    quote = lambda t: {"datetime": t, **dict.fromkeys(
        ("open", "high", "low", "close", "volume"), "2.0")}
    for path in (kl, qu):
        os.makedirs(path)
    for n, at in enumerate((0, 10)):
        with open(f"{kl}/{n}.json", "w") as f:
            json.dump([kline(at + m) for m in range(6)], f)
    times = [f"2024-01-01 15:0{m}:00" for m in range(5)]
    for name, body in (("a", {"values": [quote(t) for t in [*times, "soon", None]]}),
                       ("b", {"status": "error"})):
        with open(f"{qu}/{name}.json", "w") as f:
            json.dump(body, f)
    jobs.land_klines_job(spark, kl, raw_k, "X", newest=2)
    got = sorted((r["open_time"] - t0) // 60_000 for r in spark.read.json(raw_k).collect())
    assert got == [4, 5, 14, 15]
    assert jobs.land_quotes_job(spark, qu, raw_q, "Y", newest=3) == {"responses": 1, "quotes": 2}
    landed = spark.read.option("header", True).csv(raw_q)
    assert sorted(r["ts_minute_utc"] for r in landed.collect()) == [
        f"2024-01-01T15:0{m}:00Z" for m in (2, 3, 4)]
