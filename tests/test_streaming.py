"""Streaming behaviour beyond batch equality: late data, replay, late files."""

from __future__ import annotations

import datetime as dt

from pairflow.operators.pairing import lead_lag_features
from pairflow.plans import fixtures as fx
from pairflow.session import scratch_path
from pairflow.streaming import streams

SCHEMA = "symbol string, ts timestamp_ntz, price double, size bigint"


def t(h, m, s=0):
    return dt.datetime(2024, 1, 1, h, m, s)


def test_rollup_stream_takes_ticks_of_any_age(spark):
    src, table, ck = (scratch_path(spark, n) for n in ("late-src", "late-table", "late-ck"))

    def run():
        ticks = spark.readStream.schema(SCHEMA).parquet(src)
        streams.rollup_stream(ticks, table, ck).awaitTermination()

    spark.createDataFrame([("X", t(10, 0, 10), 1.0, 1), ("X", t(10, 0, 20), 2.0, 1),
                           ("X", t(10, 30, 0), 5.0, 1)], SCHEMA).write.mode("append").parquet(src)
    run()
    # half an hour late and earlier than the stored open: the candle is corrected
    spark.createDataFrame([("X", t(10, 0, 5), 3.0, 1), ("X", t(10, 25, 0), 4.0, 1),
                           ("X", t(10, 30, 40), 6.0, 1)], SCHEMA).write.mode("append").parquet(src)
    run()
    got = {r["ts_minute_utc"]: (r["open"], r["close"], r["trades"])
           for r in spark.read.parquet(table).collect()}
    assert got == {t(10, 0): (3.0, 2.0, 3), t(10, 25): (4.0, 4.0, 1), t(10, 30): (5.0, 6.0, 2)}


def test_replayed_rollup_batch_changes_nothing(spark):
    """The sink's tables after a batch number is written twice."""
    src, table, parts, ck = (scratch_path(spark, n) for n in
                             ("rp-src", "rp-table", "rp-parts", "rp-ck"))
    spark.createDataFrame([("X", t(10, 0, 10), 1.0, 1)], SCHEMA).write.parquet(src)
    for n in range(2):  # a lost checkpoint replays batch 0
        ticks = spark.readStream.schema(SCHEMA).parquet(src)
        streams.rollup_stream(ticks, table, f"{ck}-{n}", partials=parts).awaitTermination()
    (r,) = spark.read.parquet(table).collect()
    assert (r["trades"], r["volume"]) == (1, 1.0)


def test_dedup_stream_keeps_first_arrival_and_late_new_minutes(spark):
    src, table, ck = (scratch_path(spark, n) for n in ("dd-src", "dd-table", "dd-ck"))
    schema = "symbol string, ts_minute_utc timestamp_ntz, close double, dt date"
    day = dt.date(2024, 1, 1)

    def run():
        s = spark.readStream.schema(schema).parquet(src)
        streams.dedup_stream(s, ["symbol", "ts_minute_utc"], table, ck).awaitTermination()

    spark.createDataFrame([("X", t(9, 0), 1.0, day), ("X", t(12, 0), 2.0, day)], schema) \
        .write.mode("append").parquet(src)
    run()
    # 09:05 is new and three hours late, 12:00 is a duplicate
    spark.createDataFrame([("X", t(12, 0), 9.0, day), ("X", t(9, 5), 3.0, day)], schema) \
        .write.mode("append").parquet(src)
    run()
    got = {r["ts_minute_utc"]: r["close"] for r in spark.read.parquet(table).collect()}
    assert got == {t(9, 0): 1.0, t(12, 0): 2.0, t(9, 5): 3.0}


def _same(got, want):
    got = got.select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_features_stream_last_known_equals_batch(spark, sf_dir):
    src, base_t, ref_t, feat_t, ck = (scratch_path(spark, n) for n in
                                      ("lk-src", "lk-base", "lk-ref", "lk-feat", "lk-ck"))
    base = fx.base_candles(spark, sf_dir)
    base.repartitionByRange(4, "ts_minute_utc").write.json(src)
    ref = fx.scenario_ref(fx.ref_candles(spark, sf_dir))       # has gap days
    stream = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 2).json(src)
    streams.features_stream(stream, ref, base_t, ref_t, feat_t, ck,
                            seed="last_known").awaitTermination()
    _same(spark.read.parquet(feat_t), lead_lag_features(base, ref, seed="last_known"))


def test_ref_file_that_arrives_later_changes_the_features(spark, sf_dir):
    root, base_t, ref_t, feat_t, ck = (scratch_path(spark, n) for n in
                                       ("lr-src", "lr-base", "lr-ref", "lr-feat", "lr-ck"))
    base, ref = fx.base_candles(spark, sf_dir), fx.ref_candles(spark, sf_dir)
    base.write.parquet(f"{root}/base")
    early = ref.where("execution_date < DATE'2024-01-10'")
    early.write.parquet(f"{root}/ref")

    def run():
        streams.features_stream(spark.readStream.schema(base.schema).parquet(f"{root}/base"),
                                spark.readStream.schema(ref.schema).parquet(f"{root}/ref"),
                                base_t, ref_t, feat_t, ck).awaitTermination()
        return spark.read.parquet(feat_t)

    _same(run(), lead_lag_features(base, early))
    ref.where("execution_date >= DATE'2024-01-10'").write.mode("append").parquet(f"{root}/ref")
    _same(run(), lead_lag_features(base, ref))
