"""Segments of day folders: bounded numbers, and every step of a merge may be lost."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pairflow.operators.candles import to_candles
from pairflow.plans import fixtures as fx
from pairflow.session import scratch_path
from pairflow.streaming import segments, streams

DAY = dt.date(2024, 1, 1)
SCHEMA = "symbol string, n long, dt date"


def batch(spark, epoch, days=1, rows=3):
    data = [("X", epoch * 100 + i, DAY + dt.timedelta(days=d))
            for d in range(days) for i in range(rows)]
    return spark.createDataFrame(data, SCHEMA)


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def stored(spark, root, days=("2024-01-01",)):
    got = segments.read_days(spark, root, "dt", schema(spark), days)
    return sorted((str(r["dt"]), r["n"]) for r in got.collect())


def test_segments_of_a_day_stay_few_and_hold_every_row(spark):
    root = scratch_path(spark, "seg-many")
    for epoch in range(50):
        segments.write_segment(batch(spark, epoch, rows=1), root, "dt", epoch)
        segments.compact(spark, root, "dt", schema(spark), ["2024-01-01"])
        if epoch % 12 == 2:
            live, _ = segments.segments_of(spark, root, "dt", ["2024-01-01"])
            assert len(live) <= 3 * 3  # fanout - 1 of each of the levels 0 to 2, 50 < 4**3
    files = [r for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", True).load(root).select("path").collect()]
    assert len(files) <= 4 * 9  # a task a file, of four
    assert [n for _, n in stored(spark, root)] == [e * 100 for e in range(50)]


def test_only_asked_days_are_listed(spark, monkeypatch):
    root = scratch_path(spark, "seg-days")
    segments.write_segment(batch(spark, 0, days=4), root, "dt", 0)
    seen = []
    monkeypatch.setattr(segments, "path_exists", lambda s, p: seen.append(p) or True)
    live, _ = segments.segments_of(spark, root, "dt", ["2024-01-02"])
    assert [s.day for s in live] == ["2024-01-02"] and seen == [f"{root}/dt=2024-01-02"]
    monkeypatch.undo()
    assert segments.all_days(spark, root, "dt") == [f"2024-01-0{i}" for i in range(1, 5)]


@pytest.mark.parametrize("step", ["_write", "mark", "remove_path"])
def test_a_merge_may_stop_at_any_step(spark, monkeypatch, step):
    root, want = scratch_path(spark, f"seg-{step}"), []
    for epoch in range(4):
        segments.write_segment(batch(spark, epoch), root, "dt", epoch)
        want += [("2024-01-01", epoch * 100 + i) for i in range(3)]
    real = getattr(segments, step)

    def stop(*args, **kwargs):
        if step == "_write":  # rows arrive, the driver ends before the marker
            real(*args, **kwargs)
        raise RuntimeError("lost")
    monkeypatch.setattr(segments, step, stop)
    with pytest.raises(RuntimeError):
        segments.compact(spark, root, "dt", schema(spark), ["2024-01-01"])
    monkeypatch.undo()
    assert stored(spark, root) == want                       # right after the stop
    segments.write_segment(batch(spark, 3), root, "dt", 3)   # the last batch is replayed
    assert stored(spark, root) == want
    segments.compact(spark, root, "dt", schema(spark), ["2024-01-01"])
    assert stored(spark, root) == want
    live, dead = segments.segments_of(spark, root, "dt", ["2024-01-01"])
    if step == "remove_path":  # swept by the run after it
        segments.compact(spark, root, "dt", schema(spark), ["2024-01-01"])
        live, dead = segments.segments_of(spark, root, "dt", ["2024-01-01"])
    assert [s.name for s in live] == ["1-0-3"] and dead == []


def test_rows_without_a_day(spark):
    root = scratch_path(spark, "seg-null")
    for epoch in range(5):
        rows = spark.createDataFrame([("X", epoch, None)], SCHEMA)
        segments.write_segment(rows, root, "dt", epoch)
        segments.compact(spark, root, "dt", schema(spark), segments.day_values(rows, "dt"))
    got = segments.read_days(spark, root, "dt", schema(spark), [segments.NULL_DAY]).collect()
    assert sorted(r["n"] for r in got) == [0, 1, 2, 3, 4] and {r["dt"] for r in got} == {None}


def test_rollup_is_right_between_and_after_merges(spark, sf_dir):
    """Batches with ticks of the whole month, merged by twos: five, then two."""
    src, table, ck = (scratch_path(spark, n) for n in ("rs-src", "rs-table", "rs-ck"))
    t = fx.ticks(spark, sf_dir).withColumn("symbol", F.lit("ALL")).cache()
    cols = ["symbol", "ts_minute_utc", "open", "high", "low", "close", "volume", "trades"]
    for low, high in ((0, 5), (5, 7)):
        part = t.where((F.col("event_id") % 7 >= low) & (F.col("event_id") % 7 < high))
        part.repartition(high - low, "event_id").write.mode("append").parquet(src)
        ticks = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(src)
        streams.rollup_stream(ticks, table, ck, order=fx.TICK_ORDER, fanout=2).awaitTermination()
        want = to_candles(t.where(F.col("event_id") % 7 < high), symbol="ALL",
                          order=fx.TICK_ORDER).select(*cols)
        got = spark.read.parquet(table).select(*cols)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    live, dead = segments.segments_of(spark, f"{table}-partials", "execution_date", ["2024-01-05"])
    assert len(live) <= 3 and dead == []
