"""Dedup with the state store: bounded, and nothing late or nameless is lost."""

from __future__ import annotations

import datetime as dt

from pairflow.operators.dedup import dedup
from pairflow.session import scratch_path
from pairflow.streaming import segments, streams

SCHEMA = "symbol string, ts_minute_utc timestamp_ntz, close double, ingested_at_utc timestamp_ntz, dt date"
KEYS = ["symbol", "ts_minute_utc"]
START = dt.datetime(2024, 1, 1)


def row(minute, close=1.0, symbol="X", ingest=None):
    at = START + dt.timedelta(minutes=minute)
    seen = START + dt.timedelta(minutes=minute + 1 if ingest is None else ingest)
    return (symbol, at, close, seen, at.date())


def test_state_is_bounded_and_late_rows_are_kept(spark):
    """20 batches of six hours each. Every batch repeats some of the last
    minutes; some bring minutes and repetitions of days ago, or no symbol."""
    src, table, ck = (scratch_path(spark, n) for n in ("bs-src", "bs-table", "bs-ck"))
    arrived = []
    for k in range(20):
        rows = [row(360 * k + m, ingest=360 * k + 360) for m in range(0, 360, 2)]
        rows += [row(360 * k - m, 9.0, ingest=360 * k + 361) for m in range(2, 40, 2) if k]
        if k % 5 == 4:
            rows += [row(m, 5.0, ingest=360 * k + 362) for m in (1, 3, 3, 361, 4)]  # 4 is known
            rows += [row(m, float(k), None, ingest=360 * k + 363) for m in (1, 1)]
            rows += [("X", None, 1.0, START + dt.timedelta(minutes=360 * k), START.date())]
        arrived += rows
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    child = streams.stream_session(spark, 2)
    s = child.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    q = streams.bounded_dedup_stream(s, KEYS, table, ck, delay="2 hours")
    q.awaitTermination()
    state = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress
             if p["stateOperators"]]
    assert len(state) >= 20 and max(state) <= 360 + 60  # two batches, of twenty

    schema = spark.createDataFrame([], SCHEMA).schema
    got = streams.deduplicated(spark, table, schema, KEYS)
    want = dedup(spark.createDataFrame(arrived, SCHEMA), KEYS, ["ingested_at_utc"], "first")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    progress = spark.read.parquet(f"{table}-late-progress")
    total = progress.selectExpr("sum(arrived)", "sum(first_rows)", "sum(late_keys)").first()
    assert tuple(total) == (len(arrived), 20 * 180, 3 * 4)
    live, dead = segments.segments_of(spark, f"{table}-late", "dt", ["2024-01-01"])
    assert 1 <= len(live) <= 6 and dead == []


def test_replayed_batch_changes_nothing(spark):
    src, table, ck = (scratch_path(spark, n) for n in ("br-src", "br-table", "br-ck"))
    spark.createDataFrame([row(0), row(0, 2.0, ingest=9), row(1, symbol=None)], SCHEMA) \
        .coalesce(1).write.parquet(src)
    for n in range(2):  # a lost checkpoint replays batch 0
        s = spark.readStream.schema(SCHEMA).parquet(src)
        streams.bounded_dedup_stream(s, KEYS, table, f"{ck}-{n}").awaitTermination()
    schema = spark.createDataFrame([], SCHEMA).schema
    got = streams.deduplicated(spark, table, schema, KEYS).collect()
    assert sorted((r["symbol"] or "", r["close"]) for r in got) == [("", 1.0), ("X", 1.0)]
