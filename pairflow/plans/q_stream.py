"""Registered queries: streaming stages, each ending in its sink read back
as a batch DataFrame; the result must equal the batch operator's."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import candles as cdl
from ..session import scratch_path
from ..streaming import streams
from . import fixtures as fx
from . import oracle as o
from .q_io import BASE_RAW, SCAN_COLS, SCAN_SQL
from .registry import FEATURE_CTES, features, register

RAW_WITH_DT = T.StructType(schemas.RAW_BASE_CANDLE.fields + [T.StructField("dt", T.DateType())])


def _typed(df):
    return cdl.format_base_series(df, dedup_pulls=False, keep=["dt"]).select(*SCAN_COLS)


@register("stream_ingest", SCAN_SQL, dates=("dt",))
def q_stream_ingest(spark, sf_dir):
    """Landing JSON lines (with overlapping pulls) streamed into a typed
    day-partitioned layer, a few files per micro-batch."""
    src, sink, ck = (scratch_path(spark, n) for n in ("stream-src", "stream-sink", "stream-ck"))
    raw = fx.raw_base_records(fx.overlapping_pulls(fx.base_candles(spark, sf_dir, metrics=False)))
    raw.repartitionByRange(6, "ts_minute_utc").write.partitionBy("dt").json(src)
    q = streams.ingest_stream(spark, src, RAW_WITH_DT, sink, ck, transform=_typed,
                              max_files_per_trigger=3)
    q.awaitTermination()
    return spark.read.parquet(sink).select(*SCAN_COLS)


LATE_MINUTE = 17  # stream_dedup: minutes divisible by this arrive with the second run


@register("stream_dedup", o.with_(o.TICKS, BASE_RAW) + """
SELECT ts_minute_utc, symbol, close, ingested_at_utc, execution_date AS dt FROM base_c""",
          dates=("dt",))
def q_stream_dedup(spark, sf_dir):
    """Two runs of one stream. The first holds most minutes, the second the
    re-fetched candles (true duplicates of stored minutes) and minutes of
    every day that are new: duplicates go, new minutes stay however late."""
    src, table, ck = (scratch_path(spark, n) for n in ("dedup-src", "dedup-table", "dedup-ck"))
    c = fx.base_candles(spark, sf_dir, metrics=False)
    late = F.minute("ts_minute_utc") % LATE_MINUTE == 0
    cols = ["ts_minute_utc", "symbol", "close", "ingested_at_utc", "dt"]

    def run():
        raw = _typed(spark.readStream.schema(RAW_WITH_DT).json(src)).select(*cols)
        streams.dedup_stream(raw, ["symbol", "ts_minute_utc"], table, ck).awaitTermination()

    fx.raw_base_records(c.where(~late)).write.mode("append").partitionBy("dt").json(src)
    run()
    fx.raw_base_records(fx.refetched(c).unionByName(c.where(late))) \
        .write.mode("append").partitionBy("dt").json(src)
    run()
    return spark.read.parquet(table).select(*cols)


DEDUP_COLS = ["ts_minute_utc", "symbol", "close", "ingested_at_utc", "dt"]
NAMELESS_MINUTE = 13  # minutes divisible by this arrive once more without a symbol


@register("stream_dedup_bounded", o.with_(o.TICKS, BASE_RAW) + f"""
SELECT ts_minute_utc, symbol, close, ingested_at_utc, execution_date AS dt FROM base_c
UNION ALL
SELECT ts_minute_utc, NULL, close, ingested_at_utc, execution_date FROM base_c
WHERE minute(ts_minute_utc) % {NAMELESS_MINUTE} = 0""", dates=("dt",))
def q_stream_dedup_bounded(spark, sf_dir):
    """Two hours of keys in the state store. First most minutes by day, then
    their re-fetched candles, minutes of every day that are weeks late, late
    duplicates, and rows without a symbol, twice."""
    src, table, ck = (scratch_path(spark, n) for n in ("bd-src", "bd-table", "bd-ck"))
    c = fx.base_candles(spark, sf_dir, metrics=False).select(*DEDUP_COLS[:4],
                                                             F.col("execution_date").alias("dt"))
    late = F.minute("ts_minute_utc") % LATE_MINUTE == 0
    again = c.withColumns({"close": F.col("close") + 0.5, "ingested_at_utc":
                           F.timestamp_add("MINUTE", F.lit(fx.PULL_MINUTES), "ingested_at_utc")})
    nameless = c.where(F.minute("ts_minute_utc") % NAMELESS_MINUTE == 0) \
        .withColumn("symbol", F.lit(None).cast("string"))
    child = streams.stream_session(spark, 4)

    def run():
        s = child.readStream.schema(c.schema).option("maxFilesPerTrigger", 2).parquet(src)
        streams.bounded_dedup_stream(s, ["symbol", "ts_minute_utc"], table, ck,
                                     delay="2 hours").awaitTermination()

    c.where(~late).repartitionByRange(4, "ts_minute_utc").write.mode("append").parquet(src)
    run()
    c.where(late).unionByName(again).unionByName(nameless).unionByName(nameless) \
        .coalesce(1).write.mode("append").parquet(src)
    run()
    return streams.deduplicated(spark, table, c.schema, ["symbol", "ts_minute_utc"]) \
        .select(*DEDUP_COLS)


@register("stream_rollup", o.with_(o.TICKS, BASE_RAW) + """
SELECT symbol, ts_minute_utc, execution_date, open, high, low, close, volume, trades
FROM base_c""")
def q_stream_rollup(spark, sf_dir):
    """The events as a tick stream of several micro-batches, each with ticks
    of the whole month: every batch but the first brings late ticks."""
    src, table, ck = (scratch_path(spark, n) for n in ("tick-src", "rollup-table", "rollup-ck"))
    t = fx.ticks(spark, sf_dir).withColumn("symbol", F.lit("ALL"))
    t.repartition(3, "event_id").write.parquet(src)
    ticks = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(src)
    streams.rollup_stream(ticks, table, ck, order=fx.TICK_ORDER).awaitTermination()
    return spark.read.parquet(table).select("symbol", "ts_minute_utc", "execution_date", "open",
                                            "high", "low", "close", "volume", "trades")


@register("stream_features_upsert",
          o.with_(*FEATURE_CTES, o.features_sql()) + "SELECT * FROM features")
def q_stream_features_upsert(spark, sf_dir):
    """Both candle series arriving as files over several micro-batches (days
    split across batches, ref files behind base files): the table that the
    last batch leaves is the batch operator's on all rows."""
    root, base_t, ref_t, feat_t, ck = (scratch_path(spark, n) for n in (
        "feat-src", "feat-base", "feat-ref", "feat-table", "feat-ck"))
    base = fx.base_candles(spark, sf_dir)
    ref = fx.ref_candles(spark, sf_dir)
    base.repartitionByRange(4, "ts_minute_utc").write.parquet(f"{root}/base")
    ref.repartitionByRange(2, "ts_minute_utc").write.parquet(f"{root}/ref")
    stream = lambda df, n, k: (spark.readStream.schema(df.schema)
                               .option("maxFilesPerTrigger", k).parquet(f"{root}/{n}"))
    streams.features_stream(stream(base, "base", 2), stream(ref, "ref", 1), base_t, ref_t, feat_t,
                            ck).awaitTermination()
    cols = features(spark, sf_dir).columns
    return spark.read.parquet(feat_t).select(*cols)


RARE_MINUTE = 47  # minutes of the hour that arrive with the second run


@register("stream_features_changes",
          o.with_(*FEATURE_CTES, o.features_sql()) + "SELECT * FROM features")
def q_stream_features_changes(spark, sf_dir):
    """Most candles of both series first, a late minute of every hour of the
    month behind them: the second run recomputes only the rows that these
    minutes reach, and leaves the batch operator's table."""
    root, base_t, ref_t, feat_t, ck = (scratch_path(spark, n) for n in (
        "chg-src", "chg-base", "chg-ref", "chg-table", "chg-ck"))
    series = {"base": fx.base_candles(spark, sf_dir), "ref": fx.ref_candles(spark, sf_dir)}
    late = F.minute("ts_minute_utc") == RARE_MINUTE

    def run():
        read = [spark.readStream.schema(c.schema).parquet(f"{root}/{n}")
                for n, c in series.items()]
        streams.features_stream(*read, base_t, ref_t, feat_t, ck).awaitTermination()

    for arrived in (~late, late):
        for name, c in series.items():
            c.where(arrived).write.mode("append").parquet(f"{root}/{name}")
        run()
    return spark.read.parquet(feat_t).select(*features(spark, sf_dir).columns)
