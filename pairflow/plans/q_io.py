"""Registered queries: sources, sinks, payloads, formatters, dedup.

File round trips write under the session's checkpoint folder (shared
storage on a cluster) and read back what they wrote, so each query
exercises the real writer and reader on the whole derived table.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.time import epoch_ms_to_ts, floor_minute, iso_text, parse_ts
from ..operators import candles as cdl
from ..operators.candles import bucket_start
from ..operators.dedup import dedup
from ..operators.upsert import merge_append
from ..session import scratch_path
from ..sources import documents as docs
from ..sources import files, payloads, sinks
from . import fixtures as fx
from . import oracle as o
from .registry import FEATURE_CTES, features, register

# Fixed values of the landing scenarios.
FIRST_RUN_AS_OF = "2024-01-15"   # first loader run: this day was still filling
SECOND_RUN_AS_OF = "2024-01-30"  # second run
REWRITE_FROM = "2024-01-20"      # layer_roundtrip: days rewritten with revised closes
MERGE_SPLIT = "2024-01-15"       # merge_append: existing up to, incoming from this day
PARQUET_UNTIL = "2024-01-10"     # scan_by_extension: parquet up to this day,
CSV_UNTIL = "2024-01-20"         # csv up to this day, json after

# --- SQL building blocks -------------------------------------------------------

BASE_RAW = o.candles_cte("base", "ticks", "ALL", metrics=None)
BASE_OVERLAP = o.overlap_cte("bo", "base_c")
FORMATTED_BASE = """fmt AS (
  SELECT ts_minute_utc, symbol, '1m' AS interval, epoch_ms(ts_minute_utc) AS open_time_ms,
         ts_minute_utc AS open_time_utc, epoch_ms(ts_minute_utc) + 59999 AS close_time_ms,
         ts_minute_utc + INTERVAL 59999 MILLISECOND AS close_time_utc,
         open, high, low, close, volume, close * volume AS quote_asset_volume,
         trades AS number_of_trades, volume / 2 AS taker_buy_base_asset_volume,
         close * volume / 2 AS taker_buy_quote_asset_volume,
         high - low AS price_range, close - open AS price_change,
         CASE WHEN open <> 0 THEN (close - open) / open * 100 ELSE 0 END AS price_change_pct,
         close > open AS is_bullish, 'binance' AS source, ingested_at_utc, execution_date AS dt
  FROM bo)"""
SCAN_COLS = ["ts_minute_utc", "symbol", "open_time_ms", "close", "volume",
             "number_of_trades", "ingested_at_utc", "dt"]
SCAN_SQL = (o.with_(o.TICKS, BASE_RAW, BASE_OVERLAP, FORMATTED_BASE)
            + f"SELECT {', '.join(SCAN_COLS)} FROM fmt")


def _raw_base(spark, sf_dir, overlap: bool = True):
    c = fx.base_candles(spark, sf_dir, metrics=False)
    return fx.raw_base_records(fx.overlapping_pulls(c) if overlap else c)


def _typed_scan(df):
    """Formatted view of landed raw candles (every pulled row kept)."""
    return cdl.format_base_series(df, dedup_pulls=False, keep=["dt"]).select(*SCAN_COLS)


# --- A1-A4: landing files -------------------------------------------------------

@register("scan_json_candles", SCAN_SQL, dates=("dt",))
def q_scan_json_candles(spark, sf_dir):
    """Land each symbol-day as one JSON array file, read back (multiLine)."""
    path = scratch_path(spark, "landing-json")
    sinks.write_json_arrays(_raw_base(spark, sf_dir), path, group_cols=["symbol"])
    return _typed_scan(files.read_candles(spark, path, fmt="json"))


@register("scan_jsonl_candles", SCAN_SQL, dates=("dt",))
def q_scan_jsonl_candles(spark, sf_dir):
    path = scratch_path(spark, "landing-jsonl")
    sinks.write_json_lines(_raw_base(spark, sf_dir), path)
    return _typed_scan(files.read_candles(spark, path, fmt="jsonl"))


@register("scan_csv_candles", SCAN_SQL, dates=("dt",))
def q_scan_csv_candles(spark, sf_dir):
    path = scratch_path(spark, "landing-csv")
    _raw_base(spark, sf_dir).write.mode("overwrite").partitionBy("dt") \
        .option("header", True).csv(path)
    return _typed_scan(files.read_candles(spark, path, fmt="csv"))


@register("scan_auto", SCAN_SQL, dates=("dt",))
def q_scan_auto(spark, sf_dir):
    """JSON arrays and (different) CSV files side by side: JSON wins."""
    path = scratch_path(spark, "landing-auto")
    raw = _raw_base(spark, sf_dir)
    sinks.write_json_arrays(raw, path, group_cols=["symbol"])
    decoy = raw.withColumn("close", (F.col("close").cast("double") + 1).cast("string"))
    decoy.write.mode("append").partitionBy("dt").option("header", True).csv(path)
    return _typed_scan(files.read_candles(spark, path, fmt="auto"))


JSON_UNTIL, JSONL_UNTIL = "2024-01-10", "2024-01-20"  # scan_mixed_days: formats by day


@register("scan_mixed_days", SCAN_SQL, dates=("dt",))
def q_scan_mixed_days(spark, sf_dir):
    """One landing tree whose days hold JSON arrays, then JSON lines, then
    CSV; the earlier days also hold (different) CSV files, which lose."""
    path = scratch_path(spark, "landing-mixed")
    raw, dt = _raw_base(spark, sf_dir), F.col("dt")
    json_days = dt <= F.lit(JSON_UNTIL).cast("date")
    line_days = ~json_days & (dt <= F.lit(JSONL_UNTIL).cast("date"))
    sinks.write_json_arrays(raw.where(json_days), path, group_cols=["symbol"])
    sinks.write_json_lines(raw.where(line_days), path)
    decoy = raw.withColumn("close", (F.col("close").cast("double") + 1).cast("string"))
    (decoy.where(json_days | line_days).unionByName(raw.where(~json_days & ~line_days))
          .write.mode("append").partitionBy("dt").option("header", True).csv(path))
    return _typed_scan(files.read_candles(spark, path))


RUN_DAYS_SQL = o.with_(o.TICKS, BASE_RAW, BASE_OVERLAP) + """
, landed AS (
  SELECT symbol, ts_minute_utc, close, ingested_at_utc, execution_date AS dt FROM bo
  UNION ALL
  SELECT symbol, ts_minute_utc, close + 0.5, ingested_at_utc + INTERVAL 5 MINUTE,
         CAST(execution_date + INTERVAL 1 DAY AS DATE)
  FROM base_c WHERE hour(ts_minute_utc) = 23)
SELECT symbol, ts_minute_utc, close, ingested_at_utc, dt FROM landed
QUALIFY row_number() OVER (PARTITION BY symbol, ts_minute_utc, dt ORDER BY ingested_at_utc DESC) = 1"""


def _two_run_days(spark, sf_dir):
    """Pulls landed on their own day, and the last hour of a day landed again
    in the next day's folder with a revised close."""
    c = fx.base_candles(spark, sf_dir, metrics=False)
    late = c.where(F.hour("ts_minute_utc") == 23).withColumns({
        "close": F.col("close") + 0.5,
        "ingested_at_utc": F.timestamp_add("MINUTE", F.lit(5), F.col("ingested_at_utc"))})
    return fx.raw_base_records(fx.overlapping_pulls(c)).unionByName(
        fx.raw_base_records(late).withColumn("dt", F.date_add("dt", 1)))


@register("format_run_days", RUN_DAYS_SQL, dates=("dt",))
def q_format_run_days(spark, sf_dir):
    """Minutes in the folders of two run days keep a row for each."""
    f = cdl.format_base_series(_two_run_days(spark, sf_dir), keep=["dt"])
    return f.select("symbol", "ts_minute_utc", "close", "ingested_at_utc", "dt")


# --- A5, A9, A10, A12, B1, B2, B5, B9: layers and sinks ----------------------------

@register("scan_partitions", o.with_(*FEATURE_CTES, o.features_sql()) + "SELECT * FROM features")
def q_scan_partitions(spark, sf_dir):
    """Write the feature table as a day-partitioned layer, read it back."""
    path = scratch_path(spark, "usage-layer")
    sinks.write_layer(features(spark, sf_dir), path, "execution_date")
    return files.read_layer(spark, path, day_col="execution_date")


CANDLE_COLS = ["symbol", "ts_minute_utc", "execution_date", "open", "high", "low", "close",
               "volume", "trades", "ingested_at_utc"]


@register("scan_by_extension", o.with_(o.TICKS, BASE_RAW)
          + f"SELECT {', '.join(CANDLE_COLS)} FROM base_c")
def q_scan_by_extension(spark, sf_dir):
    """Parquet, CSV and JSON part files (plus an ignored text file) in one
    folder, read by extension with one schema."""
    path = scratch_path(spark, "mixed")
    c = fx.base_candles(spark, sf_dir, metrics=False).select(*CANDLE_COLS)
    d = F.col("execution_date")
    c.where(d <= F.lit(PARQUET_UNTIL).cast("date")).write.mode("append").parquet(path)
    c.where((d > F.lit(PARQUET_UNTIL).cast("date")) & (d <= F.lit(CSV_UNTIL).cast("date"))) \
        .write.mode("append").option("header", True).csv(path)
    c.where(d > F.lit(CSV_UNTIL).cast("date")).write.mode("append").json(path)
    c.select(F.to_json(F.struct(*CANDLE_COLS)).alias("value")).write.mode("append").text(path)
    return files.read_any(spark, path, T.StructType([schemas.CANDLE[c] for c in CANDLE_COLS]))


@register("partition_date", o.with_(o.TICKS, BASE_RAW)
          + "SELECT ts_minute_utc, symbol, close, execution_date AS dt FROM base_c", dates=("dt",))
def q_partition_date(spark, sf_dir):
    """Files under dt=… folders read without partition discovery; the day
    comes back from each row's file path."""
    path = scratch_path(spark, "dt-folders")
    c = fx.base_candles(spark, sf_dir, metrics=False)
    c.select("ts_minute_utc", "symbol", "close", F.col("execution_date").alias("dt")) \
        .write.mode("overwrite").partitionBy("dt").json(path)
    s = T.StructType([schemas.CANDLE["ts_minute_utc"], schemas.CANDLE["symbol"],
                      schemas.CANDLE["close"]])
    df = spark.read.schema(s).option("recursiveFileLookup", True).json(path)
    return files.with_partition_date(df).select("ts_minute_utc", "symbol", "close", "dt")


def _landed_layer(spark, sf_dir):
    path = scratch_path(spark, "formatted-layer")
    c = fx.base_candles(spark, sf_dir, metrics=False)
    sinks.write_layer(c.withColumn("dt", F.col("execution_date")), path, "dt")
    return path


def _first_run_ledger(spark, parts):
    empty = spark.createDataFrame([], sinks.LEDGER_SCHEMA)
    first = parts.where(F.col("dt") <= F.lit(FIRST_RUN_AS_OF).cast("date"))
    return sinks.mark_done(empty, first, "warehouse", FIRST_RUN_AS_OF)


@register("pending_partitions", o.with_(o.TICKS, BASE_RAW) + f"""
SELECT DISTINCT execution_date AS dt FROM base_c WHERE execution_date >= DATE '{FIRST_RUN_AS_OF}'""",
          dates=("dt",))
def q_pending_partitions(spark, sf_dir):
    """Day partitions the warehouse consumer has not processed after a
    first run on FIRST_RUN_AS_OF (that day itself stays pending)."""
    parts = files.partitions_of(spark, _landed_layer(spark, sf_dir))
    return sinks.pending_partitions(parts, _first_run_ledger(spark, parts), "warehouse")


@register("ledger_after_run", o.with_(o.TICKS, BASE_RAW) + f"""
SELECT DISTINCT 'warehouse' AS consumer, execution_date AS dt FROM base_c
WHERE execution_date <> DATE '{SECOND_RUN_AS_OF}'""", dates=("dt",))
def q_ledger_after_run(spark, sf_dir):
    """Ledger after a second run that processed every pending day."""
    parts = files.partitions_of(spark, _landed_layer(spark, sf_dir))
    ledger = _first_run_ledger(spark, parts)
    pending = sinks.pending_partitions(parts, ledger, "warehouse")
    return sinks.mark_done(ledger, pending, "warehouse", SECOND_RUN_AS_OF)


@register("layer_roundtrip", o.with_(o.TICKS, BASE_RAW) + f"""
SELECT ts_minute_utc, symbol,
       CASE WHEN execution_date >= DATE '{REWRITE_FROM}' THEN close + 0.5 ELSE close END AS close,
       execution_date AS dt FROM base_c""", dates=("dt",))
def q_layer_roundtrip(spark, sf_dir):
    """Write all days, then rewrite the days from REWRITE_FROM: only those
    partitions change (dynamic partition overwrite)."""
    path = scratch_path(spark, "layer")
    c = fx.base_candles(spark, sf_dir, metrics=False).select(
        "ts_minute_utc", "symbol", "close", F.col("execution_date").alias("dt"))
    sinks.write_layer(c, path, "dt")
    revised = c.where(F.col("dt") >= F.lit(REWRITE_FROM).cast("date")) \
        .withColumn("close", F.col("close") + 0.5)
    sinks.write_layer(revised, path, "dt")
    return files.read_layer(spark, path).select("ts_minute_utc", "symbol", "close", "dt")


@register("raw_json_roundtrip", SCAN_SQL, dates=("dt",))
def q_raw_json_roundtrip(spark, sf_dir):
    """Two appends of landing records (a full pull, then the re-fetched
    candles), read back: every pulled row is kept."""
    path = scratch_path(spark, "raw-append")
    c = fx.base_candles(spark, sf_dir, metrics=False)
    sinks.append_raw(fx.raw_base_records(c), path)
    sinks.append_raw(fx.raw_base_records(fx.refetched(c)), path)
    df = spark.read.schema(schemas.RAW_BASE_CANDLE).json(path)
    return _typed_scan(df)


@register("fallback_csv", o.with_(o.TICKS, BASE_RAW)
          + "SELECT symbol, ts_minute_utc, close, volume, execution_date FROM base_c")
def q_fallback_csv(spark, sf_dir):
    """A warehouse write that fails (no JDBC driver here) spills to CSV."""
    c = fx.base_candles(spark, sf_dir, metrics=False).select(
        "symbol", "ts_minute_utc", "close", "volume", "execution_date")
    opts = sinks.jdbc_options({"WAREHOUSE_HOST": "warehouse.invalid"})
    path = scratch_path(spark, "fallback")
    sinks.with_fallback(c, lambda d: sinks.write_jdbc(d, opts["url"], opts["table"],
                                                      opts["properties"]), path)
    return spark.read.schema(c.schema).option("header", True).csv(path)


DOC_SCHEMA = ("_index string, _id string, _source struct<ts_minute_utc: string, "
              "base_close: double, ref_close: double, ref_market_open: boolean, "
              "ref_return_1m: double, execution_date: string>")


@register("search_documents", o.with_(*FEATURE_CTES, o.features_sql()) + """
SELECT 'features' AS _index, strftime(ts_minute_utc, '%Y-%m-%d %H:%M:%S') AS _id,
       strftime(ts_minute_utc, '%Y-%m-%dT%H:%M:%S') AS ts_minute_utc, base_close, ref_close,
       ref_market_open, ref_return_1m, strftime(execution_date, '%Y-%m-%d') AS execution_date
FROM features""", dates=())
def q_search_documents(spark, sf_dir):
    """Feature rows exported as NDJSON search documents and read back."""
    path = scratch_path(spark, "documents")
    d = docs.to_documents(features(spark, sf_dir), ["ts_minute_utc"])
    docs.write_documents(d, path, index="features")
    back = spark.read.schema(DOC_SCHEMA).json(path)
    return back.select("_index", "_id", "_source.*")


# --- F8/H2/B3: dedup and merges -----------------------------------------------------

@register("dedup_latest", o.with_(o.TICKS, BASE_RAW, BASE_OVERLAP) + """
SELECT * FROM bo
QUALIFY row_number() OVER (PARTITION BY symbol, ts_minute_utc ORDER BY ingested_at_utc DESC) = 1""")
def q_dedup_latest(spark, sf_dir):
    """One row per (symbol, minute): the latest pull."""
    c = fx.overlapping_pulls(fx.base_candles(spark, sf_dir, metrics=False))
    return dedup(c, ["symbol", "ts_minute_utc"], ["ingested_at_utc"], keep="last")


@register("merge_append", o.with_(o.TICKS, o.REF) + f"""
, inc AS (SELECT * REPLACE (close + 0.5 AS close,
                           ingested_at_utc + INTERVAL 5 MINUTE AS ingested_at_utc)
          FROM ref_c WHERE execution_date >= DATE '{MERGE_SPLIT}')
SELECT * FROM ref_c WHERE execution_date <= DATE '{MERGE_SPLIT}'
UNION ALL
SELECT * FROM inc WHERE execution_date > DATE '{MERGE_SPLIT}'""")
def q_merge_append(spark, sf_dir):
    """Daily merge-append of the ref series: the day present on both sides
    keeps the existing rows."""
    r = fx.ref_candles(spark, sf_dir, metrics=False)
    d = F.col("execution_date")
    existing = r.where(d <= F.lit(MERGE_SPLIT).cast("date"))
    incoming = r.where(d >= F.lit(MERGE_SPLIT).cast("date")).withColumns({
        "close": F.col("close") + 0.5,
        "ingested_at_utc": F.timestamp_add("MINUTE", F.lit(5), F.col("ingested_at_utc"))})
    return merge_append(existing, incoming, ["symbol", "ts_minute_utc"], keep="existing")


FORMATTED_BASE_COLS = [c for c in schemas.FORMATTED_BASE_ORDER if c != "formatted_at_utc"]


@register("conform_candles", o.with_(o.TICKS, BASE_RAW, BASE_OVERLAP, FORMATTED_BASE) + """
SELECT * FROM fmt
QUALIFY row_number() OVER (PARTITION BY symbol, ts_minute_utc ORDER BY ingested_at_utc DESC) = 1""",
          dates=("dt",))
def q_conform_candles(spark, sf_dir):
    """Raw 24/7 candles (text, epoch ms, overlapping pulls) to the typed
    formatted layer: renames, casts, times, metrics, source, order, dedup."""
    return cdl.format_base_series(_raw_base(spark, sf_dir), keep=["dt"])


GAPPY_REF = o.candles_cte("gref", "gticks", "REF",
                          f"event_type = 'purchase' AND {o.in_session()}", metrics=None)
REF_OVERLAP = o.overlap_cte("ro", "gref_c")


@register("format_ref_series", o.with_(o.TICKS, o.GAPPY_TICKS, GAPPY_REF, REF_OVERLAP) + """
SELECT execution_date AS dt, ts_minute_utc, ts_minute_utc AS datetime_utc, open, high, low, close,
       volume, high - low AS price_range, close - open AS price_change,
       CASE WHEN open <> 0 THEN (close - open) / open * 100 ELSE 0 END AS price_change_pct,
       symbol, '1m' AS interval, 'yfinance' AS source, ingested_at_utc
FROM ro WHERE open IS NOT NULL AND close IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY ts_minute_utc, symbol ORDER BY ingested_at_utc DESC) = 1""",
          dates=("dt",))
def q_format_ref_series(spark, sf_dir):
    """Raw market-hours candles (CSV text with gaps and re-fetches) to the
    typed layer: rows without open/close dropped, latest fetch kept."""
    r = fx.ref_from(fx.gappy_ticks(spark, sf_dir))
    return cdl.format_ref_series(fx.raw_ref_records(fx.overlapping_pulls(r)))


# --- C3-C5: time functions -------------------------------------------------------------

@register("epoch_to_ts", o.with_(o.TICKS, BASE_RAW) + """
SELECT ts_minute_utc, epoch_ms(ts_minute_utc) AS open_time, ts_minute_utc AS open_time_utc,
       ts_minute_utc + INTERVAL 59999 MILLISECOND AS close_time_utc FROM base_c""", dates=())
def q_epoch_to_ts(spark, sf_dir):
    raw = _raw_base(spark, sf_dir, overlap=False)
    return raw.select(parse_ts("ts_minute_utc").alias("ts_minute_utc"), "open_time",
                      epoch_ms_to_ts("open_time").alias("open_time_utc"),
                      epoch_ms_to_ts("close_time").alias("close_time_utc"))


@register("parse_iso_ts", "SELECT event_id, ts, ts AS p_z, ts AS p_plus, ts AS p_minus, "
          "ts AS p_plain, ts AS p_hour, ts AS p_utc, CAST(NULL AS TIMESTAMP) AS p_zone "
          "FROM events", dates=())
def q_parse_iso_ts(spark, sf_dir):
    """ISO-8601 text in six spellings (Z, UTC, +05:30, -03:00, +05, no zone)
    parses back to the same UTC wall clock; a zone name gives NULL."""
    ev = fx.table(spark, sf_dir, "events").select("event_id", "ts")
    ts = F.col("ts")
    plus = ts + F.make_dt_interval(F.lit(0), F.lit(5), F.lit(30), F.lit(0))
    minus = ts - F.make_dt_interval(F.lit(0), F.lit(3), F.lit(0), F.lit(0))
    txt = ev.select("event_id", "ts", iso_text(ts, "Z").alias("t_z"),
                    iso_text(plus, "+05:30").alias("t_plus"),
                    iso_text(minus, "-03:00").alias("t_minus"),
                    iso_text(ts + F.make_dt_interval(F.lit(0), F.lit(5), F.lit(0), F.lit(0)), "+05")
                    .alias("t_hour"), iso_text(ts, " UTC").alias("t_utc"),
                    iso_text(ts, " America/New_York").alias("t_zone"),
                    ts.cast("string").alias("t_plain"))
    return txt.select("event_id", "ts", parse_ts("t_z").alias("p_z"),
                      parse_ts("t_plus").alias("p_plus"), parse_ts("t_minus").alias("p_minus"),
                      parse_ts("t_plain").alias("p_plain"), parse_ts("t_hour").alias("p_hour"),
                      parse_ts("t_utc").alias("p_utc"), parse_ts("t_zone").alias("p_zone"))


@register("floor_minute", "SELECT event_id, ts, date_trunc('minute', ts) AS ts_minute FROM events",
          dates=())
def q_floor_minute(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", floor_minute("ts").alias("ts_minute"))


# --- A7/A8: payloads --------------------------------------------------------------------

def _bad_day(col: str) -> str:
    return f"({col} IN (DATE '{fx.NO_SEED_DAYS[0]}', DATE '{fx.NO_SEED_DAYS[1]}'))"


KLINE_OUT = ["ts_minute_utc", "symbol", "open_time_ms", "open", "high", "low", "close", "volume",
             "number_of_trades", "quote_asset_volume"]


@register("parse_klines", o.with_(o.TICKS, BASE_RAW) + """
SELECT ts_minute_utc, symbol, epoch_ms(ts_minute_utc) AS open_time_ms, open, high, low, close,
       volume, trades AS number_of_trades, close * volume AS quote_asset_volume FROM base_c""",
          dates=())
def q_parse_klines(spark, sf_dir):
    """Each 5-minute pull as one positional-array payload, parsed back."""
    c = fx.base_candles(spark, sf_dir, metrics=False).withColumn(
        "pull", bucket_start("ts_minute_utc", fx.PULL_MINUTES))
    raw = fx.raw_base_records(c, extra=["pull"])
    arr = F.array(*[F.col(f).cast("string") for f in payloads.KLINE_FIELDS])
    pulls = (raw.groupBy("symbol", "pull")
                .agg(F.to_json(F.sort_array(F.collect_list(arr))).alias("payload"),
                     F.max("ingested_at_utc").alias("ingested_at_utc")))
    k = payloads.explode_klines(pulls, "payload", "symbol", ingested_col="ingested_at_utc")
    return cdl.format_base_series(k, dedup_pulls=False).select(*KLINE_OUT)


@register("parse_quotes", o.with_(o.TICKS, o.REF) + f"""
SELECT 'quote' AS kind, execution_date AS dt, ts_minute_utc AS datetime, open, high, low, close,
       volume, symbol, 'yfinance' AS source, TIMESTAMP '2024-02-01 00:00:00' AS fetched_at
FROM ref_c WHERE {_bad_day('execution_date')} = FALSE
UNION ALL
SELECT DISTINCT 'rejected', execution_date, NULL::TIMESTAMP, NULL::DOUBLE, NULL::DOUBLE,
       NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, symbol, NULL::VARCHAR, NULL::TIMESTAMP
FROM ref_c WHERE {_bad_day('execution_date')}""", dates=("dt",))
def q_parse_quotes(spark, sf_dir):
    """One quote payload per symbol-day. Two days answered with an error
    object without ``values``: they give no quotes and are returned as
    rejected."""
    r = fx.raw_ref_records(fx.ref_candles(spark, sf_dir, metrics=False))
    item = F.struct(*[F.col(c) for c in payloads.QUOTE_FIELDS])
    bad = F.col("dt").isin(*[F.lit(d).cast("date") for d in fx.NO_SEED_DAYS])
    p = (r.groupBy("symbol", "dt")
          .agg(F.to_json(F.struct(F.collect_list(item).alias("values"))).alias("payload"))
          .withColumn("payload", F.when(bad, F.lit('{"status": "error"}'))
                      .otherwise(F.col("payload"))))
    fetched = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    q = payloads.explode_quotes(p, "payload", "symbol", "yfinance", keep=["dt"],
                                fetched_at=fetched)
    lost = payloads.rejected_quotes(p, "payload").select("dt", "symbol", F.lit("rejected")
                                                         .alias("kind"))
    return q.withColumn("kind", F.lit("quote")).unionByName(lost, allowMissingColumns=True)
