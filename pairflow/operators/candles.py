"""Candles: tick aggregation, candle metrics and the two formatters.

All of it is projection and hash aggregation, so it stays inside
whole-stage codegen. ``to_candles`` aggregates partially on the map side
(open/close are ``min_by``/``max_by`` over one ordering value), so only one
partial row per (symbol, bucket) and input partition crosses the shuffle,
however hot one symbol is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.numeric import pct_change_or_zero
from ..functions.time import col_of, epoch_ms_to_ts, floor_minute, parse_ts, ts_to_epoch_us
from .conform import conform
from .dedup import dedup


def bucket_start(ts, minutes: int = 1) -> Column:
    """Start of the ``minutes``-wide bucket holding ``ts`` (NTZ, zone-free).

    Buckets are aligned on midnight, so ``minutes`` must divide 1440.
    """
    if minutes < 1 or 1440 % minutes:
        raise ValueError("minutes must divide a day (1440)")
    m = floor_minute(ts)
    if minutes == 1:
        return m
    into_day = F.hour(m) * 60 + F.minute(m)
    return F.timestamp_add("MINUTE", -(into_day % F.lit(minutes)), m)


def tick_order(order: Sequence[str], schema: T.StructType) -> Column:
    """One ordering value for ``order``: a column itself, or a timestamp and
    an integer tie-break packed into one DECIMAL(38, 0) (microseconds times
    10^20 plus the id), which keeps aggregation buffers of fixed width."""
    if len(order) == 1:
        return F.col(order[0])
    ts, tie = order
    if not isinstance(schema[tie].dataType, T.IntegralType):
        raise ValueError("the tie-break column must be an integer")
    # offset 2^63 keeps negative ids in order; a missing id comes first
    return (
        ts_to_epoch_us(ts).cast("decimal(17,0)") * F.lit("1" + "0" * 20).cast("decimal(21,0)")
        + F.coalesce(F.col(tie).cast("decimal(20,0)"), F.lit(str(-2**63)).cast("decimal(20,0)"))
        + F.lit(str(2**63)).cast("decimal(20,0)")).cast("decimal(38,0)")


def to_candles(ticks: DataFrame, *, ts: str = "ts", price: str = "price",
               size: str | None = "size", symbol: str | Column = "symbol",
               order: Sequence[str] | str = "ts", minutes: int = 1) -> DataFrame:
    """Ticks to OHLCV candles: one row per (symbol, bucket).

    ``open``/``close`` are the first/last non-NULL price in ``order``;
    ``high``/``low`` ignore NULL prices; ``volume`` is the summed size
    (NULL when no size is given); ``trades`` counts every tick.

    ``order`` is the tick's timestamp, or (timestamp, integer id) to settle
    equal timestamps. Either way every aggregate has a fixed-width buffer and
    Spark plans a hash aggregation with map-side partial aggregation.
    """
    sym = F.lit(symbol) if isinstance(symbol, str) and symbol not in ticks.columns \
        else col_of(symbol)
    p = F.col(price).cast("double")
    order = [order] if isinstance(order, str) else list(order)
    ordering = F.when(p.isNotNull(), tick_order(order, ticks.schema))
    vol = F.col(size).cast("double") if size else F.lit(None).cast("double")
    return (
        ticks
        .select(sym.alias("symbol"), bucket_start(ts, minutes).alias("ts_minute_utc"),
                p.alias("_p"), ordering.alias("_o"), vol.alias("_v"))
        .groupBy("symbol", "ts_minute_utc")
        .agg(F.min_by("_p", "_o").alias("open"), F.max("_p").alias("high"),
             F.min("_p").alias("low"), F.max_by("_p", "_o").alias("close"),
             F.sum("_v").alias("volume"), F.count(F.lit(1)).alias("trades"))
        .select("symbol", "ts_minute_utc",
                F.col("ts_minute_utc").cast("date").alias("execution_date"),
                "open", "high", "low", "close", "volume", "trades")
    )


def candle_metrics(df: DataFrame, *, bullish: bool = True) -> DataFrame:
    """price_range, price_change, price_change_pct (0 when open is 0 or NULL)
    and optionally is_bullish, appended in one projection."""
    o, h, lo, c = F.col("open"), F.col("high"), F.col("low"), F.col("close")
    extra = [(h - lo).alias("price_range"), (c - o).alias("price_change"),
             pct_change_or_zero(c, o).alias("price_change_pct")]
    if bullish:
        extra.append((c > o).alias("is_bullish"))
    return df.select("*", *extra)


def format_base_series(raw: DataFrame, *, source: str = schemas.BASE_SOURCE_TAG,
                       dedup_pulls: bool = True, audit: bool = False,
                       keep: Sequence[str] = ()) -> DataFrame:
    """Raw 24/7 candles (text numerics, epoch-ms times) to the formatted layer.

    Presence-driven like the landing data: absent columns are skipped.
    ``dedup_pulls`` keeps the latest ingest of a (symbol, minute) when pulls
    overlap; False keeps every pulled row. ``keep`` names extra columns
    (e.g. the ``dt`` folder) carried after the formatted ones. They belong
    to the dedup key: a minute landed in the folders of two run days keeps a
    row for each, whether the days are formatted together or one by one.
    """
    df = conform(raw, renames=schemas.BASE_RENAMES, casts=schemas.BASE_CASTS)
    derived = {}
    if "open_time_ms" in df.columns:
        derived["open_time_utc"] = epoch_ms_to_ts("open_time_ms")
    if "close_time_ms" in df.columns:
        derived["close_time_utc"] = epoch_ms_to_ts("close_time_ms")
    if "ts_minute_utc" in df.columns:
        derived["ts_minute_utc"] = parse_ts("ts_minute_utc")
    if "ingested_at_utc" in df.columns:
        derived["ingested_at_utc"] = parse_ts("ingested_at_utc")
    if derived:
        df = df.withColumns(derived)
    df = candle_metrics(df, bullish=True)
    if audit:
        df = df.withColumn("formatted_at_utc", F.current_timestamp())
    df = conform(df, defaults={"source": F.lit(source)},
                 order=[*schemas.FORMATTED_BASE_ORDER, *keep])
    if dedup_pulls and {"ts_minute_utc", "symbol"} <= set(df.columns):
        order = ["ingested_at_utc"] if "ingested_at_utc" in df.columns else []
        df = dedup(df, ["symbol", "ts_minute_utc", *keep], order, keep="last")
    return df


def format_ref_series(raw: DataFrame, *, dt=None, audit: bool = False) -> DataFrame:
    """Raw market-hours candles (CSV text) to the formatted layer.

    Rows missing ts/open/close are dropped and a (run day, minute, symbol)
    keeps its latest ingest. ``dt`` (a value or a column, e.g. the landing
    folder's day) defaults to the calendar day of the minute.
    """
    ts = parse_ts("ts_minute_utc")
    df = raw.select(
        (ts.cast("date") if dt is None else dt.cast("date") if isinstance(dt, Column)
         else F.lit(dt).cast("date")).alias("dt"),
        ts.alias("ts_minute_utc"),
        parse_ts("datetime").alias("datetime_utc"),
        *[F.col(c).try_cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")],
        F.col("symbol").cast("string").alias("symbol"),
        F.col("interval").cast("string").alias("interval"),
        F.col("source").cast("string").alias("source"),
        parse_ts("ingested_at_utc").alias("ingested_at_utc"),
    )
    df = candle_metrics(df, bullish=False)
    if audit:
        df = df.withColumn("formatted_at_utc", F.current_timestamp())
    df = conform(df, order=schemas.FORMATTED_REF_ORDER)
    df = df.dropna(subset=["ts_minute_utc", "open", "close"])
    return dedup(df, ["dt", "ts_minute_utc", "symbol"], ["ingested_at_utc"], keep="last")
