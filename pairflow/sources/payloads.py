"""API payloads landed as text: positional kline arrays and quote objects.

Parsing is ``from_json`` + ``explode``: it runs per row inside the scan
stage, so payload files of any number and size parallelise with the input
splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import epoch_ms_to_ts, floor_minute, parse_ts

# Field order of a positional kline array.
KLINE_FIELDS = ("open_time", "open", "high", "low", "close", "volume", "close_time",
                "quote_volume", "trades", "taker_buy_base", "taker_buy_quote", "ignore")
KLINE_LONGS = ("open_time", "close_time", "trades")

QUOTE_FIELDS = ("datetime", "open", "high", "low", "close", "volume")


def iso_minute_text(ts: Column) -> Column:
    """NTZ minute as ``YYYY-MM-DDTHH:MM:SSZ`` (zone-free formatting)."""
    return F.concat(F.regexp_replace(F.substring(ts.cast("string"), 1, 19), " ", "T"), F.lit("Z"))


def explode_klines(df: DataFrame, payload_col: str, symbol, interval: str = "1m",
                   ingested_col: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """A text column holding ``[[open_time, "open", …, "ignore"], …]`` to one
    record per kline with the raw 16-field shape: text numerics, epoch-ms
    times, symbol, interval, ingest time and the minute key as ISO text."""
    sym = F.col(symbol) if isinstance(symbol, str) and symbol in df.columns else F.lit(symbol)
    arr = F.from_json(F.col(payload_col), "array<array<string>>")
    x = df.select(*keep, sym.alias("_sym"),
                  (F.col(ingested_col) if ingested_col else F.lit(None).cast("string"))
                  .alias("_ing"), F.explode(arr).alias("_k"))
    fields = []
    for i, name in enumerate(KLINE_FIELDS, start=1):
        v = F.element_at("_k", i)
        fields.append((v.try_cast("bigint") if name in KLINE_LONGS else v).alias(name))
    minute = iso_minute_text(floor_minute(epoch_ms_to_ts(F.element_at("_k", 1))))
    return x.select(*keep, *fields, F.col("_sym").alias("symbol"),
                    F.lit(interval).alias("interval"),
                    F.col("_ing").cast("string").alias("ingested_at_utc"),
                    minute.alias("ts_minute_utc"))


QUOTE_PAYLOAD = ("struct<values: array<struct<datetime: string, open: string, high: string, "
                 "low: string, close: string, volume: string>>>")


def explode_quotes(df: DataFrame, payload_col: str, symbol, source: str,
                   keep: Sequence[str] = (), fetched_at: Column | None = None) -> DataFrame:
    """``{"values": [{"datetime", "open", …}, …]}`` to typed rows with a
    source tag and, on request, the time of the fetch (a column of ``df``, or
    ``current_timestamp()`` for a live pull); payloads without ``values``
    yield no rows (see ``rejected_quotes``)."""
    sym = F.col(symbol) if isinstance(symbol, str) and symbol in df.columns else F.lit(symbol)
    fetched = [] if fetched_at is None else [fetched_at.alias("fetched_at")]
    names = [*keep, "_sym", *(["fetched_at"] if fetched else [])]
    parsed = df.select(*keep, sym.alias("_sym"), *fetched,
                       F.from_json(F.col(payload_col), QUOTE_PAYLOAD).alias("_p"))
    x = parsed.select(*names, F.explode("_p.values").alias("_q"))
    dt = parse_ts(F.col("_q.datetime"))
    return x.select(*keep, dt.alias("datetime"),
                    *[F.col(f"_q.{c}").try_cast("double").alias(c)
                      for c in QUOTE_FIELDS if c != "datetime"],
                    F.col("_sym").alias("symbol"), F.lit(source).alias("source"),
                    *(["fetched_at"] if fetched else []))


def rejected_quotes(df: DataFrame, payload_col: str) -> DataFrame:
    """Payload rows that have no ``values`` array (the error case)."""
    p = F.from_json(F.col(payload_col), QUOTE_PAYLOAD)
    return df.where(p.isNull() | p.getField("values").isNull())
