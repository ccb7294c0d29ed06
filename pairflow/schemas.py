"""Explicit StructTypes: no schema inference job on any read path."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, B = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()
NTZ, DATE = T.TimestampNTZType(), T.DateType()


def struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# One-minute candle as produced by to_candles() (the library's canonical form).
CANDLE = struct(
    ("symbol", S), ("ts_minute_utc", NTZ), ("execution_date", DATE),
    ("open", D), ("high", D), ("low", D), ("close", D), ("volume", D),
    ("trades", L), ("ingested_at_utc", NTZ),
)

# Raw 24/7 candle as landed by an exchange pull: numerics arrive as text,
# times as epoch milliseconds.
RAW_BASE_CANDLE = struct(
    ("open_time", L), ("open", S), ("high", S), ("low", S), ("close", S),
    ("volume", S), ("close_time", L), ("quote_volume", S), ("trades", L),
    ("taker_buy_base", S), ("taker_buy_quote", S), ("ignore", S),
    ("symbol", S), ("interval", S), ("ingested_at_utc", S), ("ts_minute_utc", S),
)

# Raw market-hours candle as landed by a quote pull (CSV text).
RAW_REF_CANDLE = struct(
    ("datetime", S), ("open", S), ("high", S), ("low", S), ("close", S),
    ("volume", S), ("ts_minute_utc", S), ("symbol", S), ("source", S),
    ("ingested_at_utc", S), ("interval", S),
)

# Fixed values (must equal the reference's for the same results): the column
# orders of the two formatted layers, the rename map and target types of the
# 24/7 candle formatter, and the source tag it adds when none is present.

# Column order of a formatted 24/7 candle layer (present columns only).
FORMATTED_BASE_ORDER = [
    "ts_minute_utc", "symbol", "interval", "open_time_ms", "open_time_utc",
    "close_time_ms", "close_time_utc", "open", "high", "low", "close", "volume",
    "quote_asset_volume", "number_of_trades", "taker_buy_base_asset_volume",
    "taker_buy_quote_asset_volume", "price_range", "price_change",
    "price_change_pct", "is_bullish", "source", "ingested_at_utc",
    "formatted_at_utc",
]

# Column order of a formatted market-hours candle layer.
FORMATTED_REF_ORDER = [
    "dt", "ts_minute_utc", "datetime_utc", "open", "high", "low", "close",
    "volume", "price_range", "price_change", "price_change_pct", "symbol",
    "interval", "source", "ingested_at_utc", "formatted_at_utc",
]

BASE_SOURCE_TAG = "binance"
BASE_RENAMES = {
    "quote_volume": "quote_asset_volume",
    "taker_buy_base": "taker_buy_base_asset_volume",
    "taker_buy_quote": "taker_buy_quote_asset_volume",
    "open_time": "open_time_ms",
    "close_time": "close_time_ms",
    "trades": "number_of_trades",
}
BASE_CASTS = {
    "open": "double", "high": "double", "low": "double", "close": "double",
    "volume": "double", "quote_asset_volume": "double",
    "number_of_trades": "bigint", "taker_buy_base_asset_volume": "double",
    "taker_buy_quote_asset_volume": "double", "open_time_ms": "bigint",
    "close_time_ms": "bigint",
}

# Schemas of the driver's tables, declared so reads run no inference job
# (their Parquet timestamps are naive, i.e. TIMESTAMP_NTZ).
I = T.IntegerType()
DRIVER_TABLES = {
    "events": struct(("event_id", L), ("ts", NTZ), ("user_id", L), ("event_type", S),
                     ("value", D), ("props", S)),
    "orders": struct(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S),
                     ("o_totalprice", D), ("o_orderdate", NTZ), ("o_orderpriority", S)),
    "customer": struct(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
                       ("c_mktsegment", S)),
    "lineitem": struct(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L),
                       ("l_linenumber", I), ("l_quantity", D), ("l_extendedprice", D),
                       ("l_discount", D), ("l_tax", D), ("l_returnflag", S),
                       ("l_linestatus", S), ("l_shipdate", NTZ)),
    "nation": struct(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "region": struct(("r_regionkey", I), ("r_name", S)),
    "supplier": struct(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": struct(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S),
                   ("p_size", I), ("p_retailprice", D)),
}
