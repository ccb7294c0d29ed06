"""Registered queries: one per operator of the inventory.

Each query is ``(spark, sf_dir) -> DataFrame`` over the whole driver
tables (or what Spark derives from them); its SQL twin lives in ORACLE
under the same key. Queries without a twin are checked against a
brute-force computation in the tests instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import candles as cdl
from ..operators import pairing
from . import fixtures as fx
from . import models
from . import oracle as o

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def checkable(df: DataFrame) -> DataFrame:
    """Present DATE columns as midnight TIMESTAMP_NTZ.

    Both engines turn a timestamp into the same Python/pandas value under
    every conversion path; DATE is a ``date`` on one side and a timestamp
    on the other once pandas is involved. The operators themselves keep
    DATE; only the registered projections change.
    """
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    if not dates:
        return df
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in dates})


def register(key: str, sql: str | None = None, dates: tuple[str, ...] = ("execution_date",)):
    """Register a query; its SQL twin gets the same DATE presentation for
    the columns in ``dates`` that it returns."""
    def deco(fn: Query) -> Query:
        QUERIES[key] = lambda spark, sf_dir: checkable(fn(spark, sf_dir))
        QUERIES[key].__doc__ = fn.__doc__
        QUERIES[key].__name__ = fn.__name__
        if sql is not None:
            ORACLE[key] = present_dates(sql, dates)
        return fn
    return deco


def present_dates(sql: str, dates: tuple[str, ...]) -> str:
    if not dates:
        return sql
    rep = ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in dates)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"


# --- shared derivations -------------------------------------------------------

def features(spark: SparkSession, sf_dir: str, seed: str = "previous_day",
             scenario: bool = False) -> DataFrame:
    """The feature table over the whole events table; ``scenario`` replaces
    the ref series by the one with the calendar's edge cases."""
    base = fx.base_candles(spark, sf_dir)
    ref = fx.ref_candles(spark, sf_dir)
    if scenario:
        ref = fx.scenario_ref(ref)
    return pairing.lead_lag_features(base, ref, max_lag=5, seed=seed)


FEATURE_CTES = [o.TICKS, o.BASE, o.REF, o.SCENARIO_REF]


def feat_sql(select: str, seed: str = "previous_day", ref_name: str = "ref",
             extra: tuple[str, ...] = ()) -> str:
    return o.with_(*FEATURE_CTES, o.features_sql(ref_name=ref_name, seed=seed), *extra) + select


# --- E8 / C6: candles -----------------------------------------------------------

@register("ohlcv_candles", o.with_(o.TICKS, o.GAPPY_TICKS, o.GAPPY) + """
SELECT symbol, ts_minute_utc, execution_date, open, high, low, close, volume, trades,
       ingested_at_utc
FROM gappy""")
def q_ohlcv_candles(spark, sf_dir):
    return fx.gappy_candles(spark, sf_dir)


@register("candle_metrics", o.with_(o.TICKS, o.GAPPY_TICKS, o.GAPPY) + """
SELECT symbol, ts_minute_utc, open, close, high - low AS price_range,
       close - open AS price_change,
       CASE WHEN open <> 0 THEN (close - open) / open * 100 ELSE 0 END AS price_change_pct,
       close > open AS is_bullish
FROM gappy""", dates=())
def q_candle_metrics(spark, sf_dir):
    c = cdl.candle_metrics(fx.gappy_candles(spark, sf_dir))
    return c.select("symbol", "ts_minute_utc", "open", "close", "price_range",
                    "price_change", "price_change_pct", "is_bullish")


@register("candle_ties", o.with_(o.TICKS, """tticks AS (
  SELECT event_id, date_trunc('hour', ts) AS ts, event_type, price, size FROM ticks)""",
                                 o.candles_cte("tied", "tticks", "ALL", metrics=None)) + """
SELECT symbol, ts_minute_utc, execution_date, open, high, low, close, volume, trades
FROM tied""")
def q_candle_ties(spark, sf_dir):
    """Ticks of an hour that all carry the hour's timestamp: the event id
    alone decides open and close."""
    t = fx.ticks(spark, sf_dir)
    hour = F.timestamp_add("HOUR", F.hour("ts"), F.col("ts").cast("date").cast("timestamp_ntz"))
    return cdl.to_candles(t.withColumn("ts", hour), symbol="ALL", order=fx.TICK_ORDER)


# --- D1: pair join --------------------------------------------------------------

@register("pair_join", o.with_(o.TICKS, o.BASE, o.REF) + """
SELECT b.execution_date, b.ts_minute_utc, b.close AS base_close, b.volume AS base_volume,
       b.high AS base_high, b.low AS base_low, b.price_change_pct AS base_change_pct,
       r.close AS ref_close, r.volume AS ref_volume, r.high AS ref_high, r.low AS ref_low,
       r.close IS NOT NULL AS ref_market_open
FROM base b LEFT JOIN ref r
  ON r.execution_date = b.execution_date AND r.ts_minute_utc = b.ts_minute_utc""")
def q_pair_join(spark, sf_dir):
    return pairing.pair_join(fx.base_candles(spark, sf_dir), fx.ref_candles(spark, sf_dir))


def _twice(c):
    """Every candle, and those of even minutes again with another close."""
    again = c.where(F.minute("ts_minute_utc") % 2 == 0).withColumns(
        {"close": F.col("close") + 0.25, "volume": F.col("volume") + 1.0})
    return c.unionByName(again)


@register("pair_join_duplicates", o.with_(o.TICKS, o.BASE, o.REF, *[f"""{n}2 AS (
  SELECT * FROM {n} UNION ALL
  SELECT * REPLACE (close + 0.25 AS close, volume + 1.0 AS volume) FROM {n}
  WHERE minute(ts_minute_utc) % 2 = 0)""" for n in ("base", "ref")]) + """
SELECT b.execution_date, b.ts_minute_utc, b.close AS base_close, b.volume AS base_volume,
       r.close AS ref_close, r.volume AS ref_volume, r.close IS NOT NULL AS ref_market_open
FROM base2 b LEFT JOIN ref2 r
  ON r.execution_date = b.execution_date AND r.ts_minute_utc = b.ts_minute_utc""")
def q_pair_join_duplicates(spark, sf_dir):
    """Repeated minutes on both sides: every pair of rows of a minute stays,
    and no row mixes the columns of two."""
    j = pairing.pair_join(_twice(fx.base_candles(spark, sf_dir)),
                          _twice(fx.ref_candles(spark, sf_dir)))
    return j.select("execution_date", "ts_minute_utc", "base_close", "base_volume", "ref_close",
                    "ref_volume", "ref_market_open")


# --- F1-F6, D2, D3, C12: the feature table -------------------------------------

@register("lead_lag_features", feat_sql("SELECT * FROM features"))
def q_lead_lag_features(spark, sf_dir):
    return features(spark, sf_dir)


# --- E1 --------------------------------------------------------------------------

@register("daily_correlation", feat_sql(f"""
SELECT execution_date, count(*) AS record_count,
       round(CASE WHEN stddev_samp(base_return_1m) * stddev_samp(ref_return_1m) <> 0
                  THEN covar_samp(base_return_1m, ref_return_1m)
                       / (stddev_samp(base_return_1m) * stddev_samp(ref_return_1m)) END,
             {o.ROUND}) AS correlation_1m,
       round(avg(base_return_1m), {o.ROUND}) AS avg_base_return,
       round(avg(ref_return_1m), {o.ROUND}) AS avg_ref_return,
       round(stddev_samp(base_return_1m), {o.ROUND}) AS stddev_base_return,
       round(stddev_samp(ref_return_1m), {o.ROUND}) AS stddev_ref_return
FROM features
WHERE base_return_1m IS NOT NULL AND ref_return_1m IS NOT NULL
GROUP BY execution_date
ORDER BY execution_date DESC"""))
def q_daily_correlation(spark, sf_dir):
    return models.daily_correlation(features(spark, sf_dir))


# Themed query modules register themselves on import.
from . import q_io, q_jobs, q_models, q_stream, q_upsert, q_volume  # noqa: E402,F401
