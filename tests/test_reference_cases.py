"""Cases of the formatting stages on hand-made rows: payload normalisation (success, empty, malformed), formatting of
object-form raw candles, the raw market-hours rows, and the column and
value expectations of the formatted layer."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pairflow import schemas
from pairflow.operators import quality as qr
from pairflow.operators.candles import format_base_series, format_ref_series
from pairflow.sources import payloads

KLINES = [
    [1710000000000, "81.50", "83.25", "80.75", "82.00", "12.5", 1710000059999,
     "1025.0", 17, "6.25", "512.5", "0"],
    [1710000060000, "82.00", "82.50", "79.00", "79.50", "4.0", 1710000119999,
     "318.0", 9, "1.0", "79.5", "0"],
]


def payload_frame(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "payload string")


def test_klines_normalise_two_rows(spark):
    k = payloads.explode_klines(payload_frame(spark, json.dumps(KLINES)), "payload", "PAIR",
                                interval="1m")
    rows = sorted(k.collect(), key=lambda r: r["open_time"])
    assert len(rows) == 2
    assert rows[0]["open_time"] == 1710000000000 and rows[0]["close"] == "82.00"
    assert rows[0]["trades"] == 17 and rows[0]["symbol"] == "PAIR"
    assert rows[0]["interval"] == "1m"
    assert [r["ts_minute_utc"] for r in rows] == ["2024-03-09T16:00:00Z", "2024-03-09T16:01:00Z"]
    assert k.columns[:12] == list(payloads.KLINE_FIELDS)


@pytest.mark.parametrize("text", ["[]", "not json", '{"code": -1121, "msg": "Invalid symbol."}'])
def test_klines_empty_or_error_payload_gives_no_rows(spark, text):
    k = payloads.explode_klines(payload_frame(spark, text), "payload", "PAIR")
    assert k.count() == 0


def test_object_form_raw_candles_format(spark):
    """The object-form landing rows (text numerics, epoch-ms times, no
    minute key) through the 24/7 formatter."""
    raw = spark.createDataFrame([
        (*KLINES[0], "PAIR", "1m", "2024-03-09T16:01:00Z"),
        (*KLINES[1], "PAIR", "1m", "2024-03-09T16:02:00Z"),
    ], "open_time long, open string, high string, low string, close string, volume string, "
       "close_time long, quote_volume string, trades long, taker_buy_base string, "
       "taker_buy_quote string, ignore string, symbol string, interval string, "
       "ingested_at_utc string")
    f = format_base_series(raw)
    assert "ts_minute_utc" not in f.columns            # absent in input, absent in output
    assert f.columns[0] == "symbol" and f.columns[-1] == "ingested_at_utc"
    by_t = {r["open_time_ms"]: r for r in f.collect()}
    r0 = by_t[1710000000000]
    assert r0["open_time_utc"] == dt.datetime(2024, 3, 9, 16, 0)
    assert r0["close_time_utc"] == dt.datetime(2024, 3, 9, 16, 0, 59, 999000)
    assert r0["price_change_pct"] == pytest.approx(0.5 / 81.5 * 100)
    assert r0["is_bullish"] is True and by_t[1710000060000]["is_bullish"] is False
    assert r0["quote_asset_volume"] == 1025.0 and r0["number_of_trades"] == 17
    assert r0["source"] == "binance"
    report = {(x["rule"], x["column_name"]): x["violations"] for x in qr.expectations(
        f, [qr.positive(c) for c in ("open", "high", "low", "close", "volume")]
        + [qr.ordered_pair("high", "low")] + [qr.not_null(c) for c in ("open", "close")]).collect()}
    assert set(report.values()) == {0}


def test_raw_market_hours_rows_format(spark):
    raw = spark.createDataFrame([
        ("2024-03-08 15:30:00+00:00", "510.0", "514.0", "508.0", "512.0", "70.0",
         "2024-03-08T15:30:00Z", "IDX", "yfinance", "2024-03-08T15:31:00Z", "1m"),
        ("2024-03-08 15:30:00+00:00", "510.0", "514.0", "508.0", "513.5", "75.0",
         "2024-03-08T15:30:00Z", "IDX", "yfinance", "2024-03-08T15:36:00Z", "1m"),
        ("2024-03-08 15:31:00+00:00", None, "515.0", "509.0", "511.0", "8.0",
         "2024-03-08T15:31:00Z", "IDX", "yfinance", "2024-03-08T15:32:00Z", "1m"),
    ], schemas.RAW_REF_CANDLE)
    f = format_ref_series(raw).collect()
    assert len(f) == 1                                   # no open: dropped; re-fetch: latest kept
    (r,) = f
    assert r["close"] == 513.5 and r["dt"] == dt.date(2024, 3, 8)
    assert r["datetime_utc"] == dt.datetime(2024, 3, 8, 15, 30) == r["ts_minute_utc"]
    assert r["price_range"] == 6.0 and "is_bullish" not in r.asDict()


def test_quote_payload_shape(spark):
    body = {"values": [
        {"datetime": "2024-03-08 15:30:00", "open": "510", "high": "514", "low": "508",
         "close": "512.25", "volume": "70"},
        {"datetime": "2024-03-08 15:31:00", "open": "512", "high": "516", "low": "511",
         "close": "515.75", "volume": "80"}]}
    q = payloads.explode_quotes(payload_frame(spark, json.dumps(body), '{"values": []}'),
                                "payload", "IDX", "api")
    rows = sorted(q.collect(), key=lambda r: r["datetime"])
    assert [r["close"] for r in rows] == [512.25, 515.75]
    assert rows[0]["source"] == "api" and rows[0]["symbol"] == "IDX"
    assert q.where(F.col("volume").isNull()).count() == 0
