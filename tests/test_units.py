"""Unit checks of helpers that the registered queries do not isolate."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pairflow.functions.time import floor_minute, minutes_between, parse_ts, ts_to_epoch_ms
from pairflow.operators.candles import format_base_series
from pairflow.operators.conform import conform, lower_columns, require_columns
from pairflow.operators.pairing import lead_lag_features
from pairflow.operators.reports import locf_completeness, observed
from pairflow.operators.upsert import resolve_key
from pairflow.plans import fixtures as fx
from pairflow.plans.models import materialize
from pairflow.session import scratch_path
from pairflow.sources import documents as docs
from pairflow.sources import files, payloads, sinks


def test_jdbc_options_from_environment():
    o = sinks.jdbc_options({"WAREHOUSE_HOST": "db", "WAREHOUSE_PORT": "6543",
                            "WAREHOUSE_DB": "dl", "WAREHOUSE_USER": "u"})
    assert o["url"] == "jdbc:postgresql://db:6543/dl"
    assert o["properties"]["user"] == "u" and o["table"] == "lead_lag_features"
    assert sinks.jdbc_options({})["url"] == "jdbc:postgresql://localhost:5432/warehouse"


def test_resolve_key_prefers_primary_then_unique():
    assert resolve_key([["id"], ["ts", "day"]], ["ts", "day", "x"]) == ["ts", "day"]
    assert resolve_key([["id"], ["ts", "day"]], ["id", "ts"]) == ["id"]
    assert resolve_key([["id"]], ["x"]) is None


def test_require_columns_and_lowering(spark):
    df = spark.createDataFrame([(1, 2.0)], "Date int, Close double")
    low = lower_columns(df, {"date": "datetime"})
    assert low.columns == ["datetime", "close"]
    with pytest.raises(ValueError):
        require_columns(low, ["datetime", "open"])


def test_conform_fixed_schema_fills_missing(spark):
    df = spark.createDataFrame([("1.5", "x")], "a string, b string")
    out = conform(df, renames={"b": "c", "zz": "y"}, casts={"a": "double", "d": "bigint"},
                  order=["a", "c", "d"], fill_missing=True)
    assert out.dtypes == [("a", "double"), ("c", "string"), ("d", "bigint")]
    assert out.first() == (1.5, "x", None)


def test_parse_ts_variants_are_zone_free(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-03-10T02:30:00Z",), ("2024-03-10 07:30:00+05:00",),
                                    ("garbage",)], "s string")
        got = [r[0] for r in df.select(parse_ts("s")).collect()]
        assert got == [dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 10, 2, 30), None]
        t = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 45),)], "ts timestamp_ntz")
        (m, ms) = t.select(floor_minute("ts"), ts_to_epoch_ms("ts")).first()
        assert m == dt.datetime(2024, 3, 10, 2, 30) and ms == 1710037845000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_minutes_between(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 0, 0), dt.datetime(2024, 1, 1, 22, 30))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(minutes_between("a", "b")).first()[0] == 90


def test_klines_accept_numeric_tokens(spark):
    payload = json.dumps([[1704067200000, "42000.00", "42100.00", "41900.00", "42050.00",
                           "100.5", 1704067259999, "4225275.00", 1500, "50.25",
                           "2112637.50", "0"]])
    df = spark.createDataFrame([(payload,)], "p string")
    k = payloads.explode_klines(df, "p", "BTCUSDT", ingested_col=None)
    f = format_base_series(k).first()
    assert f["open_time_ms"] == 1704067200000 and f["close"] == 42050.0
    assert f["number_of_trades"] == 1500
    assert f["ts_minute_utc"] == dt.datetime(2024, 1, 1)
    assert f["price_change_pct"] == pytest.approx(50 / 42000 * 100)
    assert f["source"] == "binance" and f["is_bullish"] is True


def test_quotes_without_values_are_rejected(spark):
    df = spark.createDataFrame([('{"values": [{"datetime": "2024-01-01 00:00:00", "open": "1",'
                                 ' "high": "2", "low": "0.5", "close": "1.5", "volume": "9"}]}',),
                                ('{"status": "error"}',)], "p string")
    assert payloads.explode_quotes(df, "p", "NDAQ", "yfinance").count() == 1
    assert payloads.rejected_quotes(df, "p").count() == 1


def test_detect_format_and_missing_input(spark):
    path = scratch_path(spark, "empty-landing")
    spark.createDataFrame([("x",)], "value string").write.text(path)
    with pytest.raises(FileNotFoundError):
        files.read_candles(spark, path)


def test_read_layer_optional_missing_is_empty(spark):
    from pairflow.schemas import CANDLE
    df = files.read_layer(spark, scratch_path(spark, "nothing"), schema=CANDLE, required=False)
    assert df.count() == 0 and df.columns == CANDLE.fieldNames()
    with pytest.raises(FileNotFoundError):
        files.read_layer(spark, scratch_path(spark, "nothing"))


def test_audit_columns_present_when_asked(spark, sf_dir):
    base, ref = fx.base_candles(spark, sf_dir), fx.ref_candles(spark, sf_dir)
    f = lead_lag_features(base, ref, audit=True)
    assert "processed_at_utc" in f.columns and f.columns[-1] == "execution_date"
    assert len(f.columns) == 40


def test_locf_completeness_as_of_keeps_one_day(spark, sf_dir):
    f = lead_lag_features(fx.base_candles(spark, sf_dir), fx.ref_candles(spark, sf_dir))
    days = {r[0] for r in locf_completeness(f, as_of="2024-01-05").select("execution_date").collect()}
    assert days == {dt.date(2024, 1, 5)}


def test_observed_metrics_come_with_the_action(spark, sf_dir):
    c = fx.base_candles(spark, sf_dir)
    o, obs = observed(c, "profile")
    o.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == c.count()


def test_materialize_table_and_export_json(spark, sf_dir):
    c = fx.base_candles(spark, sf_dir, metrics=False)
    t = materialize(c, "candles_tbl", kind="table")
    assert t.count() == c.count()
    path = scratch_path(spark, "export")
    docs.export_json(c.withColumn("close", F.lit(float("nan"))), path)
    back = spark.read.json(path)
    assert back.where(F.col("close").isNotNull()).count() == 0
    assert back.count() == c.count()


def test_fallback_uses_primary_when_it_succeeds(spark):
    df = spark.createDataFrame([(1,)], "a int")
    seen = []
    assert sinks.with_fallback(df, lambda d: seen.append(d.count()), "/nonexistent") == (
        "primary", None)
    assert seen == [1]


def test_fallback_returns_the_error(spark):
    df = spark.createDataFrame([(1,)], "a int")

    def fails(d):
        raise OSError("no route")

    path = scratch_path(spark, "spill")
    kind, error = sinks.with_fallback(df, fails, path)
    assert kind == "fallback" and "no route" in str(error)
    assert spark.read.option("header", True).csv(path).count() == 1


def test_readme_quick_start_with_reference_prefixes(spark, sf_dir):
    import pairflow as pf
    ticks = fx.ticks(spark, sf_dir).withColumn(
        "symbol", F.when(F.col("event_type") == "purchase", "NDAQ").otherwise("BTCUSDT"))
    base = pf.candle_metrics(pf.to_candles(ticks.where("symbol = 'BTCUSDT'")))
    ref = pf.candle_metrics(pf.to_candles(ticks.where("symbol = 'NDAQ'")), bullish=False)
    features = pf.lead_lag_features(base, ref, max_lag=5, seed="previous_day",
                                    prefixes=("btc", "ndaq"))
    assert {"btc_close_lag_5", "ndaq_close_lead_5", "ndaq_market_open"} <= set(features.columns)
    assert pf.daily_correlation(features, "btc", "ndaq").count() > 0
    mart = pf.enriched(pf.aligned(pf.staging(features, "btc", "ndaq"), rp="ndaq"), "btc", "ndaq")
    assert mart.count() > 0 and "ndaq_close_lead_1" in mart.columns


def test_with_audit_columns(spark, sf_dir):
    from pairflow.operators.conform import with_audit
    df = with_audit(spark.read.parquet(f"{sf_dir}/region.parquet"), source_col="source_file",
                    run_date="2024-01-02")
    r = df.first()
    assert r["source_file"].endswith("region.parquet")
    assert r["execution_date"] == dt.date(2024, 1, 2) and r["processed_at_utc"] is not None


def test_register_views_for_sql_users(spark, sf_dir):
    from pairflow.plans.models import aligned, daily_correlation, enriched, register_views, staging
    f = lead_lag_features(fx.base_candles(spark, sf_dir),
                          fx.scenario_ref(fx.ref_candles(spark, sf_dir)))
    register_views(f)
    corr = spark.sql("SELECT * FROM daily_correlation")
    assert corr.exceptAll(daily_correlation(f)).count() == 0
    en = spark.sql("SELECT * FROM enriched_mart")
    assert en.exceptAll(enriched(aligned(staging(f)))).count() == 0
    n_open = spark.sql("SELECT count(*) FROM aligned_market_open").first()[0]
    assert n_open == f.where("ref_market_open").count()


def test_auto_format_prefers_jsonl_over_csv(spark, sf_dir):
    raw = fx.raw_base_records(fx.base_candles(spark, sf_dir, metrics=False))
    path = scratch_path(spark, "auto-jsonl")
    sinks.write_json_lines(raw, path)
    raw.withColumn("close", F.lit("-1")).write.mode("append").partitionBy("dt") \
        .option("header", True).csv(path)
    assert set(files.landed_formats(spark, path).values()) == {"jsonl"}
    got = files.read_candles(spark, path)
    assert got.count() == raw.count() and got.where("close = '-1'").count() == 0


def test_scratch_roots_with_a_scheme_stay_where_they_are(spark):
    import os
    from pairflow.session import absolute_root
    for uri in ("file:/tmp/ck/abc", "hdfs://nn:8020/ck", "s3a://bucket/ck", "/tmp/ck"):
        assert absolute_root(uri) == uri
    assert absolute_root("rel/ck") == os.path.join(os.getcwd(), "rel/ck")
    assert not scratch_path(spark, "x").startswith(os.getcwd() + "/file:")


def test_remove_path_deletes_a_scratch_table(spark):
    path = scratch_path(spark, "left-over")
    spark.createDataFrame([(1,)], "a int").write.parquet(path)
    assert files.path_exists(spark, path)
    sinks.remove_path(spark, path)
    assert not files.path_exists(spark, path)
