"""End-to-end run of the path-level jobs on landed files."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairflow import jobs
from pairflow.operators.candles import candle_metrics
from pairflow.operators.dedup import dedup
from pairflow.operators.pairing import lead_lag_features
from pairflow.plans import fixtures as fx
from pairflow.session import scratch_path
from pairflow.sources import sinks


def test_pipeline_jobs_end_to_end(spark, sf_dir):
    raw_b, raw_r, fb, fr, usage, table, ledger, out = (
        scratch_path(spark, n) for n in
        ("raw-b", "raw-r", "fmt-b", "fmt-r", "usage", "table", "ledger", "docs"))
    pulls = fx.overlapping_pulls(fx.base_candles(spark, sf_dir, metrics=False))
    # the formatter keeps the latest pull of a minute (revised closes win)
    base = candle_metrics(dedup(pulls, ["symbol", "ts_minute_utc"], ["ingested_at_utc"]))
    ref = fx.ref_candles(spark, sf_dir)
    sinks.write_json_arrays(fx.raw_base_records(pulls), raw_b, group_cols=["symbol"])
    fx.raw_ref_records(fx.ref_candles(spark, sf_dir, metrics=False)) \
        .write.partitionBy("dt").option("header", True).csv(raw_r)

    m = jobs.format_base_job(spark, raw_b, fb)
    assert m["rows"] == base.count()
    jobs.format_ref_job(spark, raw_r, fr)
    days = sorted(r["execution_date"].isoformat()
                  for r in base.select("execution_date").distinct().collect())
    m = jobs.features_job(spark, fb, fr, usage, days)

    want = lead_lag_features(base, ref)
    got = spark.read.parquet(usage).drop("processed_at_utc").select(*want.columns)
    assert m["rows"] == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    jobs.load_job(spark, usage, table, ledger, as_of=days[-1])
    n = spark.read.parquet(table).count()
    assert n == want.count()
    marked = {r["dt"].isoformat() for r in spark.read.parquet(ledger).collect()}
    assert marked == set(days[:-1])
    # next run: only the as_of day is pending; reloading it changes nothing
    jobs.load_job(spark, usage, table, ledger, as_of="2099-01-01")
    assert spark.read.parquet(table).count() == n
    assert {r["dt"].isoformat() for r in spark.read.parquet(ledger).collect()} == set(days)
    assert spark.read.parquet(table).where(F.col("source_file").isNull()).count() == 0

    jobs.documents_job(spark, usage, out, scratch_path(spark, "doc-ledger"), as_of=days[-1])
    assert spark.read.text(out).count() == want.count()


def test_features_job_without_ref_layer(spark, sf_dir):
    fb, usage = scratch_path(spark, "fmt-b2"), scratch_path(spark, "usage2")
    raw_b = scratch_path(spark, "raw-b2")
    sinks.write_json_lines(fx.raw_base_records(fx.base_candles(spark, sf_dir, metrics=False)),
                           raw_b)
    jobs.format_base_job(spark, raw_b, fb, fmt="jsonl")
    jobs.features_job(spark, fb, scratch_path(spark, "no-ref"), usage, ["2024-01-05"])
    f = spark.read.parquet(usage)
    assert f.count() > 0
    assert f.where(F.col("ref_close").isNotNull()).count() == 0


def test_cli_runs_jobs_by_execution_date(spark, sf_dir):
    raw_b, fb, raw_r, fr, usage = (scratch_path(spark, n) for n in
                                   ("cli-raw-b", "cli-fmt-b", "cli-raw-r", "cli-fmt-r", "cli-usage"))
    sinks.write_json_arrays(fx.raw_base_records(fx.base_candles(spark, sf_dir, metrics=False)),
                            raw_b, group_cols=["symbol"])
    fx.raw_ref_records(fx.ref_candles(spark, sf_dir, metrics=False)) \
        .write.partitionBy("dt").option("header", True).csv(raw_r)
    jobs.main(["format-base", "--raw", raw_b, "--out", fb, "--execution_date",
               "2024-01-04", "2024-01-05"])
    jobs.main(["format-ref", "--raw", raw_r, "--out", fr])
    jobs.main(["features", "--base", fb, "--ref", fr, "--out", usage,
               "--execution_date", "2024-01-05", "--max_lag_minutes", "3"])
    f = spark.read.parquet(usage)
    assert {r["execution_date"].isoformat() for r in f.select("execution_date").distinct().collect()} \
        == {"2024-01-05"}
    assert "base_close_lag_3" in f.columns and "base_close_lag_4" not in f.columns
    assert {r["dt"].isoformat() for r in spark.read.parquet(fb).select("dt").distinct().collect()} \
        == {"2024-01-04", "2024-01-05"}


def test_features_job_requires_base_rows(spark, sf_dir):
    import pytest
    raw_b, fb = scratch_path(spark, "req-raw"), scratch_path(spark, "req-fmt")
    sinks.write_json_lines(fx.raw_base_records(fx.base_candles(spark, sf_dir, metrics=False)),
                           raw_b)
    jobs.format_base_job(spark, raw_b, fb, fmt="jsonl")
    for days in (["1999-01-01"], ["2024-01-04", "1999-01-01"]):  # a missing day among others
        with pytest.raises(FileNotFoundError, match="1999-01-01"):
            jobs.features_job(spark, fb, scratch_path(spark, "none"), scratch_path(spark, "o"),
                              days)
        with pytest.raises(FileNotFoundError, match="1999-01-01"):
            jobs.format_base_job(spark, raw_b, fb, days)


def _landed_in_two_formats(spark, sf_dir):
    """2024-01-04 as JSON arrays, 2024-01-05 as CSV, and minutes of the 4th
    landed again on the 5th."""
    raw = scratch_path(spark, "two-formats")
    c = fx.base_candles(spark, sf_dir, metrics=False)
    rows = fx.raw_base_records(c)
    day = lambda d: F.col("dt") == F.lit(d).cast("date")
    sinks.write_json_arrays(rows.where(day("2024-01-04")), raw, group_cols=["symbol"])
    again = rows.where(day("2024-01-04") & F.col("ts_minute_utc").like("%T2%")).withColumn(
        "dt", F.lit("2024-01-05").cast("date"))
    rows.where(day("2024-01-05")).unionByName(again).write.mode("append").partitionBy("dt") \
        .option("header", True).csv(raw)
    return raw, rows.where(day("2024-01-04")).count(), \
        rows.where(day("2024-01-05")).count() + again.count()


def test_days_of_different_formats_joint_and_one_by_one(spark, sf_dir):
    raw, n4, n5 = _landed_in_two_formats(spark, sf_dir)
    joint, single = scratch_path(spark, "fmt-joint"), scratch_path(spark, "fmt-single")
    assert jobs.format_base_job(spark, raw, joint)["rows"] == n4 + n5
    for d, n in (("2024-01-04", n4), ("2024-01-05", n5)):
        assert jobs.format_base_job(spark, raw, single, [d])["rows"] == n
    a, b = (spark.read.parquet(p).drop("formatted_at_utc") for p in (joint, single))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_document_rerun_keeps_earlier_exports(spark, sf_dir):
    from pairflow.plans.registry import QUERIES
    f = lead_lag_features(fx.base_candles(spark, sf_dir), fx.ref_candles(spark, sf_dir))
    assert QUERIES["documents_rerun"](spark, sf_dir).count() == f.count()


def test_models_job_twice_and_broken_rules(spark, sf_dir):
    import pytest
    usage, out = scratch_path(spark, "m-usage"), scratch_path(spark, "m-out")
    f = lead_lag_features(fx.base_candles(spark, sf_dir), fx.ref_candles(spark, sf_dir))
    sinks.write_layer(f, usage, "execution_date")
    first = jobs.models_job(spark, usage, out)
    assert first["staging"] == f.count() and jobs.models_job(spark, usage, out) == first
    broken = f.withColumn("base_close", F.when(F.minute("ts_minute_utc") > 3, F.col("base_close")))
    sinks.write_layer(broken, usage, "execution_date")
    with pytest.raises(ValueError, match="staging not_null base_close"):
        jobs.models_job(spark, usage, out)


def test_two_symbols_stay_apart_in_the_jobs(spark, sf_dir):
    """Formatted layers of two symbols, paired by symbol."""
    fb, fr, usage, table, ledger = (scratch_path(spark, n) for n in
                                    ("p-base", "p-ref", "p-usage", "p-table", "p-ledger"))
    base, ref = fx.base_candles(spark, sf_dir), fx.ref_candles(spark, sf_dir)
    two = lambda df: df.withColumn("symbol", F.lit("A")).unionByName(
        df.withColumn("symbol", F.lit("B")).withColumn("close", F.col("close") * 2))
    for df, path in ((base, fb), (ref, fr)):
        sinks.write_layer(two(df).withColumn("dt", F.col("execution_date"))
                          .drop("execution_date"), path, "dt")
    days = sorted(str(r[0]) for r in base.select("execution_date").distinct().collect())
    jobs.features_job(spark, fb, fr, usage, days, by=["symbol"])
    one = lead_lag_features(base, ref)
    got = spark.read.parquet(usage)
    assert got.count() == 2 * one.count()
    a = got.where("symbol = 'A'").select(*one.columns)
    assert a.exceptAll(one).count() == 0
    jobs.load_job(spark, usage, table, ledger, as_of="2099-01-01", by=["symbol"])
    assert spark.read.parquet(table).count() == got.count()
