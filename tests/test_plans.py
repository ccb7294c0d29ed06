"""Plan checks: the distributed shape the design promises."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from pairflow.plans.inspect import census_of, execute, executed_plans, physical_plan

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                "MapInPandas", "PythonUDF")


def plan(df) -> str:
    """The plan that ran."""
    return physical_plan(execute(df)).split("== Initial Plan ==")[0]


def plans_of(spark, key, sf_dir) -> list[str]:
    """All plans that a query runs, with those of the tables it writes."""
    return executed_plans(spark, lambda: entry.queries()[key](spark, sf_dir).write.format("noop")
                          .mode("overwrite").save())


def test_feature_plan_one_candle_exchange_and_no_single_partition(spark, sf_dir):
    p = plan(entry.queries()["lead_lag_features"](spark, sf_dir))
    assert "SinglePartition" not in p
    # the join, the aggregation and all windows share one exchange
    assert p.count("REPARTITION_BY_COL") == 1
    assert p.count("Window ") >= 3
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" not in p


def test_tick_aggregation_is_hash_based(spark, sf_dir):
    p = plan(entry.queries()["ohlcv_candles"](spark, sf_dir))
    assert "HashAggregate" in p and "SortAggregate" not in p


@pytest.mark.parametrize("key", ["lead_lag_features", "enriched_mart", "daily_correlation",
                                 "conform_candles", "upsert_update", "search_documents",
                                 "parse_klines", "quality_report"])
def test_no_python_in_plans(spark, sf_dir, key):
    plans = plans_of(spark, key, sf_dir)
    assert plans and not any(n in p for n in PYTHON_NODES for p in plans)


def test_scan_prunes_columns_and_pushes_filters(spark, sf_dir):
    from pairflow.plans import fixtures as fx
    p = plan(fx.ref_candles(spark, sf_dir))
    m = re.search(r"ReadSchema: struct<([^>]*)>", p)
    assert m and "user_id" not in m.group(1)
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", p)
    assert pushed and "EqualTo(event_type,purchase)" in pushed.group(1)


def test_layer_read_prunes_partitions(spark, sf_dir):
    from pairflow.plans import fixtures as fx
    from pairflow.session import scratch_path
    from pairflow.sources import files, sinks
    from pyspark.sql import functions as F
    path = scratch_path(spark, "prune")
    c = fx.base_candles(spark, sf_dir, metrics=False).withColumn("dt", F.col("execution_date"))
    sinks.write_layer(c, path, "dt")
    df = files.read_layer(spark, path, days=["2024-01-05"])
    p = plan(df)
    assert "PartitionFilters: [isnotnull(dt" in p
    assert {r["dt"].isoformat() for r in df.select("dt").distinct().collect()} == {"2024-01-05"}


def test_top_n_per_group_limits_before_the_shuffle(spark, sf_dir):
    p = plan(entry.queries()["last_n_per_series"](spark, sf_dir))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_dedup_and_upsert_combine_before_shuffle(spark, sf_dir):
    p = plan(entry.queries()["dedup_latest"](spark, sf_dir))
    # partial aggregation (map-side combine) below the exchange on the key
    assert re.search(r"Exchange hashpartitioning\(symbol#\d+, ts_minute_utc#\d+", p)
    assert p.count("SortAggregate") == 2  # one on either side of the exchange
    below = p[p.index("Exchange hashpartitioning(symbol"):]
    assert "SortAggregate" in below


def test_upsert_scope_prunes_target_partitions_dynamically(spark, sf_dir):
    """The touched-day semi join of ``upsert_table`` becomes a dynamic
    partition filter on the target scan: untouched days are not read."""
    from pyspark.sql import functions as F
    from pairflow.plans import fixtures as fx
    from pairflow.session import scratch_path
    from pairflow.sources import sinks
    c = fx.base_candles(spark, sf_dir, metrics=False)
    path = scratch_path(spark, "dpp")
    sinks.write_layer(c, path, "execution_date")
    batch = c.where(F.col("execution_date") == F.lit("2024-01-05").cast("date"))
    scoped = spark.read.parquet(path).join(batch.select("execution_date").distinct(),
                                           "execution_date", "left_semi")
    scoped.write.format("noop").mode("overwrite").save()
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruningexpression", plan(scoped))


def test_small_batch_is_broadcast_into_the_target(spark, sf_dir):
    """The target of an upsert is not shuffled for a batch measured small."""
    from pyspark.sql import functions as F
    from pairflow.operators.upsert import upsert
    from pairflow.plans import fixtures as fx
    t = fx.orders_target(spark, sf_dir)
    b = fx.orders_batch(spark, sf_dir).where(F.col("o_orderkey") % 50 == 0)
    p = plan(upsert(t, b, ["o_orderkey"], order=["version"]))
    assert re.search(r"BroadcastHashJoin \[o_orderkey[^\]]*\], \[o_orderkey[^\]]*\], LeftOuter, "
                     r"BuildRight", p)


def test_tied_ticks_aggregate_by_hash(spark, sf_dir):
    p = plan(entry.queries()["candle_ties"](spark, sf_dir))
    assert "HashAggregate" in p and "SortAggregate" not in p


def test_layer_files_do_not_multiply_with_tasks(spark, sf_dir):
    from pairflow.plans import fixtures as fx
    from pairflow.session import scratch_path
    from pairflow.sources import sinks
    path = scratch_path(spark, "files")
    c = fx.base_candles(spark, sf_dir, metrics=False).repartition(32)
    sinks.write_layer(c, path, "execution_date")
    back = spark.read.parquet(path)
    days = back.select("execution_date").distinct().count()
    assert len(back.inputFiles()) <= 2 * days


def events_scans(description: str) -> int:
    """Scans of the events table in the final part of a formatted plan."""
    tree = description.split("== Initial Plan ==")[0]
    ids = set(re.findall(r"Scan parquet\s*\((\d+)\)", tree))
    places = re.findall(r"\n\((\d+)\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?Location: ([^\n]*)",
                        description)
    return sum(i in ids and "events.parquet" in place for i, place in places)


def test_scans_of_the_events_table(spark, sf_dir):
    """Each series is aggregated from its ticks once, the seeds of the
    flagship read the ref ticks again."""
    for key, most in (("locf_last_known", 2), ("enriched_mart", 3), ("lead_lag_features", 3)):
        scans = sum(map(events_scans, plans_of(spark, key, sf_dir)))
        assert 1 <= scans <= most, (key, scans)


def test_expectations_scan_once(spark, sf_dir):
    from pairflow.operators import quality as qr
    from pairflow.plans import fixtures as fx
    from pairflow.session import scratch_path
    path = scratch_path(spark, "quality")
    fx.base_candles(spark, sf_dir, metrics=False).write.parquet(path)
    df = qr.expectations(spark.read.parquet(path), [qr.not_null("close")],
                         unique_key=["symbol", "execution_date", "ts_minute_utc"],
                         order_by="ts_minute_utc", order_within=["symbol", "execution_date"],
                         arrival="ingested_at_utc")
    p = plan(df)
    assert len(re.findall(r"FileScan", p)) == 1
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1


def test_census_counts_what_ran(spark, sf_dir):
    c = census_of(plans_of(spark, "enriched_mart", sf_dir))
    assert c["windows"] >= 4 and c["python"] == 0 and c["exchanges"] >= 2
