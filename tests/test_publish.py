"""Published layers stopped between their steps, rejects, file changes."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from pairflow import jobs, session
from pairflow.operators.upsert import upsert_table
from pairflow.plans import fixtures as fx
from pairflow.sources import files, publish, sinks
from pairflow.sources import manifest as mf

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03"]


def scratch_path(spark, name):
    return session.scratch_path(spark, name).removeprefix("file:")


def layer(spark, value, days=DAYS):
    return spark.createDataFrame([(d, i, value) for d in days for i in range(3)],
                                 "dt string, i int, v int").withColumn("dt", F.to_date("dt"))


def content(spark, path, marked=False):
    return {(str(r["dt"]), r["v"]) for r in files.read_layer(spark, path, marked=marked).collect()}


class Stop(Exception):
    pass


def stop_at(monkeypatch, name, call):
    """Raise in the given call of a step of the publish."""
    real, seen = getattr(publish, name), []

    def step(*args):
        seen.append(args)
        if len(seen) == call:
            raise Stop
        return real(*args)
    monkeypatch.setattr(publish, name, step)


def test_published_days_hold_markers(spark):
    path = scratch_path(spark, "pub")
    publish.publish_layer(layer(spark, 1), path)
    assert publish.marked_days(spark, path) == DAYS
    publish.publish_layer(layer(spark, 2, DAYS[1:2]), path, replaces=[DAYS[2]])
    assert content(spark, path, marked=True) == {(DAYS[0], 1), (DAYS[1], 2)}
    os.remove(f"{path}/dt={DAYS[0]}/{publish.MARKER}")
    assert content(spark, path, marked=True) == {(DAYS[1], 2)}
    assert content(spark, path) == {(DAYS[0], 1), (DAYS[1], 2)}


@pytest.mark.parametrize("step, call", [("move_day", 1), ("move_day", 2), ("mark_day", 1),
                                        ("mark_day", 2), ("_carry_out", 1)])
def test_a_publish_that_stops_is_finished(spark, monkeypatch, step, call):
    path = scratch_path(spark, "pub-stop")
    publish.publish_layer(layer(spark, 1), path)
    with monkeypatch.context() as m:
        stop_at(m, step, call)
        with pytest.raises(Stop):
            publish.publish_layer(layer(spark, 2, DAYS[:2]), path, replaces=[DAYS[2]])
    assert publish.finish_publish(spark, path) == ["finished"]
    assert content(spark, path, marked=True) == {(d, 2) for d in DAYS[:2]}
    assert not [n for n in os.listdir(path) if n.startswith("_")]
    assert publish.finish_publish(spark, path) == []


def test_a_publish_without_a_plan_is_undone(spark, monkeypatch):
    path = scratch_path(spark, "pub-undo")
    for first in (True, False):
        if not first:
            publish.publish_layer(layer(spark, 1), path)
        with monkeypatch.context() as m:
            stop_at(m, "_store_plan", 1)
            with pytest.raises(Stop):
                publish.publish_layer(layer(spark, 2), path)
        assert publish.finish_publish(spark, path) == ["undone"]
        assert files.path_exists(spark, path) == (not first)
    assert content(spark, path, marked=True) == {(d, 1) for d in DAYS}


def test_an_upsert_that_stops_keeps_every_row(spark, monkeypatch):
    """Rows with the day in the key: the merged rows replace the folder that
    they were read from."""
    path = scratch_path(spark, "pub-upsert")
    upsert_table(spark, path, layer(spark, 1), ["dt", "i"], "dt")
    batch = layer(spark, 2).where("i = 0")
    for call in (1, 2, 3):
        with monkeypatch.context() as m:
            stop_at(m, "mark_day", call)
            with pytest.raises(Stop):
                upsert_table(spark, path, batch, ["dt", "i"], "dt")
        upsert_table(spark, path, batch, ["dt", "i"], "dt")
        got = {(str(r["dt"]), r["i"], r["v"]) for r in spark.read.parquet(path).collect()}
        assert got == {(d, i, 2 if i == 0 else 1) for d in DAYS for i in range(3)}


def test_an_empty_frame_publishes_no_layer(spark):
    path = scratch_path(spark, "pub-empty")
    publish.publish_layer(layer(spark, 1).limit(0), path)
    assert not files.path_exists(spark, path)
    publish.publish_layer(layer(spark, 1), path)
    publish.publish_layer(layer(spark, 1).limit(0), path, replaces=DAYS[:1])
    assert content(spark, path) == {(d, 1) for d in DAYS[1:]}


def landed_lines(spark, sf_dir):
    raw = scratch_path(spark, "pub-raw")
    rows = fx.raw_base_records(fx.base_candles(spark, sf_dir, metrics=False)).where(
        F.col("dt") < F.lit("2024-01-04").cast("date"))
    sinks.write_json_lines(rows, raw)
    return raw, rows


def test_rejects_leave_good_rows_alone(spark, sf_dir):
    raw, rows = landed_lines(spark, sf_dir)
    out = scratch_path(spark, "pub-fmt")
    clean = jobs.format_base_job(spark, raw, out)
    good = spark.read.parquet(out).drop("formatted_at_utc")
    good = spark.createDataFrame(good.collect(), good.schema)
    assert clean["rejects"] == 0 and not files.path_exists(spark, f"{out}_rejects")
    broken = ['{"open_time": 17, "clo', "no json", '{"open_time": "n/a", "symbol": "ALL"}', "[1"]
    with open(f"{raw}/dt=2024-01-02/broken.jsonl", "w") as f:
        f.write("\n".join(broken) + "\n")
    assert jobs.format_base_job(spark, raw, out)["rejects"] == len(broken)
    again = spark.read.parquet(out).drop("formatted_at_utc")
    assert again.exceptAll(good).count() == 0 and good.exceptAll(again).count() == 0
    found = files.read_layer(spark, f"{out}_rejects", marked=True).collect()
    assert sorted(r["record"] for r in found) == sorted(broken)
    assert {(str(r["dt"]), r["format"], os.path.basename(r["file"])) for r in found} == {
        ("2024-01-02", "jsonl", "broken.jsonl")}
    os.remove(f"{raw}/dt=2024-01-02/broken.jsonl")  # mended: the rejects of the day go
    jobs.format_base_job(spark, raw, out, ["2024-01-02"])
    assert not files.path_exists(spark, f"{out}_rejects")


def test_file_changes_are_added_replaced_deleted(spark, sf_dir):
    raw, _ = landed_lines(spark, sf_dir)
    before = mf.current_files(spark, raw)
    assert mf.file_changes(before, mf.current_files(spark, raw)).count() == 0
    names = sorted(n for n in os.listdir(f"{raw}/dt=2024-01-01") if n.endswith(".jsonl"))
    with open(f"{raw}/dt=2024-01-01/{names[0]}", "a") as f:
        f.write("\n")
    with open(f"{raw}/dt=2024-01-03/more.jsonl", "w") as f:
        f.write("{}")
    sinks.remove_path(spark, f"{raw}/dt=2024-01-02")
    days = {str(r["dt"]): (r["added"], r["replaced"], r["deleted"] > 0) for r in
            mf.changed_days(mf.file_changes(before, mf.current_files(spark, raw))).collect()}
    assert days == {"2024-01-01": (0, 1, False), "2024-01-02": (0, 0, True),
                    "2024-01-03": (1, 0, False)}


def test_changed_files_give_the_result_of_a_full_run(spark, sf_dir):
    raw, rows = landed_lines(spark, sf_dir)
    out, manifest, full = (scratch_path(spark, n) for n in ("cf-out", "cf-man", "cf-full"))
    assert jobs.format_changed_job(spark, raw, out, manifest) == DAYS
    assert jobs.format_changed_job(spark, raw, out, manifest) == []
    one = rows.where(F.col("dt") == F.lit(DAYS[0]).cast("date")).drop("dt").first().asDict()
    with open(f"{raw}/dt={DAYS[0]}/late.jsonl", "w") as f:
        f.write(json.dumps({**one, "close": "1.5", "ingested_at_utc": "2024-03-01T00:00:00Z"}))
    sinks.remove_path(spark, f"{raw}/dt={DAYS[2]}")
    assert jobs.format_changed_job(spark, raw, out, manifest) == [DAYS[0], DAYS[2]]
    jobs.format_base_job(spark, raw, full)
    a, b = (spark.read.parquet(p).drop("formatted_at_utc") for p in (out, full))
    assert a.count() > 0 and a.where("close = 1.5").count() == 1
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_a_day_of_rejects_alone_leaves_the_layer(spark, sf_dir):
    raw, _ = landed_lines(spark, sf_dir)
    out = scratch_path(spark, "pub-all-bad")
    jobs.format_base_job(spark, raw, out)
    sinks.remove_path(spark, f"{raw}/dt={DAYS[0]}")
    os.makedirs(f"{raw}/dt={DAYS[0]}")
    with open(f"{raw}/dt={DAYS[0]}/bad.jsonl", "w") as f:
        f.write("{\n")
    done = jobs.format_base_job(spark, raw, out, DAYS[:1])
    assert (done["rows"], done["rejects"]) == (0, 1)
    assert publish.marked_days(spark, out) == DAYS[1:]
