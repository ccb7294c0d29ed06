"""Day layers published with a marker: written aside, moved, marked last.

A layer's new days are first written whole into a hidden folder of the layer,
then a plan is stored that names them, then each is moved to its place and
marked with an empty ``_SUCCESS`` file. A run that stops before its plan is
stored changed nothing and is undone by the next one; a run that stops behind
it has all its days on disk and is finished by the next one. Readers see a day
old, new or (between removal and move) absent, and ask for marked days only
with ``read_layer(marked=True)``.

The moves are folder renames on the layer's own file system, a few calls a
day; rows never pass through the driver. Folder renames must be atomic (HDFS,
ABFS, local), and a layer has one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

MARKER = "_SUCCESS"
STAGE = "_publish-"     # hidden from Spark's readers, as are the names below
PLAN = "_plan"


def _fs(spark: SparkSession, path: str):
    """The file system of a path, and Hadoop's class of paths."""
    kind = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return kind(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), kind


def _names(fs, folder) -> list[str]:
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def day_folder(spark: SparkSession, partition_col: str, value: str | None) -> str:
    """The folder name that Spark gives a partition value."""
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return utils.getPartitionPathString(partition_col, value)


def mark_day(spark: SparkSession, base: str, folder: str) -> None:
    fs, path = _fs(spark, base)
    fs.create(path(f"{base.rstrip('/')}/{folder}/{MARKER}"), True).close()


def move_day(spark: SparkSession, stage: str, base: str, folder: str) -> None:
    """Put a staged day in its place; a day that has moved already stays."""
    fs, path = _fs(spark, base)
    source, place = path(f"{stage}/{folder}"), path(f"{base.rstrip('/')}/{folder}")
    if not fs.exists(source):
        return
    # the marker goes first: what is half removed is not a marked day
    fs.delete(path(f"{base.rstrip('/')}/{folder}/{MARKER}"), False)
    fs.delete(place, True)
    if not fs.rename(source, place):
        raise OSError(f"could not move {source.toString()} to {place.toString()}")


def _store_plan(spark: SparkSession, stage: str, plan: dict) -> None:
    fs, path = _fs(spark, stage)
    out = fs.create(path(f"{stage}/{PLAN}.part"), True)
    out.write(json.dumps(plan).encode())
    out.close()
    if not fs.rename(path(f"{stage}/{PLAN}.part"), path(f"{stage}/{PLAN}")):
        raise OSError(f"could not store the plan of {stage}")


def _carry_out(spark: SparkSession, base: str, stage: str) -> None:
    fs, path = _fs(spark, base)
    stored = fs.open(path(f"{stage}/{PLAN}"))
    plan = json.loads(bytes(stored.readAllBytes()))
    stored.close()
    for folder in plan["days"]:
        move_day(spark, stage, base, folder)
        mark_day(spark, base, folder)
    for folder in plan["gone"]:
        fs.delete(path(f"{base.rstrip('/')}/{folder}"), True)
    fs.delete(path(stage), True)
    _drop_if_empty(fs, path(base))


def _drop_if_empty(fs, root) -> None:
    if fs.exists(root) and not _names(fs, root):  # no day was ever published
        fs.delete(root, True)


def finish_publish(spark: SparkSession, base: str) -> list[str]:
    """Finish the publishes of ``base`` that stopped with a plan and undo the
    others. Returns "finished" or "undone" for each."""
    fs, path = _fs(spark, base)
    done, root = [], path(base)
    for name in sorted(n for n in _names(fs, root) if n.startswith(STAGE)):
        stage = f"{base.rstrip('/')}/{name}"
        if fs.exists(path(f"{stage}/{PLAN}")):
            _carry_out(spark, base, stage)
            done.append("finished")
        else:
            fs.delete(path(stage), True)
            done.append("undone")
    if done:
        _drop_if_empty(fs, root)
    return done


def publish_layer(df: DataFrame, base: str, partition_col: str = "dt",
                  sort_col: str | None = "ts_minute_utc",
                  replaces: Iterable[str | None] = ()) -> None:
    """Write ``df`` as days of the layer ``base`` and publish them.

    The days in ``df`` replace those of the layer, other days stay. Days of
    ``replaces`` that ``df`` does not hold are removed by the same plan. Files
    are laid out as by ``write_layer``. ``df`` may read the layer itself."""
    spark = df.sparkSession
    finish_publish(spark, base)
    stage = f"{base.rstrip('/')}/{STAGE}{uuid.uuid4().hex[:12]}"
    w = df.hint("rebalance", partition_col)
    if sort_col and sort_col in df.columns:
        w = w.sortWithinPartitions(partition_col, sort_col)
    w.write.partitionBy(partition_col).parquet(stage)
    fs, path = _fs(spark, base)
    days = sorted(n for n in _names(fs, path(stage)) if n.startswith(f"{partition_col}="))
    named = {day_folder(spark, partition_col, v) for v in replaces}
    _store_plan(spark, stage, {"days": days, "gone": sorted(named - set(days))})
    _carry_out(spark, base, stage)


def marked_days(spark: SparkSession, base: str, partition_col: str = "dt") -> list[str]:
    """The values of the partitions that hold a marker, as text (one small
    row per day, from one glob of the file system)."""
    fs, path = _fs(spark, base)
    found = fs.globStatus(path(f"{base.rstrip('/')}/{partition_col}=*/{MARKER}"))
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog \
        .ExternalCatalogUtils.unescapePathName
    return sorted(unescape(s.getPath().getParent().getName().split("=", 1)[1])
                  for s in found or ())
