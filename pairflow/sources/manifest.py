"""File-level changes of a landing tree.

A manifest is a table of the files that a consumer has worked on: path, size,
modification time and day. Compared with the tree as it is now, it tells the
days in which files were added, replaced or deleted. File names come from
Spark's file index, which lists folders in parallel; no file is opened and no
list of files reaches the driver's Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .files import path_exists

MANIFEST = "path string, size bigint, modified timestamp, dt date"


def current_files(spark: SparkSession, path: str, day_col: str = "dt") -> DataFrame:
    """The files below ``path`` now, stored in scratch so that every use of
    the frame sees the same listing. Files outside a day folder have no day;
    empty files hold no record and are not listed."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    now = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
           .select("path", F.col("length").alias("size"),
                   F.col("modificationTime").alias("modified"),
                   F.regexp_extract("path", rf"/{day_col}=([^/]+)/", 1).try_cast("date")
                    .alias("dt")))
    stored = scratch_path(spark, "files")
    now.write.parquet(stored)
    return spark.read.schema(MANIFEST).parquet(stored)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The stored manifest; without one, nothing has been worked on."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(path)


def file_changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """(path, dt, change): files that are ``added``, ``replaced`` (another
    size or modification time) or ``deleted``."""
    b = before.select("path", F.struct("size", "modified").alias("was"), F.col("dt").alias("_dt"))
    n = now.select("path", F.struct("size", "modified").alias("is"), "dt")
    return (n.join(b, "path", "full_outer")
             .where(~F.col("is").eqNullSafe(F.col("was")))
             .select("path", F.coalesce("dt", "_dt").alias("dt"),
                     F.when(F.col("was").isNull(), "added")
                      .when(F.col("is").isNull(), "deleted").otherwise("replaced")
                      .alias("change")))


def changed_days(changes: DataFrame) -> DataFrame:
    """Per day the number of files added, replaced and deleted."""
    return changes.groupBy("dt").agg(*[
        F.count_if(F.col("change") == c).alias(c) for c in ("added", "replaced", "deleted")])


def store_manifest(now: DataFrame, path: str) -> None:
    """Record ``now`` as worked on. Lost halfway, the next run finds no
    manifest and forms every day again: more work, the same layer."""
    now.write.mode("overwrite").parquet(path)
