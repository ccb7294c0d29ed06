"""Rows of micro-batches as segments of day folders, merged level by level.

    <root>/<day>=2024-01-02/segment=0-17-17/   the rows of batch 17
    <root>/<day>=2024-01-02/segment=1-12-15/   batches 12 to 15, merged

A batch writes its segment of each day it touches under its own number, so a
replay replaces it. When a day has ``fanout`` segments of one level, they
are merged into one of the next, so a day has at most ``fanout - 1`` of a level
and the levels grow with the logarithm of the batches.

A merged segment counts once its marker file stands, and from then on the
segments whose batches it covers are dead: readers pass them over, and they
are removed at once or, after a stop in between, by the next batch of the day.
So every step can be lost: without the marker the parts are live and the
merged folder is overwritten by the next attempt; with it the parts are dead
whether or not they are still there, and so is a replay of one of them.

Only the days a batch touches are listed, by Spark's file index.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import path_exists
from ..sources.sinks import remove_path

FANOUT = 4
MARKER = "merged"  # names with a leading "_" are not listed
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True, order=True)
class Segment:
    day: str
    level: int
    first: int
    last: int

    @property
    def name(self) -> str:
        return f"{self.level}-{self.first}-{self.last}"

    def covers(self, other: Segment) -> bool:
        return (self.day == other.day and self.level > other.level
                and self.first <= other.first and other.last <= self.last)


def day_values(rows: DataFrame, day: str) -> list[str]:
    """The distinct days of some rows, as partition values."""
    days = rows.select(F.coalesce(F.col(day).cast("string"), F.lit(NULL_DAY)).alias("d")).distinct()
    return sorted(r["d"] for r in days.collect())  # days, not rows


def write_segment(rows: DataFrame, root: str, day: str, epoch: int) -> None:
    """Store a batch's rows under its number, replacing an earlier attempt."""
    _write(rows.withColumn("segment", F.lit(f"0-{epoch}-{epoch}")), root, day)


def _write(rows: DataFrame, root: str, day: str) -> None:
    (rows.hint("rebalance", day).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(day, "segment").parquet(root))


def _folder(root: str, day: str, s: Segment) -> str:
    return f"{root.rstrip('/')}/{day}={s.day}/segment={s.name}"


def segments_of(spark: SparkSession, root: str, day: str,
                days: Iterable[str]) -> tuple[list[Segment], list[Segment]]:
    """(live, dead) segments of some days. Unmarked merged folders belong to
    neither: they are an attempt that the next merge overwrites."""
    folders = [f for d in days if path_exists(spark, f := f"{root.rstrip('/')}/{day}={d}")]
    if not folders:
        return [], []
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders)
             .select(F.regexp_extract("path", rf"/{day}=([^/]+)/segment=(\d+)-(\d+)-(\d+)/", 1)
                     .alias("day"),
                     *[F.regexp_extract("path", r"/segment=(\d+)-(\d+)-(\d+)/", i).cast("int")
                       .alias(n) for i, n in enumerate(("level", "first", "last"), 1)],
                     F.col("path").endswith(f"/{MARKER}").alias("marked"))
             .groupBy("day", "level", "first", "last").agg(F.max("marked").alias("marked"))
             .collect())  # at most the bound of segments for each of the days
    whole = [Segment(r["day"], r["level"], r["first"], r["last"]) for r in found
             if r["level"] == 0 or r["marked"]]
    by_day = defaultdict(list)
    for s in whole:
        by_day[s.day].append(s)
    dead = {s for s in whole if any(o.covers(s) for o in by_day[s.day])}
    return sorted(set(whole) - dead), sorted(dead)


def read_segments(spark: SparkSession, root: str, day: str, schema: T.StructType,
                  segments: Sequence[Segment]) -> DataFrame:
    """The rows of some segments, in the columns of ``schema``."""
    if not segments:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField("segment", T.StringType())])
    return (spark.read.schema(stored).option("basePath", root)
            .option("pathGlobFilter", "*.parquet")
            .parquet(*[_folder(root, day, s) for s in segments]).select(*schema.fieldNames()))


def read_days(spark: SparkSession, root: str, day: str, schema: T.StructType,
              days: Iterable[str]) -> DataFrame:
    """The live rows of some days."""
    return read_segments(spark, root, day, schema, segments_of(spark, root, day, days)[0])


def all_days(spark: SparkSession, root: str, day: str) -> list[str]:
    """Every day that the store has a folder of."""
    if not path_exists(spark, root):
        return []
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{day}="))


def mark(spark: SparkSession, root: str, day: str, s: Segment) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{_folder(root, day, s)}/{MARKER}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    out.write(1)  # an empty file would not be listed
    out.close()


def compact(spark: SparkSession, root: str, day: str, schema: T.StructType, days: Iterable[str],
            merge: Callable[[DataFrame], DataFrame] | None = None,
            fanout: int = FANOUT) -> list[Segment]:
    """Remove what is dead and merge full levels of some days, lowest first;
    one job for all days. ``merge`` combines rows of one day (their columns
    stay those of ``schema``). Returns the merged segments."""
    live, dead = segments_of(spark, root, day, days)
    for s in dead:
        remove_path(spark, _folder(root, day, s))
    levels = defaultdict(list)
    for s in live:
        levels[s.day, s.level].append(s)
    targets, parts = {}, []
    for (d, level), members in sorted(levels.items()):
        if d not in targets and len(members) >= fanout:
            targets[d] = Segment(d, level + 1, min(s.first for s in members),
                                 max(s.last for s in members))
            parts += members
    if not targets:
        return []
    rows = read_segments(spark, root, day, schema, parts)
    name = F.create_map(*[F.lit(x) for d, s in targets.items() for x in (d, s.name)])
    key = F.coalesce(F.col(day).cast("string"), F.lit(NULL_DAY))
    merged = merge(rows) if merge else rows
    _write(merged.withColumn("segment", F.element_at(name, key)), root, day)
    for s in targets.values():
        mark(spark, root, day, s)
    for s in parts:
        remove_path(spark, _folder(root, day, s))
    return sorted(targets.values())
