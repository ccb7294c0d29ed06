"""Stored last-known values of the ref series, one snapshot per day.

``last_known`` seeds carry the last value of a column over any number of days.
Computed from the candles they need the whole earlier history at every run.
Here each day of the ref layer has a snapshot that holds, per pair and column,
the day's own last value (``own_<column>``) and the last value known at its end
(``<column>``). A run then reads the days it is asked for and the snapshot
before each. When an earlier day changes, its own values are computed anew
from that day's candles, and the snapshots behind it are carried forward from
the stored own values of their days; only those that come out different are
published again, so a correction stops where a later value hides it.

A snapshot has one row per pair seen so far. The window that carries runs over
snapshot rows (days of a pair), never over candles.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .publish import finish_publish, marked_days, publish_layer
from .sinks import remove_path

CARRIED = ("close", "volume", "high", "low")


def _date(day: str) -> Column:
    return F.lit(day).cast("date")


def _of_days(df: DataFrame, day: str, days: Iterable[str]) -> DataFrame:
    return df.where(F.col(day).isin([_date(d) for d in days]))


def day_values(ref: DataFrame, *, ts: str = "ts_minute_utc", day: str = "dt",
               by: Sequence[str] = ()) -> DataFrame:
    """The last non-NULL value of each column per (by…, day): a hash
    aggregation that sends one row per pair, day and map task."""
    none = F.lit(None).cast("double")
    value = {c: F.col(c).cast("double") if c in ref.columns else none for c in CARRIED}
    return ref.groupBy(*by, day).agg(*[
        F.max_by(v, F.when(v.isNotNull(), F.col(ts))).alias(f"own_{c}") for c, v in value.items()])


def carried_states(own: DataFrame, start: DataFrame, days: Sequence[str], *, day: str = "dt",
                   by: Sequence[str] = ()) -> DataFrame:
    """The snapshots of ``days``: own values and values known at the day's
    end, from the own values of these days and the snapshot ``start`` before
    the first (no rows: nothing is known). A pair has a row on every day from
    its first one on."""
    none = F.lit(None).cast("double")
    before = start.select(*by, F.lit(None).cast("date").alias(day),
                          *[none.alias(f"own_{c}") for c in CARRIED], *CARRIED)
    rows = own.select(*by, day, *[f"own_{c}" for c in CARRIED],
                      *[F.col(f"own_{c}").alias(c) for c in CARRIED]).unionByName(before)
    first = rows.groupBy(*by).agg(F.min(F.coalesce(day, _date(days[0]))).alias("_first"))
    every = F.array(*[_date(d) for d in days])
    grid = first.select(*by, F.explode(F.filter(every, lambda d: d >= F.col("_first"))).alias(day))
    known = (rows.unionByName(grid, allowMissingColumns=True).groupBy(*by, day)
             .agg(*[F.max(c).alias(c) for c in rows.columns if c not in (*by, day)]))
    w = Window.partitionBy(*by).orderBy(F.asc_nulls_first(day)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return known.select(*by, day, *[f"own_{c}" for c in CARRIED], *[
        F.last(c, ignorenulls=True).over(w).alias(c) for c in CARRIED]).where(
            F.col(day).isNotNull())


def _snapshots(spark: SparkSession, path: str, schema: T.StructType, have: Sequence[str],
               ) -> DataFrame:
    if not have:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def update_carry(ref: DataFrame, path: str, days: Iterable[str], *, ts: str = "ts_minute_utc",
                 day: str = "dt", by: Sequence[str] = ()) -> list[str]:
    """Bring the snapshots at ``path`` up to date after ``days`` of the layer
    ``ref`` were added, changed or removed. Reads those days of ``ref`` and
    snapshots. Returns the days whose snapshot was published. Publishing is
    safe against a stop at any step (``publish``), and a rerun with the same
    days ends in the same snapshots."""
    spark = ref.sparkSession
    days = sorted({str(d) for d in days})
    if not days:
        return []
    finish_publish(spark, path)
    have = marked_days(spark, path, day)
    later = [d for d in have if d > days[0] and d not in set(days)]
    span = sorted({*days, *later})
    schema = T.StructType([*[ref.schema[c] for c in by], T.StructField(day, T.DateType()),
                           *[T.StructField(f"own_{c}", T.DoubleType()) for c in CARRIED],
                           *[T.StructField(c, T.DoubleType()) for c in CARRIED]])
    state = _snapshots(spark, path, schema, have)
    own = day_values(_of_days(ref, day, days), ts=ts, day=day, by=by)
    own = own.unionByName(_of_days(state, day, later).select(*own.columns))
    start = _of_days(state, day, have[:bisect_left(have, days[0])][-1:])
    stage = scratch_path(spark, "carry")
    carried_states(own, start, span, day=day, by=by).select(*schema.names).write.parquet(stage)
    new = spark.read.schema(schema).parquet(stage)
    # a row that is in both goes out; rows of a snapshot are distinct by pair
    differ = (new.withColumn("_n", F.lit(1))
              .unionByName(_of_days(state, day, span).withColumn("_n", F.lit(-1)))
              .groupBy(*schema.names).agg(F.sum("_n").alias("_n")).where("_n <> 0"))
    changed = sorted(str(r[day]) for r in differ.select(day).distinct().collect())  # days
    if changed:
        publish_layer(_of_days(new, day, changed), path, day, sort_col=None, replaces=changed)
    remove_path(spark, stage)
    return changed


def carried_seeds(spark: SparkSession, path: str, days: Iterable[str], columns: Mapping[str, str],
                  schema: T.StructType, *, day: str = "dt", out_day: str = "execution_date",
                  by: Sequence[str] = ()) -> DataFrame:
    """The seeds of ``days`` (by…, day, struct ``_s``): of each day the
    snapshot of the latest earlier day. ``columns`` maps seed names to
    carried columns, ``schema`` holds the types of ``by``. Reads one snapshot
    per asked day; days before the first snapshot have no seed."""
    have = marked_days(spark, path, day)
    asked: dict[str, list[str]] = {}
    for d in sorted({str(d) for d in days}):
        at = bisect_left(have, d)
        if at:
            asked.setdefault(have[at - 1], []).append(d)
    fields = T.StructType([*[schema[c] for c in by], T.StructField(day, T.DateType()),
                           *[T.StructField(c, T.DoubleType()) for c in CARRIED]])
    state = _of_days(_snapshots(spark, path, fields, have), day, asked)
    seed = F.struct(*[F.col(c).alias(out) for out, c in columns.items()]).alias("_s")
    if not asked:
        return state.select(*by, F.col(day).alias(out_day), seed)
    follows = F.create_map(*[x for at, ds in asked.items()
                             for x in (_date(at), F.array(*[_date(d) for d in ds]))])
    return state.select(*by, F.explode(follows[F.col(day)]).alias(out_day), seed)
