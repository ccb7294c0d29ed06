"""Reports over candles and the feature table: joint moves, rollups,
freshness, latest rows, fill completeness and NULL profiles.

All are single-pass hash aggregations or partitioned windows; nothing is
collected. Where a report has one row per column (NULL profile) the
aggregation runs once over the data and the pivot to rows happens on the
one-row result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import minutes_between

# Joint-move labels (both up / both down / anything else).
JOINT_MOVE_LABELS = ("both_up", "both_down", "divergence")


def joint_move(df: DataFrame, a: str = "base_return_1m", b: str = "ref_return_1m",
               labels: Sequence[str] = JOINT_MOVE_LABELS, col: str = "quadrant") -> DataFrame:
    """Rows where both returns are valid, labelled both up / both down /
    divergence (a zero return counts as divergence)."""
    x, y = F.col(a), F.col(b)
    valid = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    q = (F.when((x > 0) & (y > 0), labels[0])
          .when((x < 0) & (y < 0), labels[1])
          .otherwise(labels[2]))
    return df.where(valid).withColumn(col, q)


def joint_move_daily(df: DataFrame, day: str = "execution_date", **kw) -> DataFrame:
    """Count of each joint-move label per day."""
    col = kw.get("col", "quadrant")
    return joint_move(df, **kw).groupBy(day, col).agg(F.count(F.lit(1)).alias("n_minutes"))


def preview(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows in an explicit order (a top-n, planned as
    TakeOrderedAndProject: each task keeps n rows, the driver merges)."""
    return df.orderBy(*order).limit(n)


def rollup(df: DataFrame, minutes: int, ts: str = "ts_minute_utc",
           bp: str = "base", rp: str = "ref") -> DataFrame:
    """Dashboard series per time bucket: mean prices, summed returns and
    volumes, high/low band, rows in market hours, rows (documents)."""
    from .candles import bucket_start
    b = bucket_start(ts, minutes).alias("bucket_start")
    return (df.groupBy(b)
              .agg(F.avg(f"{bp}_close").alias(f"avg_{bp}_close"),
                   F.avg(f"{rp}_close").alias(f"avg_{rp}_close"),
                   F.sum(f"{bp}_return_1m").alias(f"sum_{bp}_return"),
                   F.sum(f"{rp}_return_1m").alias(f"sum_{rp}_return"),
                   F.sum(f"{bp}_volume").alias(f"sum_{bp}_volume"),
                   F.max(f"{bp}_high").alias(f"max_{bp}_high"),
                   F.min(f"{bp}_low").alias(f"min_{bp}_low"),
                   F.count_if(F.col(f"{rp}_market_open")).alias("market_open_minutes"),
                   F.count(F.lit(1)).alias("doc_count")))


def freshness(df: DataFrame, as_of: str, ts: str = "ts_minute_utc",
              ingested: str = "ingested_at_utc", by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Per series: newest minute, newest ingest time and how many minutes
    the newest minute is behind ``as_of``."""
    a = F.lit(as_of).cast("timestamp_ntz")
    agg = df.groupBy(*by).agg(F.max(ts).alias("last_minute"),
                              F.max(ingested).alias("last_ingested"))
    return agg.withColumn("minutes_behind", minutes_between(a, F.col("last_minute")))


def latest(df: DataFrame, by: Sequence[str], ts: str = "ts_minute_utc",
           cols: Sequence[str] | None = None) -> DataFrame:
    """The newest row per group (hash aggregation of ``max_by``; ``ts`` is
    unique per group)."""
    cols = [c for c in (cols or df.columns) if c not in by]
    return df.groupBy(*by).agg(*[F.max_by(c, ts).alias(c) for c in cols])


def last_n(df: DataFrame, n: int, by: Sequence[str], ts: str = "ts_minute_utc") -> DataFrame:
    """The newest ``n`` rows per group (a top-n per group, the feature)."""
    w = Window.partitionBy(*by).orderBy(F.col(ts).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def series_profile(df: DataFrame, by: Sequence[str] = ("symbol",),
                   ts: str = "ts_minute_utc", day: str = "execution_date") -> DataFrame:
    """Row count, day count and time range per series."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"),
                               F.count_distinct(day).alias("days"),
                               F.min(ts).alias("first_minute"), F.max(ts).alias("last_minute"))


def locf_completeness(df: DataFrame, as_of: str | None = None, rp: str = "ref",
                      day: str = "execution_date") -> DataFrame:
    """Fill completeness per day and observed flag: rows, non-NULL ref
    closes, NULL ref returns. ``as_of`` keeps one day (the validation
    query of the current day); None reports every day."""
    x = df if as_of is None else df.where(F.col(day) == F.lit(as_of).cast("date"))
    return (x.groupBy(day, f"{rp}_market_open")
             .agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count(f"{rp}_close").alias(f"{rp}_close_non_null"),
                  F.count_if(F.col(f"{rp}_return_1m").isNull()).alias("nulls_return")))


def observed(df: DataFrame, name: str, ts: str = "ts_minute_utc"):
    """``df`` with row count and time range attached as observed metrics:
    they are computed by the action that consumes ``df`` (e.g. its write),
    so profiling costs no extra job. Returns (df, Observation); read
    ``observation.get`` after the action."""
    from pyspark.sql import Observation
    obs = Observation(name)
    aggs = [F.count(F.lit(1)).alias("rows")]
    if ts in df.columns:
        aggs += [F.min(ts).alias("first_minute"), F.max(ts).alias("last_minute")]
    return df.observe(obs, *aggs), obs


def null_profile(df: DataFrame) -> DataFrame:
    """NULL (and NaN) count per column, most NULLs first, plus the total
    row count, from one aggregation pass."""
    from pyspark.sql import types as T
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for f in df.schema.fields:
        isnull = F.col(f.name).isNull()
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            isnull = isnull | F.isnan(f.name)
        aggs.append(F.count_if(isnull).alias(f.name))
    one = df.agg(*aggs)
    pairs = ", ".join(f"'{f.name}', `{f.name}`" for f in df.schema.fields)
    long = one.selectExpr("__rows AS total_rows",
                          f"stack({len(df.schema.fields)}, {pairs}) AS (column_name, null_count)")
    return long.orderBy(F.col("null_count").desc(), F.col("column_name"))
