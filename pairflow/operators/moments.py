"""Mergeable co-moments: the daily correlation without reading a day again.

The state of some rows of a (pair, day) is (n, the least value and the mean's
distance from it, of both sides; both sums of squared deviations; the sum of
co-deviations). States of disjoint rows merge into the state of their union, in
any order and in any number of steps; with all means measured from one least
value,

    off = sum n_i off_i / n
    m2  = sum m2_i + sum n_i (off_i - off)^2
    c   = sum c_i  + sum n_i (off_a_i - off_a)(off_b_i - off_b)

Nothing is squared or added up but distances between near values, so a large
mean with a tiny variance keeps its digits, and equal values have a variance of
exactly 0.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def moments(features: DataFrame, a: str = "base_return_1m", b: str = "ref_return_1m",
            day: str = "execution_date", by: Sequence[str] = ()) -> DataFrame:
    """One state per (by…, day) of the rows where both values are there."""
    w = Window.partitionBy(*by, day)  # a day's minutes, no more
    rows = (features.where(F.col(a).isNotNull() & F.col(b).isNotNull())
            .select(*by, day, F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"))
            .select("*", *[F.min(s).over(w).alias(f"low_{s}") for s in "ab"])
            .select("*", *[F.avg(F.col(s) - F.col(f"low_{s}")).over(w).alias(f"off_{s}")
                           for s in "ab"]))
    da, db = (F.col(s) - F.col(f"low_{s}") - F.col(f"off_{s}") for s in "ab")
    return rows.groupBy(*by, day).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.first(f"{part}_{s}").alias(f"{part}_{s}") for part in ("low", "off") for s in "ab"],
        F.sum(da * da).alias("m2_a"), F.sum(db * db).alias("m2_b"), F.sum(da * db).alias("c"))


def merge_moments(states: DataFrame, day: str = "execution_date",
                  by: Sequence[str] = ()) -> DataFrame:
    """One state per (by…, day) from any number of them."""
    keys = [*by, day]
    w = Window.partitionBy(*keys)
    one = (states.select("*", *[F.min(f"low_{s}").over(w).alias(f"_low_{s}") for s in "ab"])
           .select("*", *[(F.col(f"low_{s}") - F.col(f"_low_{s}") + F.col(f"off_{s}"))
                          .alias(f"_off_{s}") for s in "ab"])
           .select("*", *[(F.sum(F.col("n") * F.col(f"_off_{s}")).over(w) / F.sum("n").over(w))
                          .alias(f"_mean_{s}") for s in "ab"]))
    da, db = (F.col(f"_off_{s}") - F.col(f"_mean_{s}") for s in "ab")
    return one.groupBy(*keys).agg(
        F.sum("n").alias("n"), *[F.first(f"_low_{s}").alias(f"low_{s}") for s in "ab"],
        *[F.first(f"_mean_{s}").alias(f"off_{s}") for s in "ab"],
        F.sum(F.col("m2_a") + F.col("n") * da * da).alias("m2_a"),
        F.sum(F.col("m2_b") + F.col("n") * db * db).alias("m2_b"),
        F.sum(F.col("c") + F.col("n") * da * db).alias("c"))


def correlation_of(states: DataFrame, bp: str = "base", rp: str = "ref",
                   day: str = "execution_date", by: Sequence[str] = ()) -> DataFrame:
    """The columns of ``daily_correlation`` from merged states."""
    from ..plans.models import STATS_DIGITS
    rnd = lambda c: F.round(c, STATS_DIGITS)
    free = F.nullif(F.col("n") - 1, F.lit(0))
    sd_a, sd_b = (F.sqrt(F.col(f"m2_{s}") / free) for s in "ab")
    return states.select(
        *by, day, F.col("n").alias("record_count"),
        rnd(F.try_divide(F.col("c") / free, sd_a * sd_b)).alias("correlation_1m"),
        *[rnd(F.col(f"low_{s}") + F.col(f"off_{s}")).alias(f"avg_{p}_return")
          for s, p in (("a", bp), ("b", rp))],
        rnd(sd_a).alias(f"stddev_{bp}_return"), rnd(sd_b).alias(f"stddev_{rp}_return"))


def state_schema(features: DataFrame, day: str = "execution_date",
                 by: Sequence[str] = ()) -> T.StructType:
    return moments(features.limit(0), day=day, by=by).schema


def add_moments(features: DataFrame, root: str, batch: int, day: str = "execution_date",
                by: Sequence[str] = ()) -> None:
    """Store the states of a batch of new feature rows (rows of earlier
    batches must not come again; a replay under the same number replaces
    itself) and merge the stored ones level by level."""
    from ..streaming import segments
    states = moments(features, day=day, by=by)
    segments.write_segment(states, root, day, batch)
    segments.compact(features.sparkSession, root, day, states.schema,
                     segments.day_values(features, day),
                     lambda rows: merge_moments(rows, day, by).select(*states.columns))


def stored_correlation(spark: SparkSession, root: str, schema: T.StructType,
                       days: Iterable[str] | None = None, bp: str = "base", rp: str = "ref",
                       day: str = "execution_date", by: Sequence[str] = ()) -> DataFrame:
    """The correlation of each day from the stored states alone."""
    from ..streaming import segments
    asked = segments.all_days(spark, root, day) if days is None else days
    states = segments.read_days(spark, root, day, schema, asked)
    return correlation_of(merge_moments(states, day, by), bp, rp, day, by)
