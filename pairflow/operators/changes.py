"""Which feature rows a change can touch, and those rows alone.

A feature row of ``lead_lag_features`` depends on base rows up to ``max_lag``
rows away, on the ref observations that reach it (each is carried to the
next complete one), on the day's seed (the previous day's last ref row) and on
whether the day has ref rows at all. Read backwards, from a touched minute to
the rows that can change:

* a base minute: itself;
* a ref minute that meets a base row, or a base minute that meets a ref row: all
  base rows up to the next complete observation of the day;
* the last ref row of a day: the next day's rows up to its first complete
  observation;
* the first ref rows of a day: the whole day;

and of all these ``max_lag`` rows more to each side. One pass of windows over
the touched days marks the rows; only marked rows and their neighbours enter
the feature windows. The rows of a day that no mark reaches are taken over
from the stored table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .pairing import filled_minutes, shifted_features

REF_COLUMNS = ("close", "volume", "high", "low")


def touched_days(base_touched: DataFrame, ref_touched: DataFrame, day: str = "execution_date",
                 seed: str = "previous_day") -> DataFrame:
    """The days whose features the touched minutes can change."""
    days = base_touched.select(day).unionByName(ref_touched.select(day))
    if seed == "previous_day":
        days = days.unionByName(ref_touched.select(F.date_add(day, 1).alias(day)))
    return days.distinct()


def marked_minutes(base: DataFrame, ref: DataFrame, base_touched: DataFrame,
                   ref_touched: DataFrame, *, max_lag: int = 5, seed: str = "previous_day",
                   ts: str = "ts_minute_utc", day: str = "execution_date",
                   by: Sequence[str] = ()) -> DataFrame:
    """The base minutes (by…, day, ts) that a change needs, with ``_changed``
    (its features can change) and ``_run`` (the number of its run of
    neighbouring rows in the day).

    ``base`` and ``ref`` are the series after the change, of the touched days
    and for the seed of the days before them; the touched frames hold
    (by…, day, ts) of the inserted or updated minutes."""
    keys = [*by, day]
    no = F.lit(False)
    complete = F.lit(True)
    for c in REF_COLUMNS:
        complete = complete & (F.col(c).isNotNull() if c in ref.columns else no)
    blank = {"_base": no, "_ref": no, "_full": no, "_hit_base": no, "_hit_ref": no}

    def tagged(df, **flags):
        return df.select(*keys, ts, *[flags.get(n, v).alias(n) for n, v in blank.items()])
    yes = F.lit(True)
    rows = (tagged(base, _base=yes).unionByName(tagged(ref, _ref=yes, _full=complete))
            .unionByName(tagged(base_touched, _hit_base=yes))
            .unionByName(tagged(ref_touched, _hit_ref=yes)))
    # a row a minute, of both series
    minutes = rows.groupBy(*keys, ts).agg(*[F.max(n).alias(n) for n in blank])

    # of each day: were all its ref rows touched, was its last one
    w_all = Window.partitionBy(*keys).orderBy(ts).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    ref_days = (minutes.where("_ref").groupBy(*keys)
                .agg(F.max_by("_hit_ref", ts).alias("_last_hit"),
                     F.min("_hit_ref").alias("_all_hit")))
    flags = ref_days.select(*keys, F.col("_all_hit").alias("_opened"), no.alias("_seed_hit"))
    if seed == "previous_day":
        flags = flags.unionByName(ref_days.where("_last_hit").select(
            *by, F.date_add(day, 1).alias(day), no.alias("_opened"), yes.alias("_seed_hit")))
    day_rows = flags.groupBy(*keys).agg(F.max("_opened").alias("_opened"),
                                        F.max("_seed_hit").alias("_seed_hit"))

    w_past = Window.partitionBy(*keys).orderBy(ts).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    hit = F.col("_base") & F.col("_ref") & (F.col("_hit_base") | F.col("_hit_ref"))
    seen = F.col("_base") & F.col("_full")
    line = (minutes.unionByName(day_rows, allowMissingColumns=True)
            .select("*", F.max("_opened").over(w_all).alias("_day_opened"),
                    F.max("_seed_hit").over(w_all).alias("_day_seed"),
                    F.max(F.when(hit, F.col(ts))).over(w_past).alias("_at_hit"),
                    F.max(F.when(seen, F.col(ts))).over(w_past).alias("_at_full"))
            .where("_base"))
    reached = F.coalesce(F.col("_at_hit") >= F.col("_at_full"), F.col("_at_hit").isNotNull())
    direct = (F.col("_hit_base") | reached | F.coalesce("_day_opened", no)
              | (F.coalesce("_day_seed", no) & F.col("_at_full").isNull()))
    w = Window.partitionBy(*keys).orderBy(ts)
    near = w.rowsBetween(-max_lag, max_lag)
    marked = (line.select(*keys, ts, direct.alias("_direct"))
              .select("*", F.max("_direct").over(near).alias("_changed"))
              .select("*", F.max("_changed").over(near).alias("_needed")))
    run = F.count_if(~F.col("_needed")).over(w.rowsBetween(Window.unboundedPreceding,
                                                           Window.currentRow))
    return (marked.withColumn("_run", run).where("_needed")
            .select(*keys, ts, "_changed", "_run"))


def changed_features(base: DataFrame, ref: DataFrame, base_touched: DataFrame,
                     ref_touched: DataFrame, *, max_lag: int = 5, seed: str = "previous_day",
                     ts: str = "ts_minute_utc", day: str = "execution_date",
                     by: Sequence[str] = (), prefixes: tuple[str, str] = ("base", "ref"),
                     ) -> tuple[DataFrame, DataFrame]:
    """(features, minutes): the feature rows after the change and all minutes
    (by…, day, ts) they stand for. A minute without a feature row is one that
    has lost it (it became a warm-up row)."""
    if seed == "last_known":
        raise ValueError("a last known seed reaches any later day: recompute whole days")
    marks = marked_minutes(base, ref, base_touched, ref_touched, max_lag=max_lag, seed=seed, ts=ts,
                           day=day, by=by)
    keys = [*by, day, ts]
    filled = filled_minutes(base, ref, seed=seed, ts=ts, day=day, by=by, prefixes=prefixes)
    needed = filled.join(marks, keys)
    # the neighbours' own features are not complete: only changed rows are kept
    out = shifted_features(needed, max_lag=max_lag, ts=ts, day=day, by=by, prefixes=prefixes,
                           within=["_run"])
    minutes = marks.where("_changed").select(*keys)
    return out.join(minutes, keys, "left_semi").select(*out.columns), minutes


def replaced(stored: DataFrame, features: DataFrame, minutes: DataFrame,
             keys: Sequence[str]) -> DataFrame:
    """The stored rows with the changed minutes replaced."""
    kept = stored.join(minutes, list(keys), "left_anti").select(*stored.columns)
    return kept.unionByName(features.select(*stored.columns))
