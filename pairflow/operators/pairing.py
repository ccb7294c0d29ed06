"""Pairing a 24/7 series with a market-hours series on the minute.

Physical shape of ``lead_lag_features`` (one shuffle of the candle rows):

    base rows ─┐
    ref rows  ─┼─ union ─ repartition(by…, day) ─ window(minute: its ref rows)
    seed rows ─┘          └── window(has_ref, seed) ─ filter base present
                              ─ window(LOCF, base lag/lead) ─ window(ref lag/lead)

* The left join on (day, minute) is a window over the union: every base row
  gets the ref rows of its minute, none or one for candles. All windows share
  the hash partitioning on (by…, day) and the order by minute, so one exchange
  and one sort serve them; no join is planned, so there is nothing to
  broadcast and nothing to size-check.
* The previous day's seed arrives as one extra row per (by…, day) carrying
  a struct; a whole-partition ``max`` window hands it to every minute.
* Partitions are (pair, day): at most 1,440 minutes per series, whatever
  the skew of the raw feed, so no window partition can grow with the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import pct_change
from .timeseries import lag_lead_columns

SEED_MODES = ("previous_day", "last_known", "none")


def _day(df: DataFrame, day: str, ts: str) -> Column:
    return F.col(day) if day in df.columns else F.col(ts).cast("date")


def _side(df: DataFrame, cols: Mapping[str, str]) -> Column:
    """Struct of ``out_name <- source column``; absent sources are typed NULL."""
    return F.struct(*[
        (F.col(src) if src in df.columns else F.lit(None).cast("double")).alias(out)
        for out, src in cols.items()])


def side_columns(prefix: str, with_change_pct: bool) -> dict[str, str]:
    cols = {f"{prefix}_close": "close", f"{prefix}_volume": "volume",
            f"{prefix}_high": "high", f"{prefix}_low": "low"}
    if with_change_pct:
        cols[f"{prefix}_change_pct"] = "price_change_pct"
    return cols


def paired_minutes(base: DataFrame, ref: DataFrame, *, base_cols: Mapping[str, str],
                   ref_cols: Mapping[str, str], ts: str = "ts_minute_utc",
                   day: str = "execution_date", by: Sequence[str] = (),
                   seeds: DataFrame | None = None) -> DataFrame:
    """The rows of both sides on their minute, plus one seed row per
    (by…, day) when ``seeds`` is given (its minute is NULL).

    Columns: by…, day, ts, ``_b`` (base struct or NULL), ``_r`` (ref struct
    or NULL), ``_s`` (seed struct or NULL).

    Both sides travel in one union, hashed and sorted once by (by…, day, ts).
    A window over the minute hands its ref rows to each base row, as a left
    join does: a minute with several rows on a side (raw pulls that were not
    deduplicated, two series without ``by``) keeps every pair of them and
    never mixes the columns of two rows. Candles hold one row a minute and
    side, so a (by…, day) partition has 1,440 rows per side.
    """
    keys = [*by, day]
    sides = {"_b": (base, base_cols), "_r": (ref, ref_cols)}
    parts = []
    for tag, (df, cols) in sides.items():
        parts.append(df.select(
            *[F.col(k) for k in by], _day(df, day, ts).alias(day), F.col(ts).alias(ts),
            *[(F.col(src) if src in df.columns else F.lit(None).cast("double")).alias(f"{tag}_{out}")
              for out, src in cols.items()], F.lit(True).alias(f"{tag}_p")))
    seed_cols: list[str] = []
    if seeds is not None:
        seed_cols = seeds.schema["_s"].dataType.fieldNames()
        tstype = parts[0].schema[ts].dataType
        parts.append(seeds.select(*keys, F.lit(None).cast(tstype).alias(ts),
                                  *[F.col(f"_s.{c}").alias(f"_s_{c}") for c in seed_cols],
                                  F.lit(True).alias("_s_p")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    u = u.repartition(*keys)

    def rebuild(tag: str, names: Sequence[str]):
        return F.when(F.col(f"{tag}_p"), F.struct(*[F.col(f"{tag}_{n}").alias(n) for n in names]))

    b, r = rebuild("_b", list(base_cols)), rebuild("_r", list(ref_cols))
    s = rebuild("_s", seed_cols) if seeds is not None else \
        F.when(F.lit(False), F.struct(*[F.col(f"_r_{n}").alias(n) for n in ref_cols]))
    rows = u.select(*keys, ts, b.alias("_b"), r.alias("_r"), s.alias("_s"))
    # the minute's ref rows reach every base row of the minute; a minute holds
    # one row a side unless the input repeats it
    same = Window.partitionBy(*keys, ts)
    rows = rows.withColumn("_refs", F.when(F.col("_b").isNotNull(),
                                           F.collect_list("_r").over(same)))
    matched = F.when(F.size("_refs") > 0, F.col("_refs")).otherwise(F.array(F.col("_r")))
    return (rows.where(F.col("_b").isNotNull() | F.col("_r").isNotNull() | F.col("_s").isNotNull())
                .withColumn("_r", F.explode(matched)).select(*keys, ts, "_b", "_r", "_s"))


def pair_join(base: DataFrame, ref: DataFrame, *, ts: str = "ts_minute_utc",
              day: str = "execution_date", by: Sequence[str] = (),
              prefixes: tuple[str, str] = ("base", "ref")) -> DataFrame:
    """LEFT join of the continuous series with the intermittent one on
    (by…, day, minute), plus ``<ref>_market_open`` = a ref row matched."""
    bp, rp = prefixes
    bcols, rcols = side_columns(bp, True), side_columns(rp, False)
    p = paired_minutes(base, ref, base_cols=bcols, ref_cols=rcols, ts=ts, day=day, by=by)
    return (p.where(F.col("_b").isNotNull())
             .select(*by, day, ts, "_b.*", "_r.*",
                     F.col(f"_r.{rp}_close").isNotNull().alias(f"{rp}_market_open")))


def prior_day_seed(ref: DataFrame, *, cols: Mapping[str, str], ts: str = "ts_minute_utc",
                   day: str = "execution_date", by: Sequence[str] = ()) -> DataFrame:
    """Last row of each day of ``ref``, keyed to the following calendar day.

    One row per (by…, day) with struct ``_s``; NULL values stay NULL.
    Minutes are unique within a day, so per-column ``max_by(c, ts)`` reads
    one row; each has a fixed-width buffer, so this is a hash aggregation
    with map-side partial aggregation (one row per map task and day).
    """
    keys = [*by, day]
    last = (ref.select(*by, _day(ref, day, ts).alias(day), ts,
                       *[(F.col(src) if src in ref.columns else F.lit(None).cast("double"))
                         .alias(out) for out, src in cols.items()])
               .groupBy(*keys).agg(*[F.max_by(out, ts).alias(out) for out in cols]))
    return last.select(*by, F.date_add(F.col(day), 1).alias(day),
                       F.struct(*cols).alias("_s"))


def last_known_seed(base: DataFrame, ref: DataFrame, *, cols: Mapping[str, str],
                    ts: str = "ts_minute_utc", day: str = "execution_date",
                    by: Sequence[str] = ()) -> DataFrame:
    """Per (by…, day): each column's last non-NULL ref value from any
    earlier day, however long ago (carry over the whole history).

    Built from one row per (by…, day) of either series, by one aggregation of
    their union (base rows bring their day and no value); the window over
    that table is the only ordering across days and its size is the
    number of calendar days (per ``by`` group), not the number of rows.
    """
    keys = [*by, day]
    seen = ref.select(*by, _day(ref, day, ts).alias(day), ts,
                      *[F.col(src).cast("double").alias(out) for out, src in cols.items()])
    days = base.select(*by, _day(base, day, ts).alias(day), F.col(ts),
                       *[F.lit(None).cast("double").alias(out) for out in cols])
    daily = (seen.unionByName(days).groupBy(*keys)
                 .agg(*[F.max_by(out, F.when(F.col(out).isNotNull(), F.col(ts))).alias(out)
                        for out in cols]))
    w = Window.partitionBy(*by).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    return daily.select(*keys, F.struct(*[F.last(out, ignorenulls=True).over(w).alias(out)
                                          for out in cols]).alias("_s"))


def lead_lag_features(base: DataFrame, ref: DataFrame, *, max_lag: int = 5,
                      seed: str = "previous_day", ts: str = "ts_minute_utc",
                      day: str = "execution_date", by: Sequence[str] = (),
                      prefixes: tuple[str, str] = ("base", "ref"),
                      drop_warmup: bool = True, audit: bool = False,
                      seeds: DataFrame | None = None) -> DataFrame:
    """The feature table: base minutes with the ref series aligned and
    carried forward, lag/lead 1..max_lag, 1-minute returns.

    * ``seed``: ``"previous_day"`` (last ref row of day J-1 fills the start
      of day J), ``"last_known"`` (last non-NULL value from any earlier day)
      or ``"none"`` (carry within the day only). ``seeds`` brings the seeds
      instead, as (by…, day, struct ``_s`` of the ref columns), e.g. from
      stored snapshots (``sources.carry``); ``ref`` then needs no earlier day.
    * On a day where the ref series has no rows at all the ref columns hold
      the seed, ``<ref>_market_open`` is false and the ref lag/lead/return
      columns are NULL.
    * ``drop_warmup`` drops the first minute of each day (no lag 1).
    * Output schema is fixed for any input.
    """
    if seed not in SEED_MODES:
        raise ValueError(f"seed must be one of {SEED_MODES}")
    filled = filled_minutes(base, ref, seed=seed, ts=ts, day=day, by=by, prefixes=prefixes,
                            seeds=seeds)
    return shifted_features(filled, max_lag=max_lag, ts=ts, day=day, by=by, prefixes=prefixes,
                            drop_warmup=drop_warmup, audit=audit)


def filled_minutes(base: DataFrame, ref: DataFrame, *, seed: str = "previous_day",
                   ts: str = "ts_minute_utc", day: str = "execution_date",
                   by: Sequence[str] = (), prefixes: tuple[str, str] = ("base", "ref"),
                   seeds: DataFrame | None = None) -> DataFrame:
    """Base minutes with the ref columns carried forward, ``<ref>_market_open``
    and ``_has_ref`` (the day has any ref row)."""
    bp, rp = prefixes
    keys = [*by, day]
    bcols, rcols = side_columns(bp, True), side_columns(rp, False)
    if seeds is not None:
        pass
    elif seed == "previous_day":
        seeds = prior_day_seed(ref, cols=rcols, ts=ts, day=day, by=by)
    elif seed == "last_known":
        seeds = last_known_seed(base, ref, cols=rcols, ts=ts, day=day, by=by)

    p = paired_minutes(base, ref, base_cols=bcols, ref_cols=rcols, ts=ts, day=day,
                       by=by, seeds=seeds)
    w_all = Window.partitionBy(*keys).orderBy(ts).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    p = p.select("*", F.max(F.col("_r").isNotNull()).over(w_all).alias("_has_ref"),
                 F.max("_s").over(w_all).alias("_seed"))
    flat = p.where(F.col("_b").isNotNull()).select(
        *keys, ts, *[F.col(f"_b.{c}").alias(c) for c in bcols],
        *[F.col(f"_r.{c}").alias(f"_obs_{c}") for c in rcols],
        *[F.col(f"_seed.{c}").alias(f"_seed_{c}") for c in rcols], "_has_ref")
    w_fill = Window.partitionBy(*keys).orderBy(ts).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    filled = [F.coalesce(F.last(f"_obs_{c}", ignorenulls=True).over(w_fill),
                         F.col(f"_seed_{c}")).alias(c) for c in rcols]
    return flat.select(*keys, ts, *bcols, *filled,
                       F.col(f"_obs_{rp}_close").isNotNull().alias(f"{rp}_market_open"), "_has_ref")


def shifted_features(filled: DataFrame, *, max_lag: int = 5, ts: str = "ts_minute_utc",
                     day: str = "execution_date", by: Sequence[str] = (),
                     prefixes: tuple[str, str] = ("base", "ref"), drop_warmup: bool = True,
                     audit: bool = False, within: Sequence[str] = ()) -> DataFrame:
    """The feature columns over ``filled_minutes``: lags, leads and returns
    inside (by…, day) and, if given, the runs of rows that ``within`` names
    (columns that are not returned)."""
    bp, rp = prefixes
    bcols, rcols = side_columns(bp, True), side_columns(rp, False)
    rc, bc = f"{rp}_close", f"{bp}_close"
    w = Window.partitionBy(*by, day, *within).orderBy(ts)
    has_ref = F.col("_has_ref")
    ref_shift = [F.when(has_ref, x) for x in lag_lead_columns([rc], w, max_lag)]
    ref_names = [n for k in range(1, max_lag + 1) for n in (f"{rc}_lag_{k}", f"{rc}_lead_{k}")]
    stage2 = filled.select("*", *lag_lead_columns([bc], w, max_lag),
                           *lag_lead_columns([f"{bp}_volume"], w, max_lag, leads=False),
                           *[x.alias(n) for x, n in zip(ref_shift, ref_names)])

    ordered = []
    for k in range(1, max_lag + 1):
        ordered += [f"{bc}_lag_{k}", f"{bc}_lead_{k}", f"{bp}_volume_lag_{k}",
                    f"{rc}_lag_{k}", f"{rc}_lead_{k}"]
    out = [*by, ts, *bcols, *rcols, f"{rp}_market_open", *ordered,
           pct_change(bc, f"{bc}_lag_1").alias(f"{bp}_return_1m"),
           F.when(has_ref, pct_change(rc, f"{rc}_lag_1")).alias(f"{rp}_return_1m")]
    if audit:
        out.append(F.current_timestamp().alias("processed_at_utc"))
    out.append(day)
    res = stage2.select(*out)
    if drop_warmup:
        res = res.where(F.col(f"{bc}_lag_1").isNotNull())
    return res
