"""Registered queries: feature variants, warehouse models and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import nan_to_null
from ..operators import candles as cdl
from ..operators import moments, pairing, reports
from ..operators import quality as qr
from ..session import scratch_path
from . import fixtures as fx
from . import models
from . import oracle as o
from .registry import FEATURE_CTES, ORACLE, features, register

R = o.ROUND


def fsql(select: str, seed: str = "previous_day", max_lag: int = 5, warmup: bool = True,
         ref_name: str = "ref") -> str:
    return o.with_(*FEATURE_CTES, o.features_sql(seed=seed, max_lag=max_lag, warmup=warmup,
                                                 ref_name=ref_name)) + select


# --- F5 variants, D2, D3 ---------------------------------------------------------

@register("locf_intraday", fsql("SELECT * FROM features", seed="none", ref_name="sref"))
def q_locf_intraday(spark, sf_dir):
    """Carry forward within the day only (no seed)."""
    return features(spark, sf_dir, seed="none", scenario=True)


@register("locf_last_known", fsql("SELECT * FROM features", seed="last_known",
                                   ref_name="sref"))
def q_locf_last_known(spark, sf_dir):
    """Carry the last known ref value over the whole history, from stored
    candle layers: each series is aggregated from its ticks once."""
    base, ref = (models.materialize(df, f"candles_{n}", kind="table") for n, df in
                 (("base", fx.base_candles(spark, sf_dir)),
                  ("ref", fx.scenario_ref(fx.ref_candles(spark, sf_dir)))))
    return pairing.lead_lag_features(base, ref, max_lag=5, seed="last_known")


LOCF_COLS = ("execution_date, ts_minute_utc, ref_close, ref_volume, ref_high, ref_low, "
             "ref_market_open")


@register("locf_seeded", fsql(f"SELECT {LOCF_COLS} FROM features", max_lag=1, warmup=False,
                               ref_name="sref"))
def q_locf_seeded(spark, sf_dir):
    """Seeded LOCF of the ref columns on every base minute (no warm-up drop)."""
    base, ref = fx.base_candles(spark, sf_dir), fx.scenario_ref(fx.ref_candles(spark, sf_dir))
    f = pairing.lead_lag_features(base, ref, max_lag=1, drop_warmup=False)
    return f.select(*[c.strip() for c in LOCF_COLS.split(",")])


@register("prior_day_seed", o.with_(o.TICKS, o.BASE, o.REF, o.SCENARIO_REF) + """
SELECT CAST(execution_date + INTERVAL 1 DAY AS DATE) AS execution_date,
       last(close ORDER BY ts_minute_utc) AS ref_close,
       last(volume ORDER BY ts_minute_utc) AS ref_volume,
       last(high ORDER BY ts_minute_utc) AS ref_high,
       last(low ORDER BY ts_minute_utc) AS ref_low
FROM sref GROUP BY execution_date""")
def q_prior_day_seed(spark, sf_dir):
    """Last ref row of each day, keyed to the next day."""
    ref = fx.scenario_ref(fx.ref_candles(spark, sf_dir))
    s = pairing.prior_day_seed(ref, cols=pairing.side_columns("ref", False))
    return s.select("execution_date", "_s.*")


@register("features_ref_absent", fsql(f"""
SELECT f.execution_date, h.execution_date IS NOT NULL AS has_ref, count(*) AS n_rows,
       count(ref_close) AS ref_close_non_null, count(ref_close_lag_1) AS ref_lag_non_null,
       count(ref_return_1m) AS ref_return_non_null,
       CAST(count_if(ref_market_open) AS BIGINT) AS market_open_rows,
       min(ref_close) AS min_ref_close, max(ref_close) AS max_ref_close
FROM features f LEFT JOIN refdays h ON h.execution_date = f.execution_date
GROUP BY f.execution_date, h.execution_date IS NOT NULL""", ref_name="sref"))
def q_features_ref_absent(spark, sf_dir):
    """Per day: does the ref series have rows, and what the feature table
    holds for it (seed constants and NULL lag/return on absent days)."""
    ref = fx.scenario_ref(fx.ref_candles(spark, sf_dir))
    f = features(spark, sf_dir, scenario=True)
    refdays = ref.select("execution_date").distinct().withColumn("has_ref", F.lit(True))
    return (f.join(refdays, "execution_date", "left")
             .groupBy("execution_date", F.coalesce("has_ref", F.lit(False)).alias("has_ref"))
             .agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count("ref_close").alias("ref_close_non_null"),
                  F.count("ref_close_lag_1").alias("ref_lag_non_null"),
                  F.count("ref_return_1m").alias("ref_return_non_null"),
                  F.count_if("ref_market_open").alias("market_open_rows"),
                  F.min("ref_close").alias("min_ref_close"),
                  F.max("ref_close").alias("max_ref_close")))


@register("volume_lags", fsql("""
SELECT execution_date, ts_minute_utc, base_volume, base_volume_lag_1, base_volume_lag_2,
       base_volume_lag_3, base_volume_lag_4, base_volume_lag_5 FROM features"""))
def q_volume_lags(spark, sf_dir):
    f = features(spark, sf_dir)
    return f.select("execution_date", "ts_minute_utc", "base_volume",
                    *[f"base_volume_lag_{k}" for k in range(1, 6)])


@register("returns_1m", fsql("""
SELECT execution_date, ts_minute_utc, base_return_1m, ref_return_1m FROM features"""))
def q_returns_1m(spark, sf_dir):
    return features(spark, sf_dir).select("execution_date", "ts_minute_utc",
                                          "base_return_1m", "ref_return_1m")


# --- models -------------------------------------------------------------------

STG_COLS = ("ts_minute_utc, execution_date AS dt, base_high, base_low, base_close, base_volume, "
            "base_change_pct, base_close_lag_1, base_close_lead_1, base_return_1m, ref_high, "
            "ref_low, ref_close, ref_volume, ref_close_lag_1, ref_close_lead_1, ref_return_1m")


@register("staging_model", fsql(f"SELECT {STG_COLS} FROM features"), dates=("dt",))
def q_staging_model(spark, sf_dir):
    return models.staging(features(spark, sf_dir))


@register("aligned_mart", fsql(f"SELECT {STG_COLS} FROM features WHERE ref_close IS NOT NULL"),
          dates=("dt",))
def q_aligned_mart(spark, sf_dir):
    return models.aligned(models.staging(features(spark, sf_dir)), "non_null")


@register("aligned_market_open", fsql(f"SELECT {STG_COLS}, ref_market_open FROM features "
                                      "WHERE ref_market_open"), dates=("dt",))
def q_aligned_market_open(spark, sf_dir):
    stg = models.staging(features(spark, sf_dir), keep_flag=True)
    return models.aligned(stg, "market_open")


ENRICHED_SELECT = """SELECT ts_minute_utc, dt, base_high, base_low, base_close, base_volume,
       ref_high, ref_low, ref_close, ref_volume,
       coalesce(base_close_lag_1, lag(base_close, 1) OVER w) AS base_close_lag_1,
       coalesce(base_close_lead_1, lead(base_close, 1) OVER w) AS base_close_lead_1,
       coalesce(ref_close_lag_1, lag(ref_close, 1) OVER w) AS ref_close_lag_1,
       coalesce(ref_close_lead_1, lead(ref_close, 1) OVER w) AS ref_close_lead_1
FROM aln WINDOW w AS (ORDER BY ts_minute_utc)"""


@register("enriched_mart", fsql(f"""
, aln AS (SELECT {STG_COLS} FROM features WHERE ref_close IS NOT NULL)
{ENRICHED_SELECT}"""), dates=("dt",))
def q_enriched_mart(spark, sf_dir):
    """Aligned rows with lag/lead(1) refilled over the whole history, the
    chain staging (view) -> aligned (stored once, read for the rows and for
    their day edges) -> enriched."""
    stg = models.materialize(models.staging(features(spark, sf_dir)), "stg_features")
    aln = models.materialize(models.aligned(stg), "mart_aligned", kind="table")
    return models.enriched(aln)


PAIRS = {"all": "TRUE", "odd": "event_id % 2 = 1"}


def _pair_sql(name: str, where: str) -> str:
    """The enriched mart of one pair alone."""
    ticks = f"pticks AS (SELECT * FROM ticks WHERE {where})"
    base = o.candles_cte("base", "pticks", "ALL")
    ref = o.candles_cte("ref", "pticks", "REF",
                        f"event_type = 'purchase' AND {o.in_session()}", metrics="ref")
    return f"""SELECT '{name}' AS pair, * FROM ({o.with_(o.TICKS, ticks, base, ref, o.features_sql())}
, aln AS (SELECT {STG_COLS} FROM features WHERE ref_close IS NOT NULL)
{ENRICHED_SELECT})"""


def _pair_features(spark, sf_dir):
    t = fx.ticks(spark, sf_dir)
    parts = [t.where(where).withColumn("pair", F.lit(name)) for name, where in PAIRS.items()]
    rows = parts[0].unionByName(parts[1])
    purchase = (F.col("event_type") == "purchase") & fx.in_session()

    def candles(ticks):
        return cdl.candle_metrics(cdl.to_candles(ticks, symbol="pair", order=fx.TICK_ORDER)
                                  .withColumnRenamed("symbol", "pair"))

    return pairing.lead_lag_features(candles(rows), candles(rows.where(purchase)), by=["pair"])


@register("enriched_mart_pairs", "\nUNION ALL\n".join(_pair_sql(*p) for p in PAIRS.items()),
          dates=("dt",))
def q_enriched_mart_pairs(spark, sf_dir):
    """Two pairs in one feature table: neighbours never cross pairs."""
    f = _pair_features(spark, sf_dir)
    aln = models.materialize(models.aligned(models.staging(f, by=["pair"])), "mart_aligned_pairs",
                             kind="table")
    return models.enriched(aln, by=["pair"])


@register("daily_correlation_pairs", "\nUNION ALL\n".join(f"""
SELECT '{name}' AS pair, * FROM ({o.with_(o.TICKS, f"pticks AS (SELECT * FROM ticks WHERE {where})",
  o.candles_cte("base", "pticks", "ALL"),
  o.candles_cte("ref", "pticks", "REF", f"event_type = 'purchase' AND {o.in_session()}", metrics="ref"),
  o.features_sql())}
SELECT execution_date, count(*) AS record_count,
       round(CASE WHEN stddev_samp(base_return_1m) * stddev_samp(ref_return_1m) <> 0
                  THEN covar_samp(base_return_1m, ref_return_1m)
                       / (stddev_samp(base_return_1m) * stddev_samp(ref_return_1m)) END, {R})
         AS correlation_1m
FROM features WHERE base_return_1m IS NOT NULL AND ref_return_1m IS NOT NULL
GROUP BY execution_date)""" for name, where in PAIRS.items()))
def q_daily_correlation_pairs(spark, sf_dir):
    """Correlations per pair and day."""
    f = _pair_features(spark, sf_dir)
    return models.daily_correlation(f, by=["pair"]).select(
        "pair", "execution_date", "record_count", "correlation_1m")


@register("daily_correlation_states")
def q_daily_correlation_states(spark, sf_dir):
    """Daily correlation from states that were stored as the feature rows
    came, in three batches, and merged; no day is read again."""
    f = features(spark, sf_dir)
    stored = materialize_batches(f)
    root = scratch_path(spark, "moments")
    for batch in range(MOMENT_BATCHES):
        moments.add_moments(stored.where(F.col("batch") == batch).drop("batch"), root, batch)
    return moments.stored_correlation(spark, root, moments.state_schema(f))


MOMENT_BATCHES = 3


def materialize_batches(f):
    """The feature rows dealt to batches by their minute, written once."""
    path = scratch_path(f.sparkSession, "moment-batches")
    (f.withColumn("batch", F.minute("ts_minute_utc") % MOMENT_BATCHES)
     .write.partitionBy("batch").parquet(path))
    return f.sparkSession.read.parquet(path)


ORACLE["daily_correlation_states"] = ORACLE["daily_correlation"]


# --- reports --------------------------------------------------------------------

@register("locf_completeness", fsql("""
SELECT execution_date, ref_market_open, count(*) AS n_rows, count(ref_close) AS ref_close_non_null,
       count(*) FILTER (WHERE ref_return_1m IS NULL) AS nulls_return
FROM features GROUP BY execution_date, ref_market_open"""))
def q_locf_completeness(spark, sf_dir):
    return reports.locf_completeness(features(spark, sf_dir))


AS_OF = "2024-01-05"


@register("locf_completeness_as_of", fsql(f"""
SELECT execution_date, ref_market_open, count(*) AS n_rows, count(ref_close) AS ref_close_non_null,
       count(*) FILTER (WHERE ref_return_1m IS NULL) AS nulls_return
FROM features WHERE execution_date = DATE '{AS_OF}' GROUP BY execution_date, ref_market_open"""))
def q_locf_completeness_as_of(spark, sf_dir):
    """The validation query of one day."""
    return reports.locf_completeness(features(spark, sf_dir), as_of=AS_OF)


QUAD = f"""CASE WHEN base_return_1m > 0 AND ref_return_1m > 0 THEN 'both_up'
            WHEN base_return_1m < 0 AND ref_return_1m < 0 THEN 'both_down'
            ELSE 'divergence' END"""


@register("joint_move_quadrants", fsql(f"""
SELECT execution_date, ts_minute_utc, base_return_1m, ref_return_1m, {QUAD} AS quadrant
FROM features WHERE base_return_1m IS NOT NULL AND ref_return_1m IS NOT NULL"""))
def q_joint_move_quadrants(spark, sf_dir):
    j = reports.joint_move(features(spark, sf_dir))
    return j.select("execution_date", "ts_minute_utc", "base_return_1m", "ref_return_1m", "quadrant")


@register("joint_move_daily", fsql(f"""
SELECT execution_date, {QUAD} AS quadrant, count(*) AS n_minutes
FROM features WHERE base_return_1m IS NOT NULL AND ref_return_1m IS NOT NULL
GROUP BY ALL"""))
def q_joint_move_daily(spark, sf_dir):
    return reports.joint_move_daily(features(spark, sf_dir))


@register("joint_move_preview", fsql(f"""
SELECT execution_date, ts_minute_utc, base_return_1m, ref_return_1m, {QUAD} AS quadrant
FROM features WHERE base_return_1m IS NOT NULL AND ref_return_1m IS NOT NULL
ORDER BY ts_minute_utc DESC LIMIT 1000"""))
def q_joint_move_preview(spark, sf_dir):
    """The newest 1,000 labelled minutes (the size-capped chart fetch)."""
    j = reports.joint_move(features(spark, sf_dir))
    return reports.preview(j, 1000, [F.col("ts_minute_utc").desc()]).select(
        "execution_date", "ts_minute_utc", "base_return_1m", "ref_return_1m", "quadrant")


@register("dashboard_rollup", fsql(f"""
SELECT ts_minute_utc - INTERVAL ((hour(ts_minute_utc) * 60 + minute(ts_minute_utc)) % 60) MINUTE
         AS bucket_start,
       round(avg(base_close), {R}) AS avg_base_close, round(avg(ref_close), {R}) AS avg_ref_close,
       round(sum(base_return_1m), {R}) AS sum_base_return,
       round(sum(ref_return_1m), {R}) AS sum_ref_return,
       sum(base_volume) AS sum_base_volume, max(base_high) AS max_base_high,
       min(base_low) AS min_base_low, CAST(count_if(ref_market_open) AS BIGINT) AS market_open_minutes,
       count(*) AS doc_count
FROM features GROUP BY 1"""), dates=())
def q_dashboard_rollup(spark, sf_dir):
    """Hourly dashboard series of the feature table."""
    r = reports.rollup(features(spark, sf_dir), 60)
    rnd = {c: F.round(c, R) for c in ("avg_base_close", "avg_ref_close", "sum_base_return",
                                      "sum_ref_return")}
    return r.withColumns(rnd)


@register("freshness_report", o.with_(o.TICKS, o.BASE, o.REF) + """
, s AS (SELECT symbol, ts_minute_utc, ingested_at_utc FROM base
        UNION ALL SELECT symbol, ts_minute_utc, ingested_at_utc FROM ref)
SELECT symbol, max(ts_minute_utc) AS last_minute, max(ingested_at_utc) AS last_ingested,
       CAST(date_diff('minute', max(ts_minute_utc), TIMESTAMP '2024-01-31 00:00:00') AS BIGINT)
         AS minutes_behind
FROM s GROUP BY symbol""", dates=())
def q_freshness_report(spark, sf_dir):
    """Newest minute and ingest per series, minutes behind the run time."""
    s = fx.base_candles(spark, sf_dir).unionByName(fx.ref_candles(spark, sf_dir),
                                                    allowMissingColumns=True)
    return reports.freshness(s, "2024-01-31 00:00:00")


@register("latest_per_series", o.with_(o.TICKS, o.BASE, o.REF) + """
SELECT symbol, arg_max(ts_minute_utc, ts_minute_utc) AS ts_minute_utc,
       arg_max(close, ts_minute_utc) AS close, arg_max(volume, ts_minute_utc) AS volume
FROM (SELECT symbol, ts_minute_utc, close, volume FROM base
      UNION ALL SELECT symbol, ts_minute_utc, close, volume FROM ref) GROUP BY symbol""", dates=())
def q_latest_per_series(spark, sf_dir):
    s = fx.base_candles(spark, sf_dir).unionByName(fx.ref_candles(spark, sf_dir),
                                                    allowMissingColumns=True)
    return reports.latest(s.select("symbol", "ts_minute_utc", "close", "volume"), ["symbol"])


@register("last_n_per_series", o.with_(o.TICKS, o.BASE, o.REF) + """
SELECT symbol, execution_date, ts_minute_utc, close FROM (
  SELECT symbol, execution_date, ts_minute_utc, close FROM base
  UNION ALL SELECT symbol, execution_date, ts_minute_utc, close FROM ref)
QUALIFY row_number() OVER (PARTITION BY symbol, execution_date ORDER BY ts_minute_utc DESC) <= 5""")
def q_last_n_per_series(spark, sf_dir):
    """The last 5 candles of each series and day (one pull's worth)."""
    s = fx.base_candles(spark, sf_dir).unionByName(fx.ref_candles(spark, sf_dir),
                                                    allowMissingColumns=True)
    return reports.last_n(s.select("symbol", "execution_date", "ts_minute_utc", "close"), 5,
                          ["symbol", "execution_date"])


@register("series_profile", o.with_(o.TICKS, o.BASE, o.REF) + """
SELECT symbol, count(*) AS rows, count(DISTINCT execution_date) AS days,
       min(ts_minute_utc) AS first_minute, max(ts_minute_utc) AS last_minute
FROM (SELECT symbol, execution_date, ts_minute_utc FROM base
      UNION ALL SELECT symbol, execution_date, ts_minute_utc FROM ref) GROUP BY symbol""", dates=())
def q_series_profile(spark, sf_dir):
    s = fx.base_candles(spark, sf_dir).unionByName(fx.ref_candles(spark, sf_dir),
                                                    allowMissingColumns=True)
    return reports.series_profile(s)


NULLPROF_COLS = ["open", "high", "low", "close", "volume", "trades"]


@register("null_profile", o.with_(o.TICKS, o.GAPPY_TICKS, o.GAPPY) + """
SELECT (SELECT count(*) FROM gappy) AS total_rows, column_name, null_count FROM (
  UNPIVOT (SELECT CAST(count_if(open IS NULL) AS BIGINT) AS open, CAST(count_if(high IS NULL) AS BIGINT) AS high,
                  CAST(count_if(low IS NULL) AS BIGINT) AS low, CAST(count_if(close IS NULL) AS BIGINT) AS close,
                  CAST(count_if(volume IS NULL) AS BIGINT) AS volume, CAST(count_if(trades IS NULL) AS BIGINT) AS trades
           FROM gappy)
  ON open, high, low, close, volume, trades INTO NAME column_name VALUE null_count)""", dates=())
def q_null_profile(spark, sf_dir):
    """NULLs per column of the NULL-bearing candles, most first."""
    return reports.null_profile(fx.gappy_candles(spark, sf_dir).select(*NULLPROF_COLS))


@register("nan_to_null", o.with_(o.TICKS, o.GAPPY_TICKS, o.GAPPY) + """
SELECT ts_minute_utc, open, high, low, close, trades FROM gappy""", dates=())
def q_nan_to_null(spark, sf_dir):
    """Candles whose missing prices arrive as NaN (as a pandas writer
    stores them) come back with NULL."""
    nan = F.lit(float("nan"))
    c = fx.gappy_candles(spark, sf_dir)
    with_nan = c.select("ts_minute_utc", *[F.coalesce(x, nan).alias(x) for x in
                                            ("open", "high", "low", "close")], "trades")
    return nan_to_null(with_nan)


def _nulls_sql(model: str, cols) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{model}' AS model, 'not_null' AS rule, '{c}' AS column_name, "
        f"CAST(count_if({c} IS NULL) AS BIGINT) AS violations FROM {model}" for c in cols)


def _unique_sql(model: str, key: str, label: str | None = None) -> str:
    return (f"SELECT '{model}', 'unique', '{label or key}', CAST(coalesce(sum(n - 1), 0) AS BIGINT) "
            f"FROM (SELECT count(*) AS n FROM {model} GROUP BY {key})")


NOT_NULL = {m: [c.format(b="base", r="ref") for c in cols]
            for m, cols in models.DECLARED_NOT_NULL.items()}


@register("quality_report", o.with_(*FEATURE_CTES, o.overlap_cte("candles", "base_c"),
                                    o.features_sql()) + f"""
, staging AS (SELECT {STG_COLS} FROM features),
aligned AS (SELECT * FROM staging WHERE ref_close IS NOT NULL),
aln AS (SELECT * FROM aligned),
enriched AS ({ENRICHED_SELECT}),
ordered AS (SELECT *, lag(ts_minute_utc) OVER (PARTITION BY symbol, execution_date
                                               ORDER BY ingested_at_utc, ts_minute_utc) AS prev
            FROM candles)
""" + "\nUNION ALL ".join([*(_nulls_sql(m, c) for m, c in NOT_NULL.items()),
                            *(_unique_sql(m, "dt, ts_minute_utc", "dt,ts_minute_utc")
                              for m in NOT_NULL)]) + """
UNION ALL SELECT 'candles', 'positive', 'close', CAST(count_if(close <= 0) AS BIGINT) FROM candles
UNION ALL SELECT 'candles', 'positive', 'volume', CAST(count_if(volume <= 0) AS BIGINT) FROM candles
UNION ALL SELECT 'candles', 'high_ge_low', 'high,low', CAST(count_if(high < low) AS BIGINT) FROM candles
UNION ALL SELECT 'candles', 'accepted_values', 'symbol', CAST(count_if(symbol NOT IN ('ALL')) AS BIGINT)
  FROM candles
UNION ALL SELECT 'candles', 'strictly_increasing', 'ts_minute_utc',
  CAST(count_if(prev >= ts_minute_utc) AS BIGINT) FROM ordered
UNION ALL """ + _unique_sql("candles", "symbol, execution_date, ts_minute_utc",
                            "symbol,execution_date,ts_minute_utc") + """
UNION ALL SELECT 'candles', 'required_column', 'trades', 0
UNION ALL SELECT 'candles', 'required_column', 'source', 1""", dates=())
def q_quality_report(spark, sf_dir):
    """The declared rules of the three stored models, and the checks of the
    landed candles with their overlapping pulls: a re-fetched minute arrives
    behind later ones, which the order and the uniqueness rule count."""
    built = models.build_models(features(spark, sf_dir), scratch_path(spark, "models"))
    declared = models.check_models(built)
    c = fx.overlapping_pulls(fx.base_candles(spark, sf_dir, metrics=False))
    return declared.unionByName(qr.expectations(
        c, [qr.positive("close"), qr.positive("volume"), qr.ordered_pair("high", "low"),
            qr.accepted_values("symbol", ["ALL"])],
        unique_key=["symbol", "execution_date", "ts_minute_utc"], order_by="ts_minute_utc",
        order_within=["symbol", "execution_date"], arrival="ingested_at_utc",
        required=["trades", "source"], model="candles"))
