"""The warehouse-side models: staging, aligned, enriched, daily correlation,
and the reports built on the feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import safe_corr
from ..operators.quality import expectations, not_null
from ..operators.timeseries import whole_history_shift
from ..sources.sinks import write_layer

STATS_DIGITS = 9


def staging(features: DataFrame, bp: str = "base", rp: str = "ref",
            keep_flag: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Typed projection of the feature table (17 columns; 18 with
    ``keep_flag``, which keeps ``<ref>_market_open`` for the market_open
    mode of ``aligned``), led by the pair keys ``by`` of a table that holds
    several pairs."""
    d = "double"
    cols = [F.col(c) for c in by]
    cols += [F.col("ts_minute_utc").cast("timestamp_ntz").alias("ts_minute_utc"),
            F.col("execution_date").cast("date").alias("dt")]
    for c in ("high", "low", "close", "volume", "change_pct", "close_lag_1",
              "close_lead_1", "return_1m"):
        cols.append(F.col(f"{bp}_{c}").cast(d).alias(f"{bp}_{c}"))
    for c in ("high", "low", "close", "volume", "close_lag_1", "close_lead_1", "return_1m"):
        cols.append(F.col(f"{rp}_{c}").cast(d).alias(f"{rp}_{c}"))
    if keep_flag:
        cols.append(F.col(f"{rp}_market_open").cast("boolean").alias(f"{rp}_market_open"))
    return features.select(*cols)


def aligned(stg: DataFrame, mode: str = "non_null", rp: str = "ref") -> DataFrame:
    """Rows where the ref series is usable: ``non_null`` keeps a non-NULL
    ref close (carried values included); ``market_open`` keeps minutes with
    an actual ref observation (needs ``<ref>_market_open``)."""
    if mode == "non_null":
        return stg.where(F.col(f"{rp}_close").isNotNull())
    if mode == "market_open":
        return stg.where(F.col(f"{rp}_market_open"))
    raise ValueError("mode must be 'non_null' or 'market_open'")


def enriched(aln: DataFrame, bp: str = "base", rp: str = "ref",
             keep_calc: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Stored lag/lead(1) preferred, else recomputed over the whole history
    of a pair's aligned rows (neighbours are aligned rows, across days).

    The aligned rows are read twice, for the rows and for their day edges:
    pass a stored layer (``materialize(…, kind="table")``), not a long plan."""
    x = whole_history_shift(aln, [f"{bp}_close", f"{rp}_close"], ts="ts_minute_utc", by=by)
    cols = [*by, "ts_minute_utc", "dt", f"{bp}_high", f"{bp}_low", f"{bp}_close", f"{bp}_volume",
            f"{rp}_high", f"{rp}_low", f"{rp}_close", f"{rp}_volume"]
    out = [F.col(c) for c in cols]
    for s in (bp, rp):
        out.append(F.coalesce(F.col(f"{s}_close_lag_1"), F.col(f"{s}_close_lag_1_calc"))
                   .alias(f"{s}_close_lag_1"))
        out.append(F.coalesce(F.col(f"{s}_close_lead_1"), F.col(f"{s}_close_lead_1_calc"))
                   .alias(f"{s}_close_lead_1"))
    if keep_calc:
        out += [(F.col(f"{bp}_high") - F.col(f"{bp}_low")).alias(f"{bp}_price_range_calc"),
                (F.col(f"{rp}_high") - F.col(f"{rp}_low")).alias(f"{rp}_price_range_calc")]
    return x.select(*out)


def daily_correlation(features: DataFrame, bp: str = "base", rp: str = "ref",
                      day: str = "execution_date", by: Sequence[str] = ()) -> DataFrame:
    """Per pair and day: rows with both returns, their correlation (NULL on zero
    variance), means and sample deviations; newest day first."""
    a, b = F.col(f"{bp}_return_1m"), F.col(f"{rp}_return_1m")
    rnd = lambda c: F.round(c, STATS_DIGITS)
    return (features.where(a.isNotNull() & b.isNotNull())
            .groupBy(*by, day)
            .agg(F.count(F.lit(1)).alias("record_count"),
                 rnd(safe_corr(a, b)).alias("correlation_1m"),
                 rnd(F.avg(a)).alias(f"avg_{bp}_return"),
                 rnd(F.avg(b)).alias(f"avg_{rp}_return"),
                 rnd(F.stddev_samp(a)).alias(f"stddev_{bp}_return"),
                 rnd(F.stddev_samp(b)).alias(f"stddev_{rp}_return"))
            .orderBy(F.col(day).desc()))


def materialize(df: DataFrame, name: str, kind: str = "view", path: str | None = None) -> DataFrame:
    """Expose a model under ``name``: a temporary view of its plan
    (``kind="view"``) or, for ``"table"``, its rows written as Parquet at
    ``path`` (shared storage) and a view over the written files, so later
    readers do not recompute the model and its lineage is cut."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        if path is None:
            from ..session import scratch_path
            path = scratch_path(spark, f"model-{name}")
        df.write.mode("overwrite").parquet(path)
        spark.read.parquet(path).createOrReplaceTempView(name)
    else:
        raise ValueError("kind must be 'view' or 'table'")
    return spark.table(name)


def build_models(features: DataFrame, out: str, bp: str = "base", rp: str = "ref",
                 by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Write the model chain below ``out``, each model from the stored one
    before it: ``staging``, ``aligned`` and ``enriched`` by ``dt``, and
    ``daily_correlation``. Returns the stored tables."""
    spark, root = features.sparkSession, out.rstrip("/")

    def stored(df, name):
        write_layer(df, f"{root}/{name}", "dt")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}").select(*df.columns)

    stg = stored(staging(features, bp, rp, by=by), "staging")
    aln = stored(aligned(stg, "non_null", rp), "aligned")
    enr = stored(enriched(aln, bp, rp, by=by), "enriched")
    daily_correlation(features, bp, rp, by=by).write.mode("overwrite").parquet(
        f"{root}/daily_correlation")
    return {"staging": stg, "aligned": aln, "enriched": enr,
            "daily_correlation": spark.read.parquet(f"{root}/daily_correlation")}


# The columns that the three models declare as never NULL.
DECLARED_NOT_NULL = {
    "staging": ("ts_minute_utc", "dt", "{b}_close"),
    "aligned": ("ts_minute_utc", "dt", "{b}_close", "{r}_close"),
    "enriched": ("ts_minute_utc", "dt", "{b}_close", "{r}_close"),
}


def check_models(models: Mapping[str, DataFrame], bp: str = "base", rp: str = "ref",
                 by: Sequence[str] = ()) -> DataFrame:
    """(model, rule, column_name, violations): the declared rules of each
    model, and that a pair's minute occurs once."""
    out = None
    for name, columns in DECLARED_NOT_NULL.items():
        rules = [not_null(c.format(b=bp, r=rp)) for c in columns]
        part = expectations(models[name], rules, unique_key=[*by, "dt", "ts_minute_utc"],
                            model=name)
        out = part if out is None else out.unionByName(part)
    return out


def register_views(features: DataFrame, bp: str = "base", rp: str = "ref",
                   enriched_kind: str = "view") -> dict[str, DataFrame]:
    """Expose the model chain for SQL users: ``staging_features``,
    ``aligned_mart``, ``aligned_market_open``, ``enriched_mart`` and
    ``daily_correlation`` as views of the feature table (``enriched_kind=
    "table"`` writes the enriched mart once, like a materialized model)."""
    stg = materialize(staging(features, bp, rp, keep_flag=True), "staging_features")
    plain = stg.drop(f"{rp}_market_open")
    views = {
        "staging_features": stg,
        "aligned_mart": materialize(aligned(plain, "non_null", rp), "aligned_mart"),
        "aligned_market_open": materialize(aligned(stg, "market_open", rp),
                                           "aligned_market_open"),
        "daily_correlation": materialize(daily_correlation(features, bp, rp),
                                         "daily_correlation"),
    }
    views["enriched_mart"] = materialize(enriched(views["aligned_mart"], bp, rp),
                                         "enriched_mart", kind=enriched_kind)
    return views
