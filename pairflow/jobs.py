"""Pipeline jobs over storage paths: land stored payloads, format the two
landed series, build the feature layer, load it into a keyed table, build the
models, export documents. Each job runs any set of days as one Spark job (the
reference runs one day per process), and a day without input is an error.

    python -m pairflow.jobs land-klines --payloads P --out R --symbol S [--newest N]
    python -m pairflow.jobs land-quotes --payloads P --out R --symbol S [--newest N]
    python -m pairflow.jobs format-base --raw R --out O [--execution_date D ...]
                                        [--fmt auto] [--all_pulls]
    python -m pairflow.jobs format-ref  --raw R --out O [--execution_date D ...]
    python -m pairflow.jobs format-changed --raw R --out O --manifest M [--series base]
    python -m pairflow.jobs features    --base B --ref R --out O --execution_date D ...
                                        [--max_lag_minutes 5] [--seed previous_day] [--by C ...]
                                        [--carry S]
    python -m pairflow.jobs carry       --ref R --state S [--by C ...]
    python -m pairflow.jobs load        --usage U --table T --ledger L --as_of D
    python -m pairflow.jobs export      --usage U --ledger L --spill P --as_of D
    python -m pairflow.jobs models      --usage U --out M [--by C ...]
    python -m pairflow.jobs documents   --usage U --out O --ledger L --as_of D [--index I]

The format and feature layers are published day by day with a success marker
(``sources.publish``), and records that do not parse go to ``<out>_rejects``.
Progress and row counts come from ``observe`` metrics on the write itself,
so no job runs a plan twice. State (which day partitions a consumer has
loaded) lives in a ledger table next to the data; a day is recorded only
after its whole write succeeded, and never for the ``as_of`` day, which is
reloaded on the next run.
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas
from .functions.time import floor_minute
from .operators.candles import format_base_series, format_ref_series
from .operators.pairing import lead_lag_features, side_columns
from .operators.reports import last_n, observed
from .operators.upsert import merge_append, upsert_table
from .plans import models
from .session import scratch_path
from .sources import carry
from .sources import documents as docs
from .sources import payloads
from .sources import manifest as mf
from .sources.files import (FORMAT_PRECEDENCE, landed_formats, partitions_of, path_exists,
                            read_candles, read_layer, split_landed)
from .sources.publish import day_folder, publish_layer
from .sources.sinks import (LEDGER_SCHEMA, append_raw, jdbc_options, mark_done,
                            pending_partitions, remove_path, with_fallback, write_jdbc)

log = logging.getLogger(__name__)

FEATURE_KEY = ["ts_minute_utc", "execution_date"]
EMPTY_REF = T.StructType([T.StructField("dt", T.DateType()),
                          T.StructField("ts_minute_utc", T.TimestampNTZType()),
                          *[T.StructField(c, T.DoubleType())
                            for c in ("open", "high", "low", "close", "volume")]])


def _responses(spark: SparkSession, path: str) -> DataFrame:
    """Text files holding one response each, with the file as ``_pull``."""
    return (spark.read.option("wholetext", True).text(path)
            .select("value", F.col("_metadata.file_path").alias("_pull")))


def land_klines_job(spark: SparkSession, payload_path: str, out: str, symbol: str,
                    interval: str = "1m", ingested_at: str | None = None,
                    newest: int | None = None) -> None:
    """Stored kline responses (text files holding one response each) appended
    to the landing area as records under ``dt=`` of their minute; with
    ``newest`` only that many latest klines of each response."""
    text = _responses(spark, payload_path)
    now = F.lit(ingested_at) if ingested_at else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = payloads.explode_klines(text.withColumn("at", now), "value", symbol, interval, "at",
                                   keep=["_pull"])
    rows = (last_n(rows, newest, ["_pull"], "open_time") if newest else rows).drop("_pull")
    append_raw(rows.withColumn("dt", F.substring("ts_minute_utc", 1, 10).cast("date")), out)


def land_quotes_job(spark: SparkSession, payload_path: str, out: str, symbol: str,
                    source: str = "api", interval: str = "1m",
                    ingested_at: str | None = None, newest: int | None = None) -> dict[str, int]:
    """Stored quote responses merged into the day files of the landing area:
    a minute that is already landed stays as it is, new minutes are added.
    With ``newest`` only that many latest quotes of each response land.
    Returns the number of ``responses`` without quotes and of ``quotes``
    without a readable time, which have no day to land in."""
    text = _responses(spark, payload_path)
    at = F.lit(ingested_at).cast("timestamp_ntz") if ingested_at else \
        F.current_timestamp().cast("timestamp_ntz")
    q = payloads.explode_quotes(text, "value", symbol, source, keep=["_pull"], fetched_at=at)
    unread = q.where("datetime IS NULL").count()
    q = q.where("datetime IS NOT NULL")
    if newest:
        q = last_n(q, newest, ["_pull"], "datetime")
    minute = payloads.iso_minute_text(floor_minute("datetime"))
    rows = q.select(
        F.col("datetime").cast("string").alias("datetime"),
        *[F.col(c).cast("string").alias(c) for c in ("open", "high", "low", "close", "volume")],
        minute.alias("ts_minute_utc"), "symbol", "source",
        payloads.iso_minute_text(F.col("fetched_at")).alias("ingested_at_utc"),
        F.lit(interval).alias("interval"), F.col("datetime").cast("date").alias("dt"))
    if path_exists(spark, out):
        have = read_candles(spark, out, "csv", schemas.RAW_REF_CANDLE)
        rows = merge_append(have.join(rows.select("dt").distinct(), "dt", "left_semi"), rows,
                            ["dt", "symbol", "ts_minute_utc"], keep="existing")
    stage = scratch_path(spark, "quotes")  # the rewrite must not read what it replaces
    rows.write.parquet(stage)
    (spark.read.schema(rows.schema).parquet(stage).hint("rebalance", "dt")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("header", True).partitionBy("dt").csv(out))
    remove_path(spark, stage)
    return {"responses": payloads.rejected_quotes(text, "value").count(), "quotes": unread}


def _in_days(df: DataFrame, col: str, days: Sequence[str] | None) -> DataFrame:
    if not days:
        return df
    return df.where(F.col(col).isin([F.lit(d).cast("date") for d in days]))


def _format(spark: SparkSession, raw: str, out: str, days: Sequence[str] | None, fmt: str,
            schema: T.StructType, form, name: str) -> dict:
    """Split landed records, publish the formed layer and, at ``<out>_rejects``,
    the rejects. The formed days are replaced in both, also those that hold no
    row now. Returns the metrics of the layer's write and the rejects' number."""
    df, rejects = split_landed(spark, raw, fmt, schema, days)
    formed = days or [d for d in landed_formats(
        spark, raw, FORMAT_PRECEDENCE if fmt == "auto" else (fmt,)) if d]
    f, obs = observed(form(df), name)
    publish_layer(f, out, "dt", replaces=formed)
    publish_layer(rejects, f"{out.rstrip('/')}_rejects", "dt", replaces=formed)
    try:
        metrics = obs.get
    except Py4JJavaError:  # adaptive execution drops the metrics of a plan without rows
        metrics = {"rows": 0}
    return {**metrics, "rejects": rejects.count()}


def format_base_job(spark: SparkSession, raw: str, out: str, days: Sequence[str] | None = None,
                    fmt: str = "auto", dedup_pulls: bool = True) -> dict:
    """Landed 24/7 candles (``dt=`` folders) -> formatted layer by ``dt``."""
    return _format(spark, raw, out, days, fmt, schemas.RAW_BASE_CANDLE,
                   lambda df: format_base_series(df, dedup_pulls=dedup_pulls, audit=True,
                                                 keep=["dt"]), "format-base")


def format_ref_job(spark: SparkSession, raw: str, out: str,
                   days: Sequence[str] | None = None) -> dict:
    """Landed market-hours CSV (``dt=`` folders) -> formatted layer by ``dt``
    (the landing day, which is the run day, as the partition)."""
    return _format(spark, raw, out, days, "csv", schemas.RAW_REF_CANDLE,
                   lambda df: format_ref_series(df, dt=F.col("dt"), audit=True), "format-ref")


def format_changed_job(spark: SparkSession, raw: str, out: str, manifest: str,
                       series: str = "base") -> list[str]:
    """Form again exactly the days whose files were added, replaced or deleted
    since the last run, and record the files. A day whose last file went
    leaves the layer. Files that land during the run are new to the next one.
    Returns the days."""
    now = mf.current_files(spark, raw)
    changes = mf.changed_days(mf.file_changes(mf.read_manifest(spark, manifest), now))
    days = [str(r["dt"]) for r in changes.where("dt IS NOT NULL").orderBy("dt").collect()]
    if not days:
        return days
    kept = {str(r["dt"]) for r in now.select("dt").distinct().collect()}
    here = [d for d in days if d in kept]
    if here:
        (format_base_job if series == "base" else format_ref_job)(spark, raw, out, here)
    for day in sorted(set(days) - kept):
        for layer in (out, f"{out.rstrip('/')}_rejects"):
            remove_path(spark, f"{layer.rstrip('/')}/{day_folder(spark, 'dt', day)}")
    mf.store_manifest(now, manifest)
    return days


def _previous_days(days: Sequence[str]) -> list[str]:
    return [(dt.date.fromisoformat(d) - dt.timedelta(days=1)).isoformat() for d in days]


def carry_job(spark: SparkSession, ref: str, state: str, by: Sequence[str] = ()) -> list[str]:
    """Bring the last-known snapshots at ``state`` up to date with the
    formatted layer ``ref``: of the days whose files were added, replaced or
    deleted since the last run, the candles are read; other days enter by
    their stored values. Returns the days whose snapshot changed. ``by`` stays
    the same over the life of a state."""
    seen = f"{state.rstrip('/')}_files"
    now = mf.current_files(spark, ref)
    changes = mf.changed_days(mf.file_changes(mf.read_manifest(spark, seen), now))
    days = [str(r["dt"]) for r in changes.where("dt IS NOT NULL").collect()]
    if not days:
        return days
    changed = carry.update_carry(read_layer(spark, ref), state, days, by=by)
    mf.store_manifest(now, seen)
    return changed


def features_job(spark: SparkSession, base: str, ref: str, out: str, days: Sequence[str],
                 max_lag: int = 5, seed: str = "previous_day", by: Sequence[str] = (),
                 state: str | None = None) -> dict:
    """Formatted layers -> feature layer by ``execution_date`` for ``days``.

    Only the needed partitions are read: the days themselves, plus the day
    before for the previous-day seed, or every earlier day for
    ``last_known``; with the snapshots at ``state`` (``carry_job`` brings them
    up to date first) ``last_known`` reads the days themselves and the snapshot
    before each. Missing ref days are not an error (the market may be
    closed); a day without base rows is. ``by`` names the pair keys of layers
    that hold several pairs."""
    b = read_layer(spark, base, days).withColumnRenamed("dt", "execution_date")
    seeds = None
    if not path_exists(spark, ref):
        r = spark.createDataFrame([], T.StructType([*EMPTY_REF.fields,
                                                    *[b.schema[c] for c in by]]))
    elif seed == "last_known" and state:
        carry_job(spark, ref, state, by)
        r = _in_days(read_layer(spark, ref), "dt", days)
        seeds = carry.carried_seeds(spark, state, days, side_columns("ref", False), r.schema, by=by)
    elif seed == "last_known":
        r = read_layer(spark, ref).where(F.col("dt") <= F.lit(max(days)).cast("date"))
    else:
        r = _in_days(read_layer(spark, ref), "dt", sorted(set(days) | set(_previous_days(days))))
    r = r.withColumnRenamed("dt", "execution_date")
    f = lead_lag_features(b, r, max_lag=max_lag, seed=seed, audit=True, by=by, seeds=seeds)
    f, obs = observed(_in_days(f, "execution_date", days), "features")
    publish_layer(f, out, "execution_date")
    return obs.get


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    return spark.createDataFrame([], LEDGER_SCHEMA)


def _pending(spark: SparkSession, usage: str, ledger: str, consumer: str) -> DataFrame:
    parts = partitions_of(spark, usage, "execution_date").withColumnRenamed("execution_date", "dt")
    return pending_partitions(parts, _ledger(spark, ledger), consumer)


def load_job(spark: SparkSession, usage: str, table: str, ledger: str, as_of: str,
             consumer: str = "warehouse", by: Sequence[str] = ()) -> None:
    """Upsert every day partition not yet loaded into the keyed table
    (key: pair, minute and day), then record the days except ``as_of``."""
    pending = _pending(spark, usage, ledger, consumer)
    batch = (spark.read.parquet(usage)
             .withColumn("source_file", F.col("_metadata.file_path"))
             .join(pending.withColumnRenamed("dt", "execution_date"), "execution_date", "left_semi")
             .withColumn("loaded_at_utc", F.current_timestamp()))
    upsert_table(spark, table, batch, [*by, *FEATURE_KEY], "execution_date",
                 order=["processed_at_utc"] if "processed_at_utc" in batch.columns else ())
    done = mark_done(spark.createDataFrame([], LEDGER_SCHEMA), pending, consumer, as_of)
    done.write.mode("append").parquet(ledger)


def export_job(spark: SparkSession, usage: str, ledger: str, spill: str, as_of: str,
               sink: Callable[[DataFrame], None] | None = None,
               consumer: str = "export") -> tuple[str, list[str]]:
    """Append the day partitions that are not exported yet to the warehouse
    through ``sink`` (default: JDBC as ``sinks.jdbc_options`` finds it), with
    the audit columns, in one job. The ``as_of`` day waits until it is over,
    as appended rows cannot be replaced.

    If the sink fails, the rows go to ``spill`` as CSV, a folder per day that
    a later spill of the day replaces, and their days stay pending: the next
    run tries them again and, once stored, removes their spill. Returns
    ("primary", "fallback" or "nothing") and the days."""
    day = "execution_date"
    pending = _pending(spark, usage, ledger, consumer).where(
        F.col("dt") != F.lit(as_of).cast("date"))
    days = sorted(str(r["dt"]) for r in pending.collect())  # days, not rows
    if not days:
        return "nothing", days
    batch = (_in_days(spark.read.parquet(usage)
                      .withColumn("source_file", F.col("_metadata.file_path")), day, days)
             .withColumn("loaded_at_utc", F.current_timestamp()))
    if sink is None:
        opts = jdbc_options()

        def sink(rows):
            write_jdbc(rows, opts["url"], opts["table"], opts["properties"])
    how, _ = with_fallback(batch, sink, spill, partition_col=day)
    if how == "primary":
        done = spark.createDataFrame([(consumer, dt.date.fromisoformat(d)) for d in days],
                                     LEDGER_SCHEMA)
        done.write.mode("append").parquet(ledger)
        for d in days:
            remove_path(spark, f"{spill.rstrip('/')}/{day_folder(spark, day, d)}")
    return how, days


def documents_job(spark: SparkSession, usage: str, out: str, ledger: str, as_of: str,
                  index: str = "features", consumer: str = "documents",
                  by: Sequence[str] = (), ids: str = "minute",
                  load: Callable[[str], None] | None = None,
                  fallback: str | None = None) -> bool:
    """Export pending day partitions as NDJSON documents, one folder per day,
    then record the days except ``as_of``. A rerun replaces the folders of the
    days it exports and no others.

    ``ids="minute"`` names a document by its pair and minute; ``"row"`` by the
    day and the row's number in it (``<day>_<n>``), in an index named
    ``<index>_<day>``.

    ``load`` hands the written folder to a search service. If it fails and a
    ``fallback`` is named, the rows are written there as JSON objects, one
    folder per day, and the days stay pending; without a fallback the error is
    raised. Returns whether the documents went through."""
    pending = _pending(spark, usage, ledger, consumer)
    day = "execution_date"
    batch = spark.read.parquet(usage).join(pending.withColumnRenamed("dt", day), day, "left_semi")
    name = index
    if ids == "row":
        batch = docs.number_rows(batch, day, [*by, "ts_minute_utc"])
        name = F.concat(F.lit(f"{index}_"), F.col(day).cast("string"))
        d = docs.to_documents(batch, [day, "row_index"], keep=[day])
    elif ids == "minute":
        d = docs.to_documents(batch, [*by, "ts_minute_utc"], keep_first_by=[day], keep=[day])
    else:
        raise ValueError("ids must be 'minute' or 'row'")
    docs.write_documents(d, out, index=name, partition_col=day)
    if load is not None:
        try:
            load(out)
        except Exception as error:  # noqa: BLE001 - any failure of the service
            if fallback is None:
                raise
            log.warning("documents not loaded, rows go to %s: %s", fallback, error)
            docs.export_json(batch, fallback, partition_col=day)
            return False
    done = mark_done(spark.createDataFrame([], LEDGER_SCHEMA), pending, consumer, as_of)
    done.write.mode("append").parquet(ledger)
    return True


def models_job(spark: SparkSession, usage: str, out: str, by: Sequence[str] = (),
               prefixes: tuple[str, str] = ("base", "ref")) -> dict[str, int]:
    """Feature layer -> stored models (staging, aligned, enriched, daily
    correlation) below ``out``, then their declared rules; a violated rule
    raises. Returns the rows of each model."""
    bp, rp = prefixes
    built = models.build_models(spark.read.parquet(usage), out, bp, rp, by)
    bad = models.check_models(built, bp, rp, by).where("violations > 0").collect()  # few rules
    if bad:
        raise ValueError("model rules violated: " + "; ".join(
            f"{r['model']} {r['rule']} {r['column_name']}: {r['violations']}" for r in bad))
    return {name: df.count() for name, df in built.items()}


def main(argv: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="pairflow.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("format-base", "format-ref"):
        s = sub.add_parser(name)
        s.add_argument("--raw", required=True)
        s.add_argument("--out", required=True)
        s.add_argument("--execution_date", nargs="*")
        if name == "format-base":
            s.add_argument("--fmt", default="auto", choices=["auto", "json", "jsonl", "csv"])
            s.add_argument("--all_pulls", action="store_true")
    s = sub.add_parser("format-changed")
    for a in ("--raw", "--out", "--manifest"):
        s.add_argument(a, required=True)
    s.add_argument("--series", default="base", choices=["base", "ref"])
    s = sub.add_parser("features")
    for a in ("--base", "--ref", "--out"):
        s.add_argument(a, required=True)
    s.add_argument("--execution_date", nargs="+", required=True)
    s.add_argument("--max_lag_minutes", type=int, default=5)
    s.add_argument("--seed", default="previous_day",
                   choices=["previous_day", "last_known", "none"])
    s.add_argument("--by", nargs="*", default=[])
    s.add_argument("--carry", help="last-known snapshots, with --seed last_known")
    s = sub.add_parser("carry")
    s.add_argument("--ref", required=True)
    s.add_argument("--state", required=True)
    s.add_argument("--by", nargs="*", default=[])
    for name in ("land-klines", "land-quotes"):
        s = sub.add_parser(name)
        s.add_argument("--payloads", required=True)
        s.add_argument("--out", required=True)
        s.add_argument("--symbol", required=True)
        s.add_argument("--newest", type=int)
    s = sub.add_parser("models")
    s.add_argument("--usage", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--by", nargs="*", default=[])
    for name in ("load", "documents", "export"):
        s = sub.add_parser(name)
        s.add_argument("--usage", required=True)
        s.add_argument("--ledger", required=True)
        s.add_argument("--as_of", default=dt.datetime.now(dt.timezone.utc).date().isoformat())
        if name == "export":
            s.add_argument("--spill", required=True)
            continue
        s.add_argument("--by", nargs="*", default=[])
        if name == "load":
            s.add_argument("--table", required=True)
        else:
            s.add_argument("--out", required=True)
            s.add_argument("--index", default="features")
            s.add_argument("--ids", default="minute", choices=["minute", "row"])
    a = p.parse_args(argv)
    from .session import get_session
    spark = get_session(app=f"pairflow-{a.job}")
    if a.job == "format-base":
        format_base_job(spark, a.raw, a.out, a.execution_date, a.fmt, not a.all_pulls)
    elif a.job == "format-changed":
        format_changed_job(spark, a.raw, a.out, a.manifest, a.series)
    elif a.job == "format-ref":
        format_ref_job(spark, a.raw, a.out, a.execution_date)
    elif a.job == "features":
        features_job(spark, a.base, a.ref, a.out, a.execution_date, a.max_lag_minutes, a.seed,
                     a.by, a.carry)
    elif a.job == "carry":
        carry_job(spark, a.ref, a.state, a.by)
    elif a.job == "export":
        export_job(spark, a.usage, a.ledger, a.spill, a.as_of)
    elif a.job == "land-klines":
        land_klines_job(spark, a.payloads, a.out, a.symbol, newest=a.newest)
    elif a.job == "land-quotes":
        land_quotes_job(spark, a.payloads, a.out, a.symbol, newest=a.newest)
    elif a.job == "models":
        models_job(spark, a.usage, a.out, a.by)
    elif a.job == "load":
        load_job(spark, a.usage, a.table, a.ledger, a.as_of, by=a.by)
    else:
        documents_job(spark, a.usage, a.out, a.ledger, a.as_of, a.index, by=a.by, ids=a.ids)


if __name__ == "__main__":
    main()
