"""Registered queries: the path-level jobs run twice, and shaping helpers."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import jobs, schemas
from ..operators import candles as cdl
from ..operators.conform import lower_columns, require_columns
from ..session import scratch_path
from ..sources import documents as docs
from ..sources import files, payloads, publish, sinks
from . import fixtures as fx
from . import oracle as o
from .q_io import BASE_RAW, DOC_SCHEMA, JSON_UNTIL, JSONL_UNTIL
from .registry import FEATURE_CTES, features, register

RUN_DAY = "2024-01-15"  # both document runs have this run day

DOC_SQL = """
SELECT {index} AS _index, {id} AS _id,
       strftime(ts_minute_utc, '%Y-%m-%dT%H:%M:%S') AS ts_minute_utc, base_close, ref_close
FROM features"""


def _export(spark, sf_dir, **options):
    """Two runs of the document job on one run day: the second finds days
    that the first had not, and the run day itself once more."""
    usage, out, ledger = (scratch_path(spark, n) for n in ("usage", "doc-out", "doc-ledger"))
    f = features(spark, sf_dir)
    day, run = F.col("execution_date"), F.lit(RUN_DAY).cast("date")
    sinks.write_layer(f.where(day <= run), usage, "execution_date")
    jobs.documents_job(spark, usage, out, ledger, as_of=RUN_DAY, **options)
    sinks.write_layer(f.where(day > run), usage, "execution_date")
    jobs.documents_job(spark, usage, out, ledger, as_of=RUN_DAY, **options)
    back = spark.read.schema(DOC_SCHEMA).json(out)
    return back.select("_index", "_id", "_source.ts_minute_utc", "_source.base_close",
                       "_source.ref_close")


@register("documents_rerun", o.with_(*FEATURE_CTES, o.features_sql()) + DOC_SQL.format(
    index="'features'", id="strftime(ts_minute_utc, '%Y-%m-%d %H:%M:%S')"), dates=())
def q_documents_rerun(spark, sf_dir):
    """A second run on the same run day replaces only what it exports."""
    return _export(spark, sf_dir)


@register("documents_by_row", o.with_(*FEATURE_CTES, o.features_sql()) + DOC_SQL.format(
    index="'features_' || strftime(execution_date, '%Y-%m-%d')",
    id="strftime(execution_date, '%Y-%m-%d') || '_' || (row_number() OVER ("
       "PARTITION BY execution_date ORDER BY ts_minute_utc) - 1)"), dates=())
def q_documents_by_row(spark, sf_dir):
    """Ids of day and row number, in one index per day."""
    return _export(spark, sf_dir, ids="row")


@register("documents_json_fallback", o.with_(*FEATURE_CTES, o.features_sql()) + """
SELECT strftime(ts_minute_utc, '%Y-%m-%dT%H:%M:%S') AS ts_minute_utc, base_close,
       CASE WHEN ref_market_open THEN ref_close END AS ref_close FROM features""", dates=())
def q_documents_json_fallback(spark, sf_dir):
    """Rows written as JSON objects where no search endpoint takes them; NaN
    (here: every carried price) is null."""
    f = features(spark, sf_dir).select("ts_minute_utc", "base_close", F.when(
        F.col("ref_market_open"), F.col("ref_close")).otherwise(F.lit(float("nan")))
        .alias("ref_close"))
    path = scratch_path(spark, "json-fallback")
    docs.export_json(f, path)
    return spark.read.schema("ts_minute_utc string, base_close double, ref_close double").json(path)


@register("models_job", o.with_(*FEATURE_CTES, o.features_sql()) + """
SELECT 'staging' AS model, count(*) AS n_rows, sum(CAST(base_volume AS BIGINT)) AS volume FROM features
UNION ALL SELECT 'aligned', count(*), sum(CAST(base_volume AS BIGINT)) FROM features
  WHERE ref_close IS NOT NULL
UNION ALL SELECT 'enriched', count(*), sum(CAST(base_volume AS BIGINT)) FROM features
  WHERE ref_close IS NOT NULL""", dates=())
def q_models_job(spark, sf_dir):
    """The model chain as a job, run twice over the same feature layer."""
    usage, out = scratch_path(spark, "models-usage"), scratch_path(spark, "models-out")
    sinks.write_layer(features(spark, sf_dir), usage, "execution_date")
    for _ in range(2):
        jobs.models_job(spark, usage, out)
    parts = [spark.read.parquet(f"{out}/{m}").agg(
        F.lit(m).alias("model"), F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("base_volume").cast("bigint")).alias("volume"))
        for m in ("staging", "aligned", "enriched")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("land_klines", o.with_(o.TICKS, BASE_RAW) + """
SELECT ts_minute_utc, symbol, open, close, volume, execution_date AS dt FROM base_c""",
          dates=("dt",))
def q_land_klines(spark, sf_dir):
    """Stored responses of one pull a day, landed and formatted."""
    stored, raw = scratch_path(spark, "kline-payloads"), scratch_path(spark, "kline-raw")
    c = fx.raw_base_records(fx.base_candles(spark, sf_dir, metrics=False))
    arr = F.array(*[F.col(f).cast("string") for f in payloads.KLINE_FIELDS])
    responses = c.groupBy("dt").agg(F.to_json(F.sort_array(F.collect_list(arr))).alias("value"))
    responses.write.partitionBy("dt").text(stored)
    jobs.land_klines_job(spark, stored, raw, "ALL", ingested_at="2024-02-01T00:00:00Z")
    f = cdl.format_base_series(spark.read.schema(schemas.RAW_BASE_CANDLE).json(raw), keep=["dt"])
    return f.select("ts_minute_utc", "symbol", "open", "close", "volume", "dt")


@register("land_quotes", o.with_(o.TICKS, o.REF) + """
SELECT ts_minute_utc, symbol, open, close, volume, execution_date AS dt FROM ref_c""",
          dates=("dt",))
def q_land_quotes(spark, sf_dir):
    """Two landings of quote responses: the second holds every minute of the
    first again with another close, and the minutes the first had not."""
    first, second, raw = (scratch_path(spark, n) for n in ("quotes-1", "quotes-2", "quotes-raw"))
    r = fx.raw_ref_records(fx.ref_candles(spark, sf_dir, metrics=False))
    early = F.minute(F.to_timestamp_ntz("ts_minute_utc", F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))) < 40
    item = F.struct(*[F.col(c) for c in payloads.QUOTE_FIELDS])
    revised = r.withColumn("close", F.when(early, (F.col("close").cast("double") + 1)
                                           .cast("string")).otherwise(F.col("close")))
    for path, rows in ((first, r.where(early)), (second, revised)):
        (rows.groupBy("dt").agg(F.to_json(F.struct(F.collect_list(item).alias("values")))
                                .alias("value")).write.partitionBy("dt").text(path))
        jobs.land_quotes_job(spark, path, raw, "REF", ingested_at="2024-02-01 00:00:00")
    f = cdl.format_ref_series(files.read_candles(spark, raw, "csv", schemas.RAW_REF_CANDLE),
                              dt=F.col("dt"))
    return f.select("ts_minute_utc", "symbol", "open", "close", "volume", "dt")


REJECTS_SQL = o.with_(o.TICKS, BASE_RAW) + f"""
SELECT execution_date AS dt, 'json' AS format,
       CASE WHEN day(execution_date) % 5 = 0 THEN 0 ELSE count(*) END AS records,
       CASE WHEN day(execution_date) % 5 = 0 THEN 1 ELSE 0 END AS rejects
FROM base_c WHERE execution_date <= DATE '{JSON_UNTIL}' GROUP BY execution_date
UNION ALL
SELECT execution_date,
       CASE WHEN execution_date <= DATE '{JSONL_UNTIL}' THEN 'jsonl' ELSE 'csv' END,
       count(*) FILTER (WHERE minute(ts_minute_utc) % 7 <> 0),
       count(*) FILTER (WHERE minute(ts_minute_utc) % 7 = 0)
FROM base_c WHERE execution_date > DATE '{JSON_UNTIL}' GROUP BY execution_date"""


@register("scan_rejects", REJECTS_SQL, dates=("dt",))
def q_scan_rejects(spark, sf_dir):
    """A landing tree with malformed records in three formats: JSON arrays cut
    short (the whole file is a reject), JSON lines cut short, and CSV values
    of another type. Records and rejects of each day are counted."""
    path = scratch_path(spark, "landing-rejects")
    raw, dt = fx.raw_base_records(fx.base_candles(spark, sf_dir, metrics=False)), F.col("dt")
    json_days = dt <= F.lit(JSON_UNTIL).cast("date")
    line_days = ~json_days & (dt <= F.lit(JSONL_UNTIL).cast("date"))
    broken_day = F.day("dt") % 5 == 0
    broken = F.substring("ts_minute_utc", 15, 2).cast("int") % 7 == 0
    line = F.to_json(F.struct(*[c for c in raw.columns if c != "dt"]))
    half = lambda c: F.substring(c, F.lit(1), (F.length(c) / 2).cast("int"))
    sinks.write_json_arrays(raw.where(json_days & ~broken_day), path, group_cols=["symbol"])
    sinks.write_text_lines(raw.where(json_days & broken_day).groupBy("dt").agg(F.concat(
        F.lit("["), F.array_join(F.sort_array(F.collect_list(line)), ",")).alias("value")),
        path, "dt", "json")
    sinks.write_text_lines(raw.where(line_days).select(
        "dt", F.when(broken, half(line)).otherwise(line).alias("value")), path, "dt", "jsonl")
    (raw.where(~json_days & ~line_days)
        .withColumn("open_time", F.when(broken, F.lit("n/a")).otherwise(F.col("open_time")
                                                                        .cast("string")))
        .write.mode("append").partitionBy("dt").option("header", True).csv(path))
    records, rejects = files.split_landed(spark, path)
    one, none = F.lit(1), F.lit(0)
    by_day = F.when(json_days, "json").when(line_days, "jsonl").otherwise("csv")
    return (records.select("dt", by_day.alias("format"), one.alias("a"), none.alias("b"))
            .unionByName(rejects.select("dt", "format", none.alias("a"), one.alias("b")))
            .groupBy("dt", "format").agg(F.sum("a").alias("records"), F.sum("b").alias("rejects")))


@register("format_changed_files", o.with_(o.TICKS, BASE_RAW) + """
SELECT symbol, ts_minute_utc, CASE day(execution_date) % 3 WHEN 0 THEN close + 0.5
       WHEN 1 THEN close + 1 ELSE close END AS close, execution_date AS dt
FROM base_c WHERE day(execution_date) % 10 <> 9""", dates=("dt",))
def q_format_changed_files(spark, sf_dir):
    """The formatted layer after two runs that look at files: between them
    some days got a further pull, some were landed anew, some were removed."""
    raw, out, manifest = (scratch_path(spark, n) for n in ("cf-raw", "cf-out", "cf-manifest"))
    c = fx.base_candles(spark, sf_dir, metrics=False)
    dom = F.day("dt")
    sinks.write_json_lines(fx.raw_base_records(c), raw)
    jobs.format_changed_job(spark, raw, out, manifest)
    up = lambda x: c.withColumn("close", F.col("close") + x)
    later = up(0.5).withColumn("ingested_at_utc",
                               F.timestamp_add("MINUTE", F.lit(5), F.col("ingested_at_utc")))
    again = fx.raw_base_records(later).where(dom % 3 == 0)
    sinks.write_text_lines(again.select("dt", F.to_json(F.struct(
        *[x for x in again.columns if x != "dt"])).alias("value")), raw, "dt", "jsonl", "append")
    sinks.write_json_lines(fx.raw_base_records(up(1.0)).where(dom % 3 == 1), raw)
    gone = c.select(F.col("execution_date").alias("dt")).distinct().where(dom % 10 == 9)
    for r in gone.collect():  # days, not rows
        sinks.remove_path(spark, f"{raw}/dt={r['dt']}")
    jobs.format_changed_job(spark, raw, out, manifest)
    return files.read_layer(spark, out, marked=True).select("symbol", "ts_minute_utc", "close",
                                                            "dt")


@register("layer_published", o.with_(*FEATURE_CTES, o.features_sql()) + """
SELECT ts_minute_utc, execution_date,
       CASE WHEN day(execution_date) % 2 = 0 THEN base_close + 1 ELSE base_close END AS base_close
FROM features WHERE day(execution_date) <> 7""")
def q_layer_published(spark, sf_dir):
    """A layer published twice: the second time with revised days and without
    a day that it replaces; marked days are read."""
    path, day = scratch_path(spark, "published"), "execution_date"
    f = features(spark, sf_dir).select("ts_minute_utc", day, "base_close")
    publish.publish_layer(f, path, day)
    days = publish.marked_days(spark, path, day)
    stored = files.read_layer(spark, path, day_col=day, marked=True)
    publish.publish_layer(stored.where(F.day(day) % 2 == 0)
                          .withColumn("base_close", F.col("base_close") + 1), path, day,
                          replaces=[d for d in days if d.endswith("-07")])
    return files.read_layer(spark, path, day_col=day, marked=True)


@register("locf_carry", o.with_(*FEATURE_CTES, o.features_sql(ref_name="sref", seed="last_known"))
          + "SELECT * FROM features")
def q_locf_carry(spark, sf_dir):
    """Last-known seeds from stored snapshots. The ref layer first lacks its
    later days and holds two days with other closes and volumes; then these
    are corrected, the rest lands, and the feature layer is built."""
    base, ref, out, state = (scratch_path(spark, n) for n in ("cb", "cr", "cf", "carry"))
    days = F.col("execution_date").alias("dt")
    b = fx.base_candles(spark, sf_dir)
    r = fx.scenario_ref(fx.ref_candles(spark, sf_dir))
    b, r = (c.select("*", days).drop("execution_date") for c in (b, r))
    wrong = F.day("dt").isin(5, 9)
    first = r.where(F.day("dt") <= 14).withColumns({
        "close": F.when(wrong, F.col("close") + 1).otherwise(F.col("close")),
        "volume": F.when(~wrong, F.col("volume"))})
    publish.publish_layer(b, base)
    publish.publish_layer(first, ref)
    jobs.carry_job(spark, ref, state)
    publish.publish_layer(r, ref)
    jobs.features_job(spark, base, ref, out, publish.marked_days(spark, base), seed="last_known",
                      state=state)
    return files.read_layer(spark, out, day_col="execution_date").drop("processed_at_utc")


@register("export_spill", o.with_(*FEATURE_CTES, o.features_sql()) + f"""
SELECT 'warehouse' AS place, ts_minute_utc, base_close, ref_close, execution_date
FROM features WHERE execution_date <> DATE '{RUN_DAY}'
UNION ALL
SELECT 'spill', ts_minute_utc, base_close, ref_close, execution_date
FROM features WHERE execution_date < DATE '{RUN_DAY}'""")
def q_export_spill(spark, sf_dir):
    """The warehouse export run three times: the first finds no warehouse and
    spills its days, the second stores them with the days landed since, the
    third has nothing to do. The run day waits."""
    usage, ledger, spill, kept, stored = (scratch_path(spark, n) for n in (
        "ex-usage", "ex-ledger", "ex-spill", "ex-kept", "ex-stored"))
    f = features(spark, sf_dir).select("ts_minute_utc", "base_close", "ref_close",
                                       "execution_date")
    day, run = F.col("execution_date"), F.lit(RUN_DAY).cast("date")
    sinks.write_layer(f.where(day <= run), usage, "execution_date")
    jobs.export_job(spark, usage, ledger, spill, RUN_DAY)  # no JDBC driver here
    spilled = T.StructType([*f.drop("execution_date").schema.fields,
                            T.StructField("source_file", T.StringType()),
                            T.StructField("loaded_at_utc", T.TimestampType()),
                            f.schema["execution_date"]])
    spark.read.schema(spilled).option("header", True).csv(spill).write.parquet(kept)
    sinks.write_layer(f.where(day > run), usage, "execution_date")
    for _ in range(2):
        jobs.export_job(spark, usage, ledger, spill, RUN_DAY,
                        sink=lambda rows: rows.write.mode("append").parquet(stored))
    return (spark.read.parquet(stored).select(F.lit("warehouse").alias("place"), *f.columns)
            .unionByName(spark.read.parquet(kept).select(F.lit("spill").alias("place"),
                                                         *f.columns)))


@register("required_columns", "SELECT n_nationkey, n_name FROM nation", dates=())
def q_required_columns(spark, sf_dir):
    """A frame that has the columns a job needs passes as it is."""
    n = fx.table(spark, sf_dir, "nation")
    return require_columns(n, ["n_nationkey", "n_name"]).select("n_nationkey", "n_name")


@register("lower_columns", """
SELECT c_custkey AS custkey, c_acctbal AS balance FROM customer""", dates=())
def q_lower_columns(spark, sf_dir):
    """Upper-case column names lowered, and an alias filled in."""
    c = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("CustKey"),
                                                   F.col("c_acctbal").alias("ACCTBAL"))
    return lower_columns(c, {"acctbal": "balance"})
