"""Sinks: day-partitioned Parquet layers, raw landing appends, JDBC with a
CSV fallback, and the processed-partition ledger.

Writers are distributed (no ``toPandas``): every task writes the days it
holds, sorted by time inside each file so Parquet min/max statistics prune
later reads. Re-running a write after a lost executor is safe: layers are
overwritten partition by partition (dynamic mode, set per write) and the
ledger is keyed, so a retried day replaces itself instead of duplicating.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

MAX_ARRAY_ROWS = 100_000  # rows of one JSON array file


def write_layer(df: DataFrame, base: str, partition_col: str = "dt",
                sort_col: str | None = "ts_minute_utc", mode: str = "overwrite",
                max_records_per_file: int | None = None) -> None:
    """Write ``df`` under ``base``, one folder per ``partition_col`` value.

    ``mode="overwrite"`` replaces only the partitions present in ``df``
    (dynamic partition overwrite, set on this write only; the session
    default ``static`` would delete every other day). A rebalance by day
    gathers each day's rows into few files and lets adaptive execution split
    a hot day over several tasks, so files do not multiply as tasks x days.
    """
    w = df.hint("rebalance", partition_col)
    if sort_col and sort_col in df.columns:
        w = w.sortWithinPartitions(partition_col, sort_col)
    writer = w.write.mode(mode).partitionBy(partition_col)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(base)


def append_raw(df: DataFrame, base: str, partition_col: str = "dt", fmt: str = "json") -> None:
    """Append landing records (one folder per day, never rewritten)."""
    df.write.mode("append").partitionBy(partition_col).format(fmt).save(base)


def write_text_lines(df: DataFrame, base: str, partition_col: str, extension: str,
                     mode: str = "overwrite") -> None:
    """Write ``value`` as text lines into files of the given extension, which
    readers select files by. Only the CSV writer names its files freely; JSON
    text holds no control character, so U+0001 never separates anything."""
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
       .options(extension=extension, sep="\u0001", quote="", header="false", escapeQuotes="false",
                ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
       .partitionBy(partition_col).csv(base))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table or partition folder that the caller has replaced."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def write_json_arrays(df: DataFrame, base: str, group_cols: Sequence[str],
                      partition_col: str = "dt", sort_col: str = "ts_minute_utc") -> None:
    """Land each group (e.g. one symbol-day pull) as one file holding a JSON
    array, the shape of an exchange REST response. Groups must be bounded
    (a pull or a day of one-minute candles): a group of more than
    ``MAX_ARRAY_ROWS`` rows fails the write; use JSON lines for such."""
    cols = [c for c in df.columns if c != partition_col]
    arr = (df.groupBy(*group_cols, partition_col)
             .agg(F.sort_array(F.collect_list(F.struct(F.col(sort_col).alias("_k"),
                                                       F.struct(*cols).alias("_v")))).alias("_a"))
             .withColumn("_a", F.when(F.size("_a") <= MAX_ARRAY_ROWS, F.col("_a")).otherwise(
                 F.raise_error(F.lit("group too large for one JSON array"))))
             .select(partition_col, F.to_json(F.col("_a._v")).alias("value")))
    write_text_lines(arr, base, partition_col, "json")


def write_json_lines(df: DataFrame, base: str, partition_col: str = "dt") -> None:
    """Land records as JSON lines files named ``*.jsonl``."""
    cols = [c for c in df.columns if c != partition_col]
    write_text_lines(df.select(partition_col, F.to_json(F.struct(*cols)).alias("value")), base,
                     partition_col, "jsonl")


# --- JDBC with fallback --------------------------------------------------------

JDBC_DEFAULTS = {"host": "localhost", "port": "5432", "database": "warehouse",
                 "user": "", "password": "", "table": "lead_lag_features"}


def jdbc_options(env: Mapping[str, str] | None = None, prefix: str = "WAREHOUSE_") -> dict:
    """JDBC URL and properties from ``<prefix>HOST/PORT/DB/USER/PASSWORD``."""
    env = dict(os.environ if env is None else env)
    g = lambda k, d: env.get(prefix + k, d)
    host, port = g("HOST", JDBC_DEFAULTS["host"]), g("PORT", JDBC_DEFAULTS["port"])
    db = g("DB", JDBC_DEFAULTS["database"])
    return {"url": f"jdbc:postgresql://{host}:{port}/{db}",
            "table": g("TABLE", JDBC_DEFAULTS["table"]),
            "properties": {"user": g("USER", ""), "password": g("PASSWORD", ""),
                           "driver": "org.postgresql.Driver"}}


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str],
               batchsize: int = 10000) -> None:
    """Append through JDBC, one connection per partition."""
    props = dict(properties)
    props.setdefault("batchsize", str(batchsize))
    df.write.jdbc(url=url, table=table, mode="append", properties=props)


def with_fallback(df: DataFrame, primary: Callable[[DataFrame], None],
                  fallback_path: str, partition_col: str | None = None,
                  ) -> tuple[str, Exception | None]:
    """Run ``primary(df)``; if it fails, write the rows as CSV (with header)
    to ``fallback_path``; with ``partition_col`` into a folder per value,
    replacing only the folders of the values in ``df``. Returns ``("primary", None)`` or ``("fallback", the
    error)``, and logs the error. A primary that is not atomic may have
    stored some rows before it failed; whoever loads the spill must upsert."""
    try:
        primary(df)
        return "primary", None
    except Exception as error:  # noqa: BLE001 - any sink failure triggers the spill
        log.warning("primary sink failed, rows go to %s: %s", fallback_path, error)
        w = df.write.mode("overwrite").option("header", True)
        if partition_col:
            w = w.partitionBy(partition_col).option("partitionOverwriteMode", "dynamic")
        w.csv(fallback_path)
        return "fallback", error


# --- processed-partition ledger -------------------------------------------------

LEDGER_SCHEMA = T.StructType([T.StructField("consumer", T.StringType()),
                              T.StructField("dt", T.DateType())])


def pending_partitions(parts: DataFrame, ledger: DataFrame, consumer: str,
                       day_col: str = "dt") -> DataFrame:
    """Partitions not yet processed by ``consumer`` (anti join on the day)."""
    done = ledger.where(F.col("consumer") == consumer).select(F.col("dt").alias(day_col))
    return parts.join(done, day_col, "left_anti")


def mark_done(ledger: DataFrame, parts: DataFrame, consumer: str, as_of: str,
              day_col: str = "dt") -> DataFrame:
    """Ledger after a successful run: processed partitions are added for
    ``consumer``, except ``as_of`` (the current day is still filling up and
    is processed again next run). Keyed, so re-marking is idempotent."""
    new = (parts.where(F.col(day_col) != F.lit(as_of).cast("date"))
                .select(F.lit(consumer).alias("consumer"), F.col(day_col).alias("dt")))
    return ledger.unionByName(new).distinct()
