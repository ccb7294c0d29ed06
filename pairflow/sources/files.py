"""File sources: landing files (JSON arrays, JSON lines, CSV), typed
Parquet layers partitioned by day, and mixed-format folders.

Every reader takes an explicit schema, so no inference job runs. Format
detection reads file *names* through Spark's file index (any scheme the
cluster supports), day by day, and opens no file for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..session import scratch_path
from .publish import finish_publish, marked_days

FORMAT_PRECEDENCE = ("json", "jsonl", "csv")


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _landed(spark: SparkSession, path: str, fmt: str, schema: T.StructType,
            rejects: str | None = None) -> DataFrame:
    """Landed files of one format; ``rejects`` names a text column that holds
    the raw text of a record that does not fit the schema."""
    r = spark.read.schema(T.StructType([*schema.fields, T.StructField(rejects, T.StringType())])
                          if rejects else schema).option("pathGlobFilter", f"*.{fmt}")
    if rejects:
        r = r.option("columnNameOfCorruptRecord", rejects)
    if fmt == "json":
        return r.option("multiLine", True).json(path)
    if fmt == "jsonl":
        return r.json(path)
    return r.option("header", True).csv(path)


def landed_formats(spark: SparkSession, path: str,
                   precedence: Sequence[str] = FORMAT_PRECEDENCE,
                   day_col: str = "dt") -> dict[str, str]:
    """The format of each landed day: the first of ``precedence`` that has a
    file in the day's ``dt=`` folder ("" stands for files outside any).

    The file names come from Spark's own file index, which lists folders in
    parallel; a row per day and format reaches the driver, no file is opened.
    """
    names = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
             .select(F.regexp_extract("path", rf"/{day_col}=([^/]+)/", 1).alias("day"),
                     F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("fmt"))
             .where(F.col("fmt").isin(list(precedence))).distinct().collect())
    best: dict[str, str] = {}
    for r in names:
        have = best.get(r["day"])
        if have is None or precedence.index(r["fmt"]) < precedence.index(have):
            best[r["day"]] = r["fmt"]
    return best


def read_candles(spark: SparkSession, path: str, fmt: str = "auto",
                 schema: T.StructType = schemas.RAW_BASE_CANDLE,
                 days: Sequence[str] | None = None, day_col: str = "dt",
                 rejects: str | None = None) -> DataFrame:
    """Read landed candles: ``json`` (files holding one JSON array),
    ``jsonl`` (one object per line), ``csv`` (with header) or ``auto``.

    ``auto`` settles the format of each ``dt=`` folder by itself (json >
    jsonl > csv by the files present) and unions the days. Day folders become
    a ``dt`` column by partition discovery. Every day of ``days`` must have
    input of the format: missing days raise, as does an empty tree.

    ``rejects`` adds a column with the raw text of a malformed record, and
    ``_file`` and ``_format`` say where a record is from (``split_landed``)."""
    if fmt != "auto" and fmt not in FORMAT_PRECEDENCE:
        raise ValueError(f"unknown format {fmt}")
    wanted = FORMAT_PRECEDENCE if fmt == "auto" else (fmt,)
    best = landed_formats(spark, path, wanted, day_col) if path_exists(spark, path) else {}
    if not best:
        raise FileNotFoundError(f"no raw input under {path}; expected one of "
                                + ", ".join(f"{path}/**/*.{e}" for e in wanted))
    missing = sorted(set(map(str, days or ())) - set(best))
    if missing:
        raise FileNotFoundError(f"no raw input under {path} for {', '.join(missing)}")
    out = None
    for f in dict.fromkeys(best[d] for d in sorted(best)):
        part = _landed(spark, path, f, schema, rejects)
        if rejects:
            part = part.select("*", F.col("_metadata.file_path").alias("_file"),
                               F.lit(f).alias("_format"))
        if day_col in part.columns:
            own = [d for d in best if best[d] == f and (days is None or d in days)]
            if not own:
                continue
            part = part.where(F.col(day_col).isin([F.lit(d).cast("date") for d in own]))
        out = part if out is None else out.unionByName(part)
    return out


def split_landed(spark: SparkSession, path: str, fmt: str = "auto",
                 schema: T.StructType = schemas.RAW_BASE_CANDLE,
                 days: Sequence[str] | None = None,
                 day_col: str = "dt") -> tuple[DataFrame, DataFrame]:
    """Landed candles as (records, rejects). A reject is a record that is not
    of its format or does not fit the schema: a broken JSON line, a value of
    another type, a CSV line with too few or too many fields, or a whole file
    that is no JSON array. It comes as (day, format, file, record) with its
    raw text, and is in no other row.

    Records are parsed once, with every column, and stored in scratch, from
    which both frames read. Parsing lazily, a reader judges a record by the
    columns that a query happens to use, and the two frames could differ."""
    raw = "_reject"
    path_ = scratch_path(spark, "landed")
    landed = read_candles(spark, path, fmt, schema, days, day_col, rejects=raw)
    landed.write.parquet(path_)
    stored = spark.read.schema(landed.schema).parquet(path_)
    kept = [c for c in landed.columns if c not in (raw, "_file", "_format")]
    day = [day_col] if day_col in kept else []
    return (stored.where(F.col(raw).isNull()).select(*kept),
            stored.where(F.col(raw).isNotNull()).select(
                *day, F.col("_format").alias("format"), F.col("_file").alias("file"),
                F.col(raw).alias("record")))


def read_layer(spark: SparkSession, base: str, days: Sequence[str] | None = None,
               day_col: str = "dt", schema: T.StructType | None = None,
               required: bool = True, marked: bool = False) -> DataFrame:
    """A Parquet layer partitioned by ``day_col``; ``days`` prunes partitions
    (the filter reaches the file index as a PartitionFilter).

    A missing optional layer (``required=False``) is an empty frame of
    ``schema``; a missing required one raises, and so does a required day
    without a partition.
    """
    if not path_exists(spark, base):
        if required or schema is None:
            raise FileNotFoundError(f"layer not found: {base}")
        return spark.createDataFrame([], schema)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(base)
    if marked:
        df = df.where(F.col(day_col).isin([F.lit(d).cast(df.schema[day_col].dataType)
                                           for d in marked_days(spark, base, day_col)]))
    if days is not None:
        asked = F.col(day_col).isin([F.lit(d).cast("date") for d in days])
        if required:
            have = {str(r[0]) for r in df.where(asked).select(day_col).distinct().collect()}
            missing = sorted(set(map(str, days)) - have)
            if missing:
                raise FileNotFoundError(f"layer {base} has no day {', '.join(missing)}")
        df = df.where(asked)
    return df


def read_any(spark: SparkSession, path: str, schema: T.StructType,
             formats: Sequence[str] = ("parquet", "csv", "json")) -> DataFrame:
    """All files under ``path`` whose extension is a known format, read with
    that format and one schema, unioned by name; other files are ignored.

    No driver-side listing: each format's reader selects its files with a
    glob filter (Spark's file index lists the folder, in parallel for many
    sub-folders), and a format without files reads as empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    out = None
    for fmt in formats:
        r = spark.read.schema(schema).option("pathGlobFilter", f"*.{fmt}")
        if fmt == "csv":
            r = r.option("header", True)
        part = r.format(fmt).load(path)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


DT_PATTERN = r"dt=(\d{4}-\d{2}-\d{2})"


def with_partition_date(df: DataFrame, col: str = "dt") -> DataFrame:
    """Add ``col`` from the ``dt=YYYY-MM-DD`` folder of each row's file when
    the frame has no such column (file readers only)."""
    if col in df.columns:
        return df
    return df.withColumn(col, F.regexp_extract(F.col("_metadata.file_path"), DT_PATTERN, 1)
                         .try_cast("date"))


def partitions_of(spark: SparkSession, base: str, day_col: str = "dt") -> DataFrame:
    """Distinct day partitions of a layer (only the partition column is
    read, so no data column of any file is scanned)."""
    return spark.read.parquet(base).select(day_col).distinct()
