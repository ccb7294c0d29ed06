"""Rows as search documents: ``_id`` + JSON source, NaN as null, ISO times.

The documents are NDJSON text written by the executors; any bulk loader
(or a search engine's file ingest) reads them. The id is built from
columns chosen by the caller (default: the minute, as the reference
exporter does; add the day to avoid cross-day collisions).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import nan_to_null
from ..operators.dedup import dedup

JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ssXXX",
                "dateFormat": "yyyy-MM-dd", "ignoreNullFields": "false"}


def id_text(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType
    if isinstance(t, (T.TimestampNTZType, T.TimestampType)):
        return F.substring(F.col(c).cast("string"), 1, 19)
    return F.col(c).cast("string")


def number_rows(df: DataFrame, day: str, order: Sequence[str], name: str = "row_index",
                ) -> DataFrame:
    """Number each day's rows from 0 in ``order``: with the day, the id of a
    day's export (``<day>_<row_index>``). A window per day, which is bounded
    by the minutes of a day."""
    w = Window.partitionBy(day).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w) - 1)


def to_documents(df: DataFrame, id_cols: Sequence[str] = ("ts_minute_utc",),
                 keep_first_by: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """One document per id: ``_id`` and ``doc`` (JSON text of every column,
    NULLs written as null, NaN written as null, NTZ times ISO-8601).

    Rows sharing an id keep the first by ``keep_first_by``. ``keep`` names
    columns that stay beside the document (e.g. the day for partitioning).
    """
    clean = nan_to_null(df)
    ident = F.concat_ws("_", *[id_text(clean, c) for c in id_cols])
    x = clean.select(ident.alias("_id"), *clean.columns)
    x = dedup(x, ["_id"], list(keep_first_by), keep="first")
    return x.select("_id", F.to_json(F.struct(*df.columns), JSON_OPTIONS).alias("doc"), *keep)


def write_documents(docs: DataFrame, path: str, index: str | Column | None = None,
                    partition_col: str | None = None) -> None:
    """NDJSON, one ``{"_index", "_id", "_source"}`` object per line.

    ``index`` is one name or a column (e.g. a name per day). With
    ``partition_col`` (a column of ``docs``) each value has a folder of its
    own and a rerun replaces only the folders of the values it exports."""
    name = index if isinstance(index, Column) else F.lit(index).cast("string")
    head = F.to_json(F.struct(name.alias("_index"), F.col("_id")), {"ignoreNullFields": "false"})
    line = F.concat(F.regexp_replace(head, "}$", ""), F.lit(',"_source":'), F.col("doc"),
                    F.lit("}"))
    if partition_col is None:
        docs.select(line.alias("value")).write.mode("overwrite").text(path)
    else:
        (docs.select(partition_col, line.alias("value")).hint("rebalance", partition_col)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(partition_col).text(path))


def export_json(df: DataFrame, path: str, partition_col: str | None = None) -> None:
    """Fallback export when no search endpoint is reachable: the rows as
    JSON objects (NaN as null, ISO times), one file per task. With
    ``partition_col`` each value has a folder, and only the folders of the
    values in ``df`` are replaced."""
    w = nan_to_null(df).write.mode("overwrite").options(**JSON_OPTIONS)
    if partition_col:
        w = w.partitionBy(partition_col).option("partitionOverwriteMode", "dynamic")
    w.json(path)
