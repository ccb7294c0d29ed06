"""Presence-driven column shaping in a single projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conform(df: DataFrame, *, renames: Mapping[str, str] | None = None,
            casts: Mapping[str, str] | None = None,
            defaults: Mapping[str, Column] | None = None,
            order: Sequence[str] | None = None,
            fill_missing: bool = False) -> DataFrame:
    """Rename, cast, default and order the columns that exist.

    * ``renames``: old -> new, ignored when the old column is absent;
    * ``casts``: column -> SQL type, applied with ``try_cast`` (bad text is
      NULL, never a failed job);
    * ``defaults``: column -> value, added only when the column is absent;
    * ``order``: final column order; absent names are skipped, or added as
      NULL when ``fill_missing`` (then the output schema is fixed).
    """
    renames = {k: v for k, v in (renames or {}).items() if k in df.columns}
    casts = casts or {}
    cols: dict[str, Column] = {}
    for name in df.columns:
        new = renames.get(name, name)
        c = F.col(name)
        if new in casts:
            c = c.try_cast(casts[new])
        cols[new] = c
    for name, value in (defaults or {}).items():
        if name not in cols:
            cols[name] = value
    if order is not None:
        picked = []
        for name in order:
            if name in cols:
                picked.append(cols[name].alias(name))
            elif fill_missing:
                t = casts.get(name, "string")
                picked.append(F.lit(None).cast(t).alias(name))
        return df.select(*picked)
    return df.select(*[c.alias(n) for n, c in cols.items()])


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Fail at plan time (no job) when a required column is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def lower_columns(df: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Lower-case all column names, then apply alias fallbacks
    (e.g. ``date`` -> ``datetime``) for names still absent."""
    low = df.toDF(*[c.lower() for c in df.columns])
    for alt, canonical in (aliases or {}).items():
        if canonical not in low.columns and alt in low.columns:
            low = low.withColumnRenamed(alt, canonical)
    return low


def with_audit(df: DataFrame, *, processed_col: str | None = "processed_at_utc",
               source_col: str | None = None, run_date: str | None = None,
               run_date_col: str = "execution_date") -> DataFrame:
    """Append audit columns: processing time (one value per query), the
    source file of each row (file-based frames only) and the run date."""
    cols = {}
    if processed_col:
        cols[processed_col] = F.current_timestamp()
    if source_col:
        cols[source_col] = F.col("_metadata.file_path")
    if run_date is not None:
        cols[run_date_col] = F.lit(run_date).cast("date")
    return df.withColumns(cols) if cols else df
