"""Guarded arithmetic (Spark 4 runs in ANSI mode: division by zero throws)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .time import col_of


def pct_change(cur, prev) -> Column:
    """(cur - prev) / prev * 100, NULL when prev is NULL or zero."""
    c, p = col_of(cur), col_of(prev)
    return F.when(p.isNotNull() & (p != 0), (c - p) / p * 100)


def pct_change_or_zero(cur, base) -> Column:
    """Same ratio but 0 when ``base`` is zero *or NULL* (candle change pct)."""
    c, b = col_of(cur), col_of(base)
    return F.when(b != 0, (c - b) / b * 100).otherwise(F.lit(0.0))


def safe_corr(a, b) -> Column:
    """Sample Pearson correlation that is NULL (not an error) on zero variance."""
    x, y = col_of(a), col_of(b)
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def nan_to_null_col(c) -> Column:
    x = col_of(c)
    return F.when(~F.isnan(x), x)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every float/double column, one projection."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(nan_to_null_col(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
