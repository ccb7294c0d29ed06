"""Window operators: lag/lead banks, LOCF, and whole-history shifts.

Every window here is partitioned. Row-offset windows over *all* history
(the enriched mart) are computed segment-wise: inside each day bucket with a
partitioned window, and across bucket edges through a table holding one row
per bucket (the only un-partitioned window, whose size is the number of
calendar days, not the number of rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lag_lead_columns(cols: Sequence[str], w: Window, max_lag: int, *,
                     lags: bool = True, leads: bool = True,
                     lag_fmt: str = "{c}_lag_{k}",
                     lead_fmt: str = "{c}_lead_{k}") -> list[Column]:
    """lag/lead 1..max_lag of each column over one window spec.

    All columns share the spec, so Catalyst evaluates them in one Window
    operator over one sort.
    """
    out = []
    for k in range(1, max_lag + 1):
        for c in cols:
            if lags:
                out.append(F.lag(c, k).over(w).alias(lag_fmt.format(c=c, k=k)))
            if leads:
                out.append(F.lead(c, k).over(w).alias(lead_fmt.format(c=c, k=k)))
    return out


def _require_partition(by: Sequence[str]) -> None:
    if not by:
        raise ValueError("row-offset windows need partition keys (e.g. series and day); "
                         "use whole_history_shift for ordering across all rows")


def locf(df: DataFrame, cols: Sequence[str], *, order: str, by: Sequence[str],
         seeds: dict[str, Column] | None = None) -> DataFrame:
    """Last observation carried forward inside each ``by`` partition.

    ``seeds`` maps a column to a value used before the first observation of
    the partition (e.g. the previous day's last value).
    """
    _require_partition(by)
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding,
                                                           Window.currentRow)
    seeds = seeds or {}
    filled = {}
    for c in cols:
        x = F.last(c, ignorenulls=True).over(w)
        filled[c] = F.coalesce(x, seeds[c]) if c in seeds else x
    return df.withColumns(filled)


def whole_history_shift(df: DataFrame, cols: Sequence[str], *, ts: str,
                        by: Sequence[str] = (), bucket: Column | None = None,
                        lag_fmt: str = "{c}_lag_1_calc",
                        lead_fmt: str = "{c}_lead_1_calc") -> DataFrame:
    """``lag(c,1)``/``lead(c,1) over (partition by by order by ts)`` over the
    whole history without a single-partition window. ``ts`` must be
    unique within ``by``.

    1. Inside each bucket (default: calendar day of ``ts``; any bucket
       monotone in ``ts`` works) a partitioned window gives the in-bucket
       neighbours, wrapped in a struct so that "neighbour with NULL value"
       differs from "no neighbour".
    2. Each bucket contributes its first and last row to an edge table (one
       row per bucket); a window over that small table gives the previous
       bucket's last row and the next bucket's first row.
    3. The edges are joined back on the bucket key. The big side is already
       hash-partitioned on that key by step 1, so only the edge table moves.
    """
    by = list(by)
    bcol = "_bucket"
    b = bucket if bucket is not None else F.col(ts).cast("date")
    vals = F.struct(*[F.col(c) for c in cols])
    x0 = df.withColumn(bcol, b).withColumn("_v", vals)
    keys = [*by, bcol]
    w_in = Window.partitionBy(*keys).orderBy(ts)
    x = x0.select("*", F.lag("_v", 1).over(w_in).alias("_prev_in"),
                  F.lead("_v", 1).over(w_in).alias("_next_in"))
    # per-column min_by/max_by keep fixed-width buffers (hash aggregation);
    # ``ts`` is unique within a bucket, so they all read the same edge row
    edges = (x0.groupBy(*keys)
               .agg(*[F.min_by(c, ts).alias(f"_f_{c}") for c in cols],
                    *[F.max_by(c, ts).alias(f"_l_{c}") for c in cols])
               .select(*keys, F.struct(*[F.col(f"_f_{c}").alias(c) for c in cols]).alias("_first"),
                       F.struct(*[F.col(f"_l_{c}").alias(c) for c in cols]).alias("_last")))
    w_edge = Window.partitionBy(*by).orderBy(bcol)
    edges = edges.select(*keys, F.lag("_last", 1).over(w_edge).alias("_prev_edge"),
                         F.lead("_first", 1).over(w_edge).alias("_next_edge"))
    y = x.join(edges, keys, "left")
    prev = F.coalesce(F.col("_prev_in"), F.col("_prev_edge"))
    nxt = F.coalesce(F.col("_next_in"), F.col("_next_edge"))
    out = [F.col(c) for c in df.columns]
    for c in cols:
        out.append(prev.getField(c).alias(lag_fmt.format(c=c)))
        out.append(nxt.getField(c).alias(lead_fmt.format(c=c)))
    return y.select(*out)
