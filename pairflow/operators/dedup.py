"""One row per key, deterministic, with map-side pre-aggregation.

``dedup`` aggregates ``max``/``min`` over a struct whose leading fields are
the ordering columns and whose tail is the whole row. The struct order breaks
every tie the same way on every run. A struct buffer has no fixed width, so
Spark plans sort aggregations: each map task sorts its rows by the key and
combines duplicates before the shuffle, so a key holding a third of all rows
still sends one row per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
          keep: str = "last") -> DataFrame:
    """Keep, per ``keys``, the row with the greatest (``keep="last"``) or
    least (``keep="first"``) ``order`` tuple; remaining columns break ties.

    NULL ordering values sort lowest. Rows whose key contains NULL are kept
    grouped like any other key value.
    """
    if keep not in ("last", "first"):
        raise ValueError("keep must be 'last' or 'first'")
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    ordered = [c for c in order if c in rest]
    tail = [c for c in rest if c not in ordered]
    fields = [F.col(c).alias(f"o{i}") for i, c in enumerate(ordered)]
    fields += [F.col(c).alias(f"t{i}") for i, c in enumerate(tail)]
    pick = F.max if keep == "last" else F.min
    agg = df.groupBy(*keys).agg(pick(F.struct(*fields)).alias("_row"))
    names = {f"o{i}": c for i, c in enumerate(ordered)}
    names.update({f"t{i}": c for i, c in enumerate(tail)})
    return agg.select(*keys, *[F.col(f"_row.{k}").alias(v) for k, v in names.items()]) \
        .select(*df.columns)
