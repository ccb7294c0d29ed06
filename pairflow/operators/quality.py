"""Data-quality expectations evaluated in one pass.

Row-level rules (not NULL, positive, ordered pair, accepted values), key
uniqueness (a window on the key) and time order (a ``lag`` in order of
arrival inside each series partition) are ``count_if`` aggregates of one
scan. The report is one row per rule: (rule, column, violations).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    bad: Column | None  # row-level violation predicate (None for table rules)


def not_null(c: str) -> Rule:
    return Rule("not_null", c, F.col(c).isNull())


def positive(c: str) -> Rule:
    return Rule("positive", c, F.col(c) <= 0)


def ordered_pair(hi: str, lo: str) -> Rule:
    return Rule("high_ge_low", f"{hi},{lo}", F.col(hi) < F.col(lo))


def accepted_values(c: str, values: Sequence) -> Rule:
    return Rule("accepted_values", c, F.col(c).isNotNull() & ~F.col(c).isin(list(values)))


def expectations(df: DataFrame, rules: Sequence[Rule], unique_key: Sequence[str] = (),
                 order_by: str | None = None, order_within: Sequence[str] = (),
                 arrival: str | None = None, required: Sequence[str] = (),
                 model: str | None = None) -> DataFrame:
    """Violations per rule, from one scan and at most one shuffle of it.

    * ``rules``: row-level rules;
    * ``unique_key``: rows beyond the first of each key. When it contains
      ``order_within``, its window shares the order check's partitioning;
    * ``order_by`` within ``order_within``: rows whose ``order_by`` does not
      exceed that of the row before it by ``arrival`` (e.g. the ingest time);
      rows that arrive together are compared in ``order_by`` order;
    * ``required``: missing columns, checked at plan time (0 or 1 each);
    * ``model``: a leading column naming what was checked.
    """
    checks = [(r.name, r.column, r.bad) for r in rules]
    if order_by:
        if not order_within or not arrival:
            raise ValueError("order checks need partition keys (e.g. series and day) and the "
                             "column that orders arrival")
        w = Window.partitionBy(*order_within).orderBy(arrival, order_by)
        df = df.withColumn("_prev", F.lag(order_by, 1).over(w))
        checks.append(("strictly_increasing", order_by, F.col("_prev") >= F.col(order_by)))
    if unique_key:
        key = [c for c in order_within if c in unique_key] + \
              [c for c in unique_key if c not in order_within]
        first = Window.partitionBy(*key).orderBy(F.lit(0))
        df = df.withColumn("_nth", F.row_number().over(first))
        checks.append(("unique", ",".join(unique_key), F.col("_nth") > 1))
    rows = [F.struct(F.lit(n).alias("rule"), F.lit(c).alias("column_name"),
                     F.count_if(bad).alias("violations")) for n, c, bad in checks]
    missing = [F.struct(F.lit("required_column").alias("rule"), F.lit(c).alias("column_name"),
                        F.lit(0 if c in df.columns else 1).cast("bigint").alias("violations"))
               for c in required]
    head = [] if model is None else [F.lit(model).alias("model")]
    return (df.agg(F.array(*rows, *missing).alias("_r")).select(F.explode("_r").alias("_r"))
              .select(*head, "_r.rule", "_r.column_name", "_r.violations"))
