"""Registered queries: the keyed-table family (upsert, insert-if-absent,
keyless insert, create, align) on the driver's orders and customer tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.upsert import align_to, insert_new_rows, resolve_key, upsert, upsert_table
from ..session import scratch_path
from . import fixtures as fx
from .registry import register

ORDERS_SQL = f"""WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{fx.TARGET_BEFORE}'),
src AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{fx.BATCH_FROM}'),
b0 AS (SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1.0 AS o_totalprice,
              1 AS version
       FROM src
       UNION ALL
       SELECT o_orderkey, o_custkey, 'R', o_totalprice + 2.0, 2 FROM src
       WHERE o_orderpriority = '{fx.SECOND_REVISION}'),
b AS (SELECT * FROM b0 QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) = 1)
"""

UPDATED = """SELECT coalesce(t.o_orderkey, b.o_orderkey) AS o_orderkey,
       CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_orderstatus ELSE t.o_orderstatus END
         AS o_orderstatus,
       CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_totalprice ELSE t.o_totalprice END
         AS o_totalprice,
       t.o_orderdate, t.o_orderpriority{extra}
FROM t FULL OUTER JOIN b ON t.o_orderkey = b.o_orderkey"""


@register("upsert_update", ORDERS_SQL + UPDATED.format(extra=""), dates=())
def q_upsert_update(spark, sf_dir):
    """Orders re-sent from BATCH_FROM (some twice): the latest version
    updates status and price of known orders, new orders are inserted."""
    return upsert(fx.orders_target(spark, sf_dir), fx.orders_batch(spark, sf_dir),
                  ["o_orderkey"], order=["version"])


@register("upsert_ignore", ORDERS_SQL + """
SELECT * FROM t
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, NULL::TIMESTAMP, NULL::VARCHAR
FROM b WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = b.o_orderkey)""", dates=())
def q_upsert_ignore(spark, sf_dir):
    """Insert-if-absent (conflict does nothing): absent keys are inserted
    with the batch's latest version, present ones are left alone."""
    return upsert(fx.orders_target(spark, sf_dir), fx.orders_batch(spark, sf_dir),
                  ["o_orderkey"], order=["version"], on_match="ignore")


@register("insert_distinct_new", f"""
WITH t AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal,
                  CASE WHEN c_mktsegment <> '{fx.NULLED_SEGMENT}' THEN c_mktsegment END
                    AS c_mktsegment
           FROM customer),
changed AS (SELECT * REPLACE (c_acctbal + 1.0 AS c_acctbal) FROM t
            WHERE c_mktsegment = '{fx.NEW_SEGMENT}')
SELECT * FROM t
UNION ALL SELECT * FROM changed
UNION ALL SELECT * FROM changed""", dates=())
def q_insert_distinct_new(spark, sf_dir):
    """Keyless insert: the batch re-sends every row (NULL segments
    included, matched NULL-safely) plus changed rows twice; only the
    changed rows are new, and both copies go in."""
    return insert_new_rows(fx.customer_target(spark, sf_dir), fx.customer_batch(spark, sf_dir))


@register("upsert_create", ORDERS_SQL + """
SELECT u.*, CAST(year(s.o_orderdate) AS INTEGER) AS o_year
FROM (""" + UPDATED.format(extra="") + """) u JOIN orders s ON s.o_orderkey = u.o_orderkey""",
          dates=())
def q_upsert_create(spark, sf_dir):
    """A partitioned table created by the first upsert (no target yet),
    then upserted again: only the partitions the batch touches are
    rewritten."""
    path = scratch_path(spark, "orders-table")
    year = F.year("o_orderdate")
    target = fx.orders_target(spark, sf_dir).withColumn("o_year", year)
    upsert_table(spark, path, target, ["o_orderkey"], "o_year")
    src = fx.table(spark, sf_dir, "orders").select("o_orderkey", year.alias("o_year"))
    batch = fx.orders_batch(spark, sf_dir).join(src, "o_orderkey")
    # rows inserted by the batch land in the batch's year; rows updated keep
    # the year they already had (same order date)
    upsert_table(spark, path, batch, ["o_orderkey"], "o_year", order=["version"])
    return spark.read.parquet(path)


NULLED = "o_orderkey % 10 = 3"  # rows whose key is lost, on both sides


@register("upsert_null_keys", f"""
WITH t AS (SELECT * REPLACE (CASE WHEN NOT ({NULLED}) THEN o_orderkey END AS o_orderkey)
           FROM orders WHERE o_orderdate < TIMESTAMP '{fx.TARGET_BEFORE}'),
b0 AS (SELECT CASE WHEN NOT ({NULLED}) THEN o_orderkey END AS o_orderkey, o_custkey,
              'U' AS o_orderstatus, o_totalprice + 1.0 AS o_totalprice
       FROM orders WHERE o_orderdate >= TIMESTAMP '{fx.BATCH_FROM}'),
b AS (SELECT * FROM b0 QUALIFY row_number() OVER (
        PARTITION BY o_orderkey ORDER BY o_custkey DESC, o_orderstatus DESC, o_totalprice DESC) = 1)
SELECT t.o_orderkey, CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       t.o_orderdate, t.o_orderpriority
FROM t LEFT JOIN b ON t.o_orderkey = b.o_orderkey
UNION ALL
SELECT b.o_orderkey, o_custkey, o_orderstatus, o_totalprice, NULL, NULL FROM b
WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = b.o_orderkey)""", dates=())
def q_upsert_null_keys(spark, sf_dir):
    """A tenth of the keys are NULL on both sides: target rows without a key
    stay, the batch's are one group and are inserted."""
    key = F.when(~F.expr(NULLED), F.col("o_orderkey"))
    target = fx.orders_target(spark, sf_dir).withColumn("o_orderkey", key)
    batch = (fx.orders_batch(spark, sf_dir).where("version = 1").drop("version")
             .withColumn("o_orderkey", key))
    return upsert(target, batch, ["o_orderkey"])


MOVED_YEAR = 1992  # all its orders move, so its partition ends empty


@register("upsert_moved", f"""
SELECT o_orderkey, o_custkey, CASE WHEN moved THEN 'M' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, CAST(o_year + CASE WHEN moved THEN 1 ELSE 0 END AS INTEGER) AS o_year
FROM (SELECT *, year(o_orderdate) AS o_year,
             year(o_orderdate) = {MOVED_YEAR} OR o_orderkey % 5 = 0 AS moved FROM orders)""",
          dates=())
def q_upsert_moved(spark, sf_dir):
    """A batch that gives known keys another partition value: the rows move,
    none is left behind, and the partition that empties is gone."""
    path = scratch_path(spark, "orders-moved")
    o_ = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.year("o_orderdate").alias("o_year"))
    upsert_table(spark, path, o_, ["o_orderkey"], "o_year")
    batch = o_.where((F.col("o_year") == MOVED_YEAR) | (F.col("o_orderkey") % 5 == 0)).withColumns(
        {"o_orderstatus": F.lit("M"), "o_year": F.col("o_year") + 1})
    upsert_table(spark, path, batch, ["o_orderkey"], "o_year")
    return spark.read.parquet(path)


@register("upsert_resolved_key", ORDERS_SQL + UPDATED.format(extra=""), dates=())
def q_upsert_resolved_key(spark, sf_dir):
    """The key is the first declared one whose columns the batch carries: the
    primary key is missing in it, the second unique key is not."""
    batch = fx.orders_batch(spark, sf_dir)
    key = resolve_key([["o_rowid"], ["o_orderkey", "o_orderdate"], ["o_orderkey"]], batch.columns)
    return upsert(fx.orders_target(spark, sf_dir), batch, key, order=["version"])


@register("align_to_target", """
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""",
          dates=())
def q_align_to_target(spark, sf_dir):
    """A batch with text-typed columns, one missing and one extra column,
    aligned to the target schema (intersection, target order and types)."""
    o = fx.table(spark, sf_dir, "orders")
    batch = o.select(F.col("o_orderpriority"), F.col("o_totalprice").cast("string"),
                     F.col("o_orderdate").cast("string"), "o_orderkey", "o_orderstatus",
                     F.lit("x").alias("unrelated"))
    return align_to(batch, o.schema)
