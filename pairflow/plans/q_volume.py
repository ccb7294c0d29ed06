"""Registered queries on the largest table: the keyed-table and rollup
operators where rows do not collapse into minutes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.dedup import dedup
from ..operators.reports import last_n
from ..operators.upsert import upsert
from . import fixtures as fx
from .registry import register

KEY = ["l_orderkey", "l_linenumber"]

REVISED = """li AS (
  SELECT *, 1 AS version FROM lineitem
  UNION ALL
  SELECT * REPLACE (l_quantity + 1 AS l_quantity), 2 FROM lineitem WHERE l_returnflag = 'R'),
latest AS (SELECT * FROM li QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY version DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
           l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC, l_shipdate DESC) = 1)
"""


def _revised(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    again = li.where("l_returnflag = 'R'").withColumn("l_quantity", F.col("l_quantity") + 1)
    return li.withColumn("version", F.lit(1)).unionByName(again.withColumn("version", F.lit(2)))


@register("lineitem_dedup", f"WITH {REVISED} SELECT * FROM latest", dates=())
def q_lineitem_dedup(spark, sf_dir):
    """The latest version of every line."""
    return dedup(_revised(spark, sf_dir), KEY, ["version"], keep="last")


@register("lineitem_rollup", """
SELECT l_returnflag, l_linestatus, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS ship_day,
       count(*) AS n_lines, sum(CAST(l_quantity AS BIGINT)) AS quantity, min(l_extendedprice) AS low,
       max(l_extendedprice) AS high
FROM lineitem GROUP BY ALL""", dates=())
def q_lineitem_rollup(spark, sf_dir):
    """Daily rollup per flag and status."""
    li = fx.table(spark, sf_dir, "lineitem")
    return (li.groupBy("l_returnflag", "l_linestatus",
                       F.col("l_shipdate").cast("date").cast("timestamp_ntz").alias("ship_day"))
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
                 F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high")))


@register("lineitem_upsert", f"""
WITH {REVISED}, t AS (SELECT * FROM lineitem WHERE l_linestatus = 'O' OR l_linenumber <= 3)
, one AS (SELECT * FROM t QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
           l_tax DESC, l_returnflag DESC, l_linestatus DESC, l_shipdate DESC) = 1)
SELECT * EXCLUDE (version) FROM latest
UNION ALL
SELECT * FROM one WHERE NOT EXISTS (SELECT 1 FROM latest b WHERE b.l_orderkey = one.l_orderkey
                                    AND b.l_linenumber = one.l_linenumber)""", dates=())
def q_lineitem_upsert(spark, sf_dir):
    """A batch of every line's versions into a table of part of the lines."""
    li = fx.table(spark, sf_dir, "lineitem")
    target = dedup(li.where("l_linestatus = 'O' OR l_linenumber <= 3"), KEY)
    return upsert(target, _revised(spark, sf_dir), KEY, order=["version"])


@register("lineitem_last_n", """
SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC,
  l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) <= 3""", dates=())
def q_lineitem_last_n(spark, sf_dir):
    """The last three shipped lines of each supplier."""
    li = fx.table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    order = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return last_n(li.withColumn("_o", order), 3, ["l_suppkey"], ts="_o").drop("_o")
