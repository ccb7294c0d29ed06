"""Inputs derived from the driver's tables, built inside each query.

``events`` plays the tick feed: ``value`` is the trade price and the integer
``k`` inside ``props`` is the trade size. From it:

* base: one-minute candles over all events, symbol ``ALL`` (runs 24/7);
* ref: one-minute candles of ``purchase`` events inside the session
  [14:30, 21:00) UTC, symbol ``REF`` (market hours only);
* scenario ref: ref with the calendar edge cases of the reference's
  feature job (a day without ref rows, two such days in a row, a day whose
  ref rows match no base minute);
* gappy ticks: prices NULL for sizes divisible by 7 (NULL-bearing candles);
* overlapping pulls: the last candle of every 5-minute pull fetched again
  5 minutes later with a revised close.

Nothing is sampled: every derived table covers the whole source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.candles import candle_metrics, to_candles

TICK_ORDER = ("ts", "event_id")      # open and close of a candle, ties settled

# Fixed values of the test scenario.
SESSION_OPEN_MINUTE = 14 * 60 + 30   # 14:30 UTC
SESSION_CLOSE_MINUTE = 21 * 60       # 21:00 UTC (exclusive)
REF_ABSENT_DAY = "2024-01-10"        # no ref rows; seed from 01-09
NO_SEED_DAYS = ("2024-01-20", "2024-01-21")  # 01-21 has neither rows nor seed
UNMATCHED_DAY = "2024-01-15"         # ref rows 30 s off the minute grid
PULL_MINUTES = 5                     # a pull fetches 5 candles; the last is re-fetched
GAP_SIZE_DIVISOR = 7                 # gappy ticks: NULL price when size % 7 == 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read with its declared schema (no inference job)."""
    from ..schemas import DRIVER_TABLES
    r = spark.read
    if name in DRIVER_TABLES:
        r = r.schema(DRIVER_TABLES[name])
    return r.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", "event_type", F.col("value").alias("price"),
                     F.get_json_object("props", "$.k").try_cast("bigint").alias("size"))


def gappy_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir)
    return t.withColumn("price", F.when(F.col("size") % GAP_SIZE_DIVISOR != 0, F.col("price")))


def _with_ingest(c: DataFrame, minutes: int = 1) -> DataFrame:
    return c.withColumn("ingested_at_utc",
                        F.timestamp_add("MINUTE", F.lit(minutes), F.col("ts_minute_utc")))


def base_candles(spark: SparkSession, sf_dir: str, metrics: bool = True) -> DataFrame:
    c = to_candles(ticks(spark, sf_dir), symbol="ALL", order=TICK_ORDER)
    c = _with_ingest(c)
    return candle_metrics(c, bullish=True) if metrics else c


def in_session(ts_col: str = "ts"):
    tod = F.hour(ts_col) * 60 + F.minute(ts_col)
    return (tod >= SESSION_OPEN_MINUTE) & (tod < SESSION_CLOSE_MINUTE)


def ref_candles(spark: SparkSession, sf_dir: str, metrics: bool = True) -> DataFrame:
    t = ticks(spark, sf_dir).where((F.col("event_type") == "purchase") & in_session())
    c = _with_ingest(to_candles(t, symbol="REF", order=TICK_ORDER))
    return candle_metrics(c, bullish=False) if metrics else c


def scenario_ref(ref: DataFrame) -> DataFrame:
    d = F.col("execution_date")
    dropped = [F.lit(x).cast("date") for x in (REF_ABSENT_DAY, *NO_SEED_DAYS)]
    kept = ref.where(~d.isin(*dropped))
    shifted = F.when(d == F.lit(UNMATCHED_DAY).cast("date"),
                     F.timestamp_add("SECOND", F.lit(30), F.col("ts_minute_utc"))
                     ).otherwise(F.col("ts_minute_utc"))
    return kept.withColumn("ts_minute_utc", shifted)


def gappy_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = to_candles(gappy_ticks(spark, sf_dir), symbol="ALL", order=TICK_ORDER)
    return _with_ingest(c)


def refetched(candles: DataFrame) -> DataFrame:
    """The last candle of each pull, fetched again one pull later with a
    revised close (it was still open at the first fetch)."""
    last_of_pull = F.minute("ts_minute_utc") % PULL_MINUTES == PULL_MINUTES - 1
    return (candles.where(last_of_pull)
            .withColumn("close", F.col("close") + 0.5)
            .withColumn("high", F.greatest(F.col("high"), F.col("close")))
            .withColumn("ingested_at_utc",
                        F.timestamp_add("MINUTE", F.lit(PULL_MINUTES), F.col("ingested_at_utc"))))


def overlapping_pulls(candles: DataFrame) -> DataFrame:
    """Every candle once, plus the re-fetched ones."""
    return candles.unionByName(refetched(candles))


def ref_from(t: DataFrame) -> DataFrame:
    t = t.where((F.col("event_type") == "purchase") & in_session())
    return _with_ingest(to_candles(t, symbol="REF", order=TICK_ORDER))


def raw_base_records(candles: DataFrame, extra=()) -> DataFrame:
    """Candles in the landing shape of a 24/7 exchange pull: text numerics,
    epoch-ms times, ISO text minute and ingest time, plus the ``dt`` folder
    (and any ``extra`` columns passed through)."""
    from ..functions.time import iso_text, ts_to_epoch_ms
    ms = ts_to_epoch_ms("ts_minute_utc")
    txt = lambda c: F.col(c).cast("string")
    qv = F.col("close") * F.col("volume")
    return candles.select(
        ms.alias("open_time"), txt("open").alias("open"), txt("high").alias("high"),
        txt("low").alias("low"), txt("close").alias("close"), txt("volume").alias("volume"),
        (ms + 59_999).alias("close_time"), qv.cast("string").alias("quote_volume"),
        F.col("trades"), (F.col("volume") / 2).cast("string").alias("taker_buy_base"),
        (qv / 2).cast("string").alias("taker_buy_quote"), F.lit("0").alias("ignore"),
        F.col("symbol"), F.lit("1m").alias("interval"),
        iso_text("ingested_at_utc").alias("ingested_at_utc"),
        iso_text("ts_minute_utc").alias("ts_minute_utc"),
        F.col("execution_date").alias("dt"), *extra)


def raw_ref_records(candles: DataFrame) -> DataFrame:
    """Candles in the landing shape of a quote pull (CSV text)."""
    from ..functions.time import iso_text
    txt = lambda c: F.col(c).cast("string")
    return candles.select(
        iso_text("ts_minute_utc", "+00:00").alias("datetime"),
        *[txt(c).alias(c) for c in ("open", "high", "low", "close", "volume")],
        iso_text("ts_minute_utc").alias("ts_minute_utc"), F.col("symbol"),
        F.lit("yfinance").alias("source"), iso_text("ingested_at_utc").alias("ingested_at_utc"),
        F.lit("1m").alias("interval"), F.col("execution_date").alias("dt"))


# Fixed values of the keyed-table scenarios (orders / customer).
TARGET_BEFORE = "1998-01-01"     # target table: orders placed before this date
BATCH_FROM = "1997-01-01"        # batch: orders re-sent from this date (overlap: 1997)
SECOND_REVISION = "1-URGENT"     # these orders are revised twice in the batch
NEW_SEGMENT = "BUILDING"         # customer rows re-sent with a changed balance
NULLED_SEGMENT = "AUTOMOBILE"    # customer rows whose segment is NULL in the target


def orders_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderdate") < F.lit(TARGET_BEFORE).cast("timestamp_ntz"))


def orders_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").where(
        F.col("o_orderdate") >= F.lit(BATCH_FROM).cast("timestamp_ntz"))
    v1 = o.select("o_orderkey", "o_custkey", F.lit("U").alias("o_orderstatus"),
                  (F.col("o_totalprice") + 1.0).alias("o_totalprice"), F.lit(1).alias("version"))
    v2 = o.where(F.col("o_orderpriority") == SECOND_REVISION).select(
        "o_orderkey", "o_custkey", F.lit("R").alias("o_orderstatus"),
        (F.col("o_totalprice") + 2.0).alias("o_totalprice"), F.lit(2).alias("version"))
    return v1.unionByName(v2)


def customer_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.withColumn("c_mktsegment", F.when(F.col("c_mktsegment") != NULLED_SEGMENT,
                                               F.col("c_mktsegment")))


def customer_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every target row again (already present, NULLs included) plus the
    re-sent segment with a changed balance, twice (batch duplicates)."""
    t = customer_target(spark, sf_dir)
    changed = t.where(F.col("c_mktsegment") == NEW_SEGMENT).withColumn(
        "c_acctbal", F.col("c_acctbal") + 1.0)
    return t.unionByName(changed).unionByName(changed)
