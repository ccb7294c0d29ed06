"""Sharding by sampled splitters.

Records are ordered by (hash of the text, doc_id, place in the input): equal
texts lie side by side, yet a group of copies of any size can be cut, since the
id goes on where the text ends, and the place where the id repeats. Ids that
are no integers go by their hash. A size-weighted sample of keys gives quantile boundaries
of many fine ranges; every record is put into its range by binary search, and
the exact bytes of each range are summed. A shard's share is a span of
running bytes: a range within one span goes to its shard as a whole, an
overfull range, one that crosses the end of a share, is subdivided at
the record where the share ends. Shard sizes thus differ from the mean by at
most about one record, whatever the sample was.

DataFrame functions only. The sample, the boundaries and the ranges are
bounded by parameters; no task holds more than a range.

Defined cases: null text has no bytes, size 8, checksum 0 and the hash of the
empty text; null ids sort first; repeated rows are records of their own; an
empty table gives no row. A table with fewer records than shards leaves
shards empty. Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import staged

SHARDS = 24
ROW_OVERHEAD = 8
SAMPLES_PER_RANGE = 24
ROWS_PER_RANGE = 50_000
KEY = ("k1", "k2", "k3")
RANGES_PER_SHARD = 4
MAX_RANGES = 20_000  # of a sample of at most about half a million keys


def keyed(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = isinstance(documents.schema["doc_id"].dataType, T.IntegralType)
    own = F.col("doc_id").cast("long") if whole else F.xxhash64("doc_id")
    return documents.select(
        "doc_id", (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("k1"),
        F.when(F.col("doc_id").isNull(), F.lit(-2**63)).otherwise(own).alias("k2"),
        # fixed once the table is written; tells apart rows that repeat
        F.monotonically_increasing_id().alias("k3"))


def boundaries(records: DataFrame, rows: int, total: int, ranges: int) -> list[tuple[int, ...]]:
    """Quantile keys of a size-weighted sample. Half of a record's weight is
    its size, half is being a row, so that a range has neither many bytes
    nor many rows."""
    weight = (F.col("size") / F.lit(total) + F.lit(1.0 / rows)) / 2
    chance = weight * F.lit(float(SAMPLES_PER_RANGE * ranges))
    draw = F.pmod(F.xxhash64(*KEY, F.lit(23)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = staged(records.where(draw < chance).select(*KEY), "splitters")
    drawn = sample.count()
    step = max(1, drawn // ranges)
    # the sample is bounded, so one task may order it
    order = Window.orderBy(*KEY)
    cut = (sample.withColumn("i", F.row_number().over(order))
           .where(F.col("i") % step == 0).select(*KEY).orderBy(*KEY).collect())
    return [tuple(r) for r in cut]


def range_of(cuts: list[tuple[int, ...]]) -> Column:
    """Number of boundaries at or below the key: binary search over literal
    arrays, log2(ranges) steps per record."""
    if not cuts:
        return F.lit(0)
    names = KEY[:len(cuts[0])]
    bounds = [F.lit([c[i] for c in cuts]) for i in range(len(names))]

    def step(state, _):
        mid = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
        above = F.lit(True)
        for name, bound in zip(reversed(names), reversed(bounds)):
            at = F.element_at(bound, mid + 1)
            above = (F.col(name) > at) | ((F.col(name) == at) & above)
        done = state["lo"] >= state["hi"]
        return F.when(done, state).otherwise(F.struct(
            F.when(above, mid + 1).otherwise(state["lo"]).alias("lo"),
            F.when(above, state["hi"]).otherwise(mid).alias("hi")))

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))
    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length() + 1))
    return F.aggregate(steps, start, step, lambda s: s["lo"])


def shard(documents: DataFrame, shards: int = SHARDS, max_ranges: int = MAX_RANGES) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot), sizes near equal."""
    records = staged(keyed(documents), "shard-keys")
    sums = records.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b")).first()
    rows, total = sums["n"], sums["b"] or 1
    ranges = int(min(max_ranges, max(shards * RANGES_PER_SHARD, rows // ROWS_PER_RANGE)))
    cuts = boundaries(records, max(rows, 1), total, ranges) if rows else []
    records = records.withColumn("range", range_of(cuts))

    # bytes before each range: one row per range
    per_range = (records.groupBy("range").agg(F.sum("size").alias("bytes"))
                 .withColumn("base", F.coalesce(F.sum("bytes").over(
                     Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)),
                     F.lit(0))).select("range", "base"))
    order = Window.partitionBy("range").orderBy(*KEY)
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("base") + F.col("upto") - F.col("size") / 2
    placed = staged(
        records.withColumn("upto", F.sum("size").over(running))
        .withColumn("n", F.row_number().over(order))
        .join(F.broadcast(per_range), "range")  # at most max_ranges rows
        .select("doc_id", "size", "text_crc32", "range", "n",
                F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(float(total))))
                .cast("int").alias("shard")), "sharded")

    # slots: rows of the shard in earlier ranges, less rows of the range in earlier shards
    parts = placed.groupBy("range", "shard").agg(F.count(F.lit(1)).alias("rows"))
    back = Window.unboundedPreceding
    parts = parts.select(
        "range", "shard",
        (F.coalesce(F.sum("rows").over(Window.partitionBy("shard").orderBy("range")
                                       .rowsBetween(back, -1)), F.lit(0))
         - F.coalesce(F.sum("rows").over(Window.partitionBy("range").orderBy("shard")
                                         .rowsBetween(back, -1)), F.lit(0))).alias("shift"))
    # at most max_ranges + shards rows
    return (placed.join(F.broadcast(parts), ["range", "shard"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("n") - 1 + F.col("shift")).cast("long").alias("slot")))


def shards_digest(documents: DataFrame) -> DataFrame:
    return shard(documents).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
