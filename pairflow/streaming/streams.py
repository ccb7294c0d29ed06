"""Structured Streaming versions of the pipeline stages.

No stage drops late rows: what a stage remembers lies in its tables, not in
watermarked state, so a row may arrive any time and gives the result that the
batch operator gives on all rows.

* ``ingest_stream``: new landing files -> typed day-partitioned layer,
  exactly once (file-source log + checkpoint).
* ``dedup_stream``: overlapping pulls collapse to the first arrival of a
  (symbol, minute): each micro-batch inserts the keys its days lack.
* ``bounded_dedup_stream``: the same with the keys of the last hours in the
  state store; what comes later, or without a key, goes to a late table.
* ``rollup_stream``: ticks -> candles. Each micro-batch stores its partial
  candles under its own number and rebuilds the candles of the days it touched
  from all partials of those days, which are merged level by level.
* ``features_stream``: each micro-batch of new candles of either series
  upserts its layer, recomputes the feature rows that it can change and puts
  them into their day partitions (row-offset windows are not allowed on
  streams).

Replaying a micro-batch after a lost executor or a driver restart gives the
same tables: inserts and upserts are keyed (rows with a NULL in the key are
left out, they have no identity), partials are overwritten by batch number,
and days are overwritten whole.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.time import floor_minute, ts_to_epoch_us
from . import segments


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A child session (same SparkContext, its own SQL conf) for stateful
    streams. A stateful query fixes its number of state partitions from
    ``spark.sql.shuffle.partitions`` at its first run; in the child session
    that is ``state_partitions`` (default: the cluster's default
    parallelism, one state partition per core), whatever the batch
    setting of the caller's session, which is left unchanged."""
    child = spark.newSession()
    n = state_partitions or spark.sparkContext.defaultParallelism
    child.conf.set("spark.sql.shuffle.partitions", str(n))
    return child


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def ingest_stream(spark: SparkSession, source: str, schema: T.StructType, sink: str,
                  checkpoint: str, fmt: str = "json", partition_col: str = "dt",
                  transform=None, trigger: str | None = "availableNow",
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Stream landing files of ``fmt`` under ``source`` into a Parquet layer
    partitioned by ``partition_col`` (``transform`` types/cleans rows)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.load(source)
    if transform is not None:
        df = transform(df)
    w = (df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
           .partitionBy(partition_col).outputMode("append"))
    return _trigger(w, trigger).start(sink)


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a complete key: only these can be recognised on replay."""
    return df.dropna(subset=list(keys))


def keep_rejects(rows: DataFrame, keys: Sequence[str], path: str, epoch: int) -> None:
    """Rows with a NULL in the key, stored under the batch's number, so that
    a replay replaces them; a batch without any stores nothing."""
    nameless = F.lit(False)
    for k in keys:
        nameless = nameless | F.col(k).isNull()
    bad = rows.where(nameless)
    if not bad.isEmpty():
        bad.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def dedup_stream(df: DataFrame, keys: Sequence[str], table: str, checkpoint: str,
                 partition_col: str = "dt", order: Sequence[str] = ("ingested_at_utc",),
                 trigger: str | None = "availableNow") -> StreamingQuery:
    """First arrival per key in a day-partitioned table, however late: a
    micro-batch keeps its least ``order`` per key and inserts the keys that
    the table lacks. ``partition_col`` must follow from the key, so only the
    touched days are read. Rows with a NULL in the key go to
    ``<table>-rejects`` under the batch's number."""
    from ..operators.dedup import dedup
    from ..operators.upsert import upsert_table

    def sink(batch: DataFrame, epoch: int) -> None:
        keep_rejects(batch, keys, f"{table.rstrip('/')}-rejects", epoch)
        first = dedup(_keyed(batch, keys), keys, [c for c in order if c in batch.columns],
                      keep="first")
        upsert_table(batch.sparkSession, table, first, [*keys, partition_col], partition_col,
                     on_match="ignore")

    w = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    return _trigger(w, trigger).start()


def _event_time(c) -> Column:
    """A zone-free TIMESTAMP of a TIMESTAMP_NTZ, as watermarks need one."""
    return F.timestamp_micros(ts_to_epoch_us(c))


LATE_REASONS = ("late", "null_key")


def bounded_dedup_stream(df: DataFrame, keys: Sequence[str], table: str, checkpoint: str, *,
                         event_time: str = "ts_minute_utc", delay: str = "1 hour",
                         partition_col: str = "dt", order: Sequence[str] = ("ingested_at_utc",),
                         late_table: str | None = None, fanout: int = segments.FANOUT,
                         trigger: str | None = "availableNow") -> StreamingQuery:
    """First arrival per key with bounded state and without loss.

    Two lanes of one query. Keys inside the watermark (``delay`` behind the
    latest ``event_time``) are kept by ``dropDuplicatesWithinWatermark`` in
    the state store, whose size is the keys of that span; their first rows go to
    ``table`` without any reading of it. Rows behind the watermark, which
    the state store drops, and rows with a NULL in the key or event time go to
    ``late_table`` (default: beside the table), one row per key and batch with
    its ``reason``, the number of ``arrivals`` and the batch: late ones only if
    the table's days lack their key. ``deduplicated`` reads both as one table.

    The key must determine event time and partition. Both tables are segments
    by day and batch number (see ``segments``), so a replayed batch replaces
    what it wrote, and ``<late_table>-progress`` has a row of counts per batch.
    Create ``df`` in a ``stream_session`` to choose the state partitions."""
    from ..operators.dedup import dedup
    from ..session import scratch_path
    from ..sources.files import path_exists
    from ..sources.sinks import remove_path
    keys, late_table = list(keys), late_table or f"{table.rstrip('/')}-late"
    progress = f"{late_table}-progress"
    order = [c for c in order if c in df.columns]
    whole = F.col(event_time).isNotNull()
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    seen = (df.where(whole).select(*keys, _event_time(event_time).alias("_at"))
            .withWatermark("_at", delay).dropDuplicatesWithinWatermark(keys)
            .select(*[F.col(k) for k in keys], F.lit(True).alias("_first")))
    lanes = df.withColumn("_first", F.lit(False)).unionByName(seen, allowMissingColumns=True)

    def sink(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        stage = scratch_path(spark, "dedup-batch")
        batch.write.parquet(stage)  # the state store is asked once
        rows = spark.read.schema(batch.schema).parquet(stage)
        new_keys = rows.where("_first").select(*keys)
        arrived = rows.where("NOT _first").drop("_first")
        before = None  # the latest event time of the earlier batches
        if epoch and path_exists(spark, f"{progress}/epoch={epoch - 1}"):
            before = spark.read.parquet(f"{progress}/epoch={epoch - 1}").first()["latest"]

        firsts, lates = Observation(), Observation()
        first = dedup(arrived.where(whole).join(new_keys, keys, "left_semi"), keys, order, "first")
        segments.write_segment(first.observe(firsts, F.count(F.lit(1)).alias("first_rows")), table,
                               partition_col, epoch)

        counts = dedup_counts(arrived.where(~whole), keys, order, "null_key")
        if before is not None:
            # the state store drops up to the watermark's millisecond; a row too
            # many here is only looked up
            limit = F.timestamp_add("MILLISECOND", F.lit(1),
                                    F.lit(before).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}"))
            old = arrived.where(whole & (F.col(event_time) <= limit)) \
                .join(new_keys, keys, "left_anti")
            have = segments.read_days(spark, table, partition_col, arrived.schema,
                                      segments.day_values(old, partition_col)).select(*keys)
            counts = counts.unionByName(
                dedup_counts(old, keys, order, "late").join(have, keys, "left_anti"))
        late = counts.withColumn("epoch", F.lit(epoch).cast("bigint"))
        segments.write_segment(
            late.observe(lates, F.count_if(F.col("reason") == "late").alias("late_keys"),
                         F.coalesce(F.sum("arrivals"), F.lit(0)).alias("late_arrivals")),
            late_table, partition_col, epoch)

        latest = F.max(F.when(whole, F.col(event_time)))
        (arrived.agg(F.count(F.lit(1)).alias("arrived"),
                     F.greatest(latest, F.lit(before).cast("timestamp_ntz")).alias("latest"))
         .select("*", *[F.lit(n).cast("bigint").alias(c)
                        for c, n in {**firsts.get, **lates.get}.items()])
         .coalesce(1).write.mode("overwrite").parquet(f"{progress}/epoch={epoch}"))
        days = segments.day_values(arrived, partition_col)
        for root, like in ((table, arrived.schema), (late_table, late.schema)):
            segments.compact(spark, root, partition_col, like, days, fanout=fanout)
        remove_path(spark, stage)

    w = lanes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    return _trigger(w, trigger).start()


def dedup_counts(rows: DataFrame, keys: Sequence[str], order: Sequence[str],
                 reason: str) -> DataFrame:
    """The first row per key (NULL keys grouped like any value), with the
    number of its arrivals and the reason it is here."""
    from ..operators.dedup import dedup
    one = dedup(rows.withColumn("arrivals", F.lit(1).cast("bigint")), keys, order, "first")
    same = [F.col(f"_n.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in keys]
    total = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("arrivals"))
    return (one.drop("arrivals").alias("_r").join(total.alias("_n"), same, "left")
            .select("_r.*", "_n.arrivals", F.lit(reason).alias("reason")))


def deduplicated(spark: SparkSession, table: str, schema: T.StructType, keys: Sequence[str], *,
                 partition_col: str = "dt", order: Sequence[str] = ("ingested_at_utc",),
                 late_table: str | None = None, days: Sequence[str] | None = None) -> DataFrame:
    """The rows that ``bounded_dedup_stream`` has let through, its late lane
    included: what the batch ``dedup`` gives on all rows that arrived."""
    from ..operators.dedup import dedup
    late_table = late_table or f"{table.rstrip('/')}-late"
    late_schema = T.StructType([*schema.fields, T.StructField("arrivals", T.LongType()),
                                T.StructField("reason", T.StringType()),
                                T.StructField("epoch", T.LongType())])

    def stored(root, like):
        asked = days if days is not None else segments.all_days(spark, root, partition_col)
        return segments.read_days(spark, root, partition_col, like, asked)
    late = stored(late_table, late_schema)
    rest = dedup(late, keys, [*[c for c in order if c in schema.fieldNames()], "epoch"], "first")
    return stored(table, schema).unionByName(rest.select(*schema.fieldNames()))


PARTIAL_KEY = ["symbol", "ts_minute_utc", "execution_date"]


def partial_candles(ticks: DataFrame, ts: str = "ts", price: str = "price", size: str = "size",
                    symbol: str = "symbol", order: Sequence[str] | str = "ts") -> DataFrame:
    """Candles of some ticks with the ordering values of their open and
    close, so that partial candles of a minute can be merged."""
    from ..operators.candles import tick_order
    order = [order] if isinstance(order, str) else list(order)
    minute = floor_minute(ts)
    p = F.col(price).cast("double")
    return (ticks.select(F.col(symbol).alias("symbol"), minute.alias("ts_minute_utc"),
                         minute.cast("date").alias("execution_date"), p.alias("_p"),
                         F.when(p.isNotNull(), tick_order(order, ticks.schema)).alias("_o"),
                         F.col(size).cast("double").alias("_v"))
            .groupBy(*PARTIAL_KEY)
            .agg(F.min_by("_p", "_o").alias("open"), F.max("_p").alias("high"),
                 F.min("_p").alias("low"), F.max_by("_p", "_o").alias("close"),
                 F.sum("_v").alias("volume"), F.count(F.lit(1)).alias("trades"),
                 F.min("_o").alias("open_order"), F.max("_o").alias("close_order")))


def merged_partials(partials: DataFrame) -> DataFrame:
    """Partial candles of the same minutes merged into one partial each:
    merging is associative, so it may be done in any number of steps."""
    return (partials.groupBy(*PARTIAL_KEY)
            .agg(F.min_by("open", "open_order").alias("open"), F.max("high").alias("high"),
                 F.min("low").alias("low"), F.max_by("close", "close_order").alias("close"),
                 F.sum("volume").alias("volume"), F.sum("trades").alias("trades"),
                 F.min("open_order").alias("open_order"),
                 F.max("close_order").alias("close_order")))


def merged_candles(partials: DataFrame) -> DataFrame:
    """Partial candles of the same minutes merged into candles."""
    return merged_partials(partials).drop("open_order", "close_order")


def rollup_stream(ticks: DataFrame, table: str, checkpoint: str,
                  partials: str | None = None, trigger: str | None = "availableNow",
                  fanout: int = segments.FANOUT, **cols) -> StreamingQuery:
    """Ticks -> candle table. ``partials`` (default: beside the table) holds
    each micro-batch's partial candles by day and batch number, merged level
    by level (see ``segments``); a tick of any age corrects its candle. A
    batch lists, reads and rewrites the days of its ticks only."""
    from ..sources.sinks import write_layer
    partials, day = partials or f"{table.rstrip('/')}-partials", "execution_date"
    ts = cols.get("ts", "ts")

    def sink(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        part = partial_candles(batch, **cols)
        segments.write_segment(part, partials, day, epoch)
        days = segments.day_values(batch.select(floor_minute(ts).cast("date").alias(day)), day)
        segments.compact(spark, partials, day, part.schema, days, merged_partials, fanout)
        stored = segments.read_days(spark, partials, day, part.schema, days)
        write_layer(merged_candles(stored), table, day)

    w = ticks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    return _trigger(w, trigger).start()


def features_stream(base: DataFrame, ref: DataFrame, base_table: str, ref_table: str,
                    features_table: str, checkpoint: str,
                    trigger: str | None = "availableNow", max_lag: int = 5,
                    seed: str = "previous_day", by: Sequence[str] = (),
                    changes_table: str | None = None) -> StreamingQuery:
    """Both candle streams -> feature table.

    Per micro-batch the new candles of either series are upserted into
    ``base_table`` and ``ref_table`` by (symbol, minute), and the feature rows
    that they can change are recomputed (see ``operators.changes``) and put in
    place of the stored ones. The first batch, and every batch under
    ``last_known``, recomputes whole days: their own, the day after a ref day
    (its seed), and for ``last_known`` all later ones. ``changes_table`` gets the
    recomputed minutes per batch and day. Rows with a NULL in the key go to
    ``<table>-rejects`` under the batch's number.
    ``ref`` may be a stream, whose late files then reach the features, or a
    static frame, which is stored once with the first micro-batch."""
    from ..operators import changes
    from ..operators.pairing import lead_lag_features
    from ..operators.upsert import upsert_table
    from ..session import scratch_path
    from ..sources.files import path_exists
    from ..sources.sinks import remove_path, write_layer
    keys, day = ["symbol", "ts_minute_utc", *by, "execution_date"], "execution_date"
    keys = list(dict.fromkeys(keys))

    def tagged(df, is_ref):
        return df.withColumn("_ref", F.lit(is_ref))

    if ref.isStreaming:
        source = tagged(base, False).unionByName(tagged(ref, True), allowMissingColumns=True)
    else:
        source = tagged(base, False)
        static_ref = ref

    def store(spark, rows, table, like):
        cols = [c for c in rows.columns if c in like]
        upsert_table(spark, table, _keyed(rows, keys).select(*cols), keys, day,
                     order=["ingested_at_utc"])

    def days_of(spark, table, days):
        """The rows of some days, as a partition filter on their values."""
        have = spark.read.parquet(table)
        return have.where(F.col(day).isin([F.lit(d).cast("date") for d in days]))

    def changed_rows(spark, epoch, base_touched, ref_touched):
        days = sorted(r[0] for r in changes.touched_days(base_touched, ref_touched, day, seed)
                      .collect())  # days, not rows
        if not days:
            return
        before = sorted({*days, *(d - dt.timedelta(days=1) for d in days)})
        base_rows, ref_rows = days_of(spark, base_table, days), days_of(spark, ref_table, before)
        new, minutes = changes.changed_features(base_rows, ref_rows, base_touched, ref_touched,
                                                max_lag=max_lag, seed=seed, by=by)
        minutes_stage, new_stage = (scratch_path(spark, n) for n in ("minutes", "changed"))
        minutes.write.parquet(minutes_stage)
        new.write.parquet(new_stage)
        minutes = spark.read.schema(minutes.schema).parquet(minutes_stage)
        new = spark.read.schema(new.schema).parquet(new_stage)
        stored = days_of(spark, features_table, days)
        if changes_table:
            (minutes.groupBy(*by, day).agg(F.count(F.lit(1)).alias("recomputed"))
             .join(base_rows.groupBy(*by, day).agg(F.count(F.lit(1)).alias("day_rows")), [*by, day])
             .withColumn("epoch", F.lit(epoch).cast("bigint")).coalesce(1)
             .write.mode("overwrite").parquet(f"{changes_table}/epoch={epoch}"))
        write_layer(changes.replaced(stored, new, minutes, [*by, day, "ts_minute_utc"]),
                    features_table, day)
        remove_path(spark, minutes_stage)
        remove_path(spark, new_stage)

    def whole_days(spark, base_touched, ref_touched):
        base_rows, ref_rows = spark.read.parquet(base_table), spark.read.parquet(ref_table)
        days = changes.touched_days(base_touched, ref_touched, day)
        if seed == "last_known":
            first = ref_touched.agg(F.min(day)).first()[0]
            if first is not None:
                days = days.unionByName(base_rows.where(F.col(day) >= F.lit(first))
                                        .select(day).distinct()).distinct()
        base_part = base_rows.join(days, day, "left_semi")
        if seed != "last_known":  # a seed may come from any earlier day otherwise
            seed_days = days.select(F.date_sub(day, 1).alias(day))
            ref_rows = ref_rows.join(days.unionByName(seed_days).distinct(), day, "left_semi")
        f = lead_lag_features(base_part, ref_rows, max_lag=max_lag, seed=seed, by=by)
        write_layer(f.join(days, day, "left_semi"), features_table, day)

    def sink(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        stage = scratch_path(spark, "feature-batch")
        batch.write.parquet(stage)  # the batch is used several times
        rows = spark.read.schema(batch.schema).parquet(stage)
        new_ref = rows.where("_ref").drop("_ref")
        if not ref.isStreaming and not path_exists(spark, ref_table):
            new_ref = static_ref
        new_base = rows.where("NOT _ref").drop("_ref")
        for part, name in ((new_base, base_table), (new_ref, ref_table)):
            keep_rejects(part, keys, f"{name}-rejects", epoch)
        store(spark, new_base, base_table, base.columns)
        store(spark, new_ref, ref_table, ref.columns)
        touched = [_keyed(part, keys).select(*by, day, "ts_minute_utc").distinct()
                   for part in (new_base, new_ref)]
        if seed == "last_known" or not path_exists(spark, features_table):
            whole_days(spark, *touched)
        else:
            changed_rows(spark, epoch, *touched)
        remove_path(spark, stage)

    w = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    return _trigger(w, trigger).start()
