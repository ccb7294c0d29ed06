"""Keyed table maintenance without a MERGE-capable table format.

* ``upsert``: dedup the batch on the key, update matched rows on the
  columns the batch carries, insert the rest (``on_match="update"``), or
  insert only absent keys (``"ignore"``);
* ``insert_new_rows``: keyless, NULL-safe "insert what is not there";
* ``merge_append``: union of existing and incoming, one row per key with a
  side priority;
* ``align_to``: batch columns restricted and cast to the target schema;
* ``upsert_table``: rewrite only the day partitions a batch touches.

Semantics of keys with NULL (as in a SQL UNIQUE constraint): they never
match a target row, so such batch rows are appended; batch dedup groups
NULL keys like any value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dedup import dedup


def _aligned_columns(batch: DataFrame, target_schema: T.StructType) -> list:
    cols = []
    for f in target_schema.fields:
        if f.name in batch.columns:
            src = batch.schema[f.name].dataType
            c = F.col(f.name)
            cols.append((c if src == f.dataType else c.try_cast(f.dataType)).alias(f.name))
    return cols


def align_to(batch: DataFrame, target_schema: T.StructType) -> DataFrame:
    """Columns of ``batch`` that the target has, in target order, cast to
    the target types with ``try_cast`` (bad values become NULL)."""
    return batch.select(*_aligned_columns(batch, target_schema))


def resolve_key(candidates: Sequence[Sequence[str]], columns: Sequence[str]) -> list[str] | None:
    """First candidate key (primary key first, then unique keys) whose
    columns are all present; None when no key is usable."""
    cols = set(columns)
    for key in candidates:
        if key and set(key) <= cols:
            return list(key)
    return None


def _has_null_key(keys: Sequence[str]):
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def upsert(target: DataFrame | None, batch: DataFrame, keys: Sequence[str],
           order: Sequence[str] = (), on_match: str = "update") -> DataFrame:
    """The target after upserting ``batch`` on ``keys``.

    * target None: the batch (deduplicated) becomes the table;
    * the batch is deduplicated on ``keys`` keeping the greatest ``order``;
    * ``on_match="update"``: matched rows take the batch's values on the
      non-key columns the batch carries; other target columns are kept;
    * ``on_match="ignore"`` (or a batch with only key columns in common):
      matched rows are left untouched;
    * unmatched batch rows are inserted (target-only columns NULL).

    The updated rows are the target LEFT JOIN the batch, the inserted ones
    the batch ANTI JOIN the target's keys, so the engine may broadcast a batch
    that it has measured as small and then moves no target row. The batch is
    deduplicated with map-side combine first, so repeated keys do not pile
    up in one task. Rows with a NULL in the key never match: they pass beside
    the joins, where any number of them would hash to one partition.
    """
    keys = list(keys)
    if target is None:
        return dedup(batch, keys, order, keep="last")
    order = [c for c in order if c in batch.columns]
    extra = [c for c in order if c not in target.columns]  # batch-only ordering
    staged = batch.select(*_aligned_columns(batch, target.schema), *extra)
    b = dedup(staged, keys, order, keep="last").drop(*extra)
    nonkey = [c for c in b.columns if c not in keys]
    if on_match not in ("update", "ignore"):
        raise ValueError("on_match must be 'update' or 'ignore'")
    whole = target.where(~_has_null_key(keys))
    new = b.join(whole.select(*keys), keys, "left_anti")
    if on_match == "ignore" or not nonkey:
        return target.unionByName(new, allowMissingColumns=True)
    nb = b.where(~_has_null_key(keys)).select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in nonkey], F.lit(True).alias("_in_batch"))
    hit = F.col("_in_batch").isNotNull()
    out = [F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in nonkey else F.col(c)
           for c in target.columns]
    updated = whole.join(nb, keys, "left").select(*out)
    return (updated.unionByName(target.where(_has_null_key(keys)))
            .unionByName(new, allowMissingColumns=True))


def insert_new_rows(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Keyless insert: batch rows with no NULL-safe equal row in the target
    (on all common columns) are appended; duplicates inside the batch are
    kept. The NULL-safe equality is still an equi-join key for Spark."""
    b = align_to(batch, target.schema)
    common = b.columns
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in common])
    cond = [b[c].eqNullSafe(t[f"_t_{c}"]) for c in common]
    new = b.join(t, cond, "left_anti")
    return target.unionByName(new, allowMissingColumns=True)


def merge_append(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                 keep: str = "existing") -> DataFrame:
    """Union of both frames with one row per key: the existing row wins
    (``keep="existing"``) or the incoming one (``"incoming"``)."""
    if keep not in ("existing", "incoming"):
        raise ValueError("keep must be 'existing' or 'incoming'")
    e = existing.withColumn("_side", F.lit(0))
    i = incoming.withColumn("_side", F.lit(1))
    u = e.unionByName(i, allowMissingColumns=True)
    out = dedup(u, keys, ["_side"], keep="first" if keep == "existing" else "last")
    return out.drop("_side")


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
                 partition_col: str, order: Sequence[str] = (),
                 on_match: str = "update") -> None:
    """Upsert into a Parquet table partitioned by ``partition_col``,
    rewriting only the partitions the batch touches.

    Touched are the batch's own partitions and, unless the partition column
    belongs to the key, those where the target holds a key of the batch (found
    by reading the key columns alone): a row whose partition value changes
    moves, it is not stored twice. The batch is deduplicated and staged once.
    Merged rows are written aside and published by a stored plan, with the
    partitions that lost their last row (``sources.publish``): a run that
    stops anywhere leaves the old partitions or is finished by the next one.

    Rerunning after a failure gives the same table for rows with complete
    keys; rows with a NULL in the key are appended by every run, as an
    INSERT would, so a caller that may replay a batch drops or numbers them.
    """
    from ..session import scratch_path
    from ..sources.files import path_exists
    from ..sources.publish import finish_publish, publish_layer
    from ..sources.sinks import remove_path
    finish_publish(spark, path)
    if not path_exists(spark, path):
        publish_layer(upsert(None, batch, keys, order), path, partition_col, sort_col=None)
        return
    target = spark.read.parquet(path)
    batch_stage = scratch_path(spark, "upsert-batch")
    dedup(batch, list(keys), [c for c in order if c in batch.columns], keep="last") \
        .write.parquet(batch_stage)
    batch = spark.read.schema(batch.schema).parquet(batch_stage)
    touched = batch.select(F.col(partition_col).cast(target.schema[partition_col].dataType))
    moved: list[str] = []
    if partition_col not in keys:
        stored = target.select(*keys, partition_col).join(batch.select(*keys), list(keys),
                                                          "left_semi").select(partition_col)
        touched = touched.unionByName(stored)
        moved = [r["v"] for r in stored.select(F.col(partition_col).cast("string").alias("v"))
                 .distinct().where("v IS NOT NULL").collect()]  # partitions, not rows
    scoped = target.join(touched.distinct(), partition_col, "left_semi")
    merged = upsert(scoped, batch, keys, order, on_match).select(*target.columns)
    publish_layer(merged, path, partition_col, sort_col=None, replaces=moved)
    # on a failure above the stage stays for inspection and a rerun recomputes it
    remove_path(spark, batch_stage)
