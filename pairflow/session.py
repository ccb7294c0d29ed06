"""Session construction and shared-storage scratch locations.

Library code never creates a session of its own: every operator takes
DataFrames and returns DataFrames. ``get_session`` is a convenience for
tests, the bench and command-line use; on a cluster the caller's session is
used as is.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings applied by get_session(). All are per-session and safe to leave at
# cluster defaults; the values here target a single host.
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def get_session(master: str | None = None, app: str = "pairflow",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(LOCAL_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and must be a shared file
    system; it is only filled in here when the session has none (local
    tests), so that lineage cuts and scratch tables still have a home.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
    if not current:
        if not sc.master.startswith("local"):
            # a machine-local folder would differ per executor host
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        current = tempfile.mkdtemp(prefix="pairflow-ckpt-")
        # a folder of our own making goes with the process
        atexit.register(shutil.rmtree, current, ignore_errors=True)
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def absolute_root(root: str) -> str:
    """A URI with any scheme ("file:/…", "hdfs://…", "s3a://…") is already
    absolute; only a bare relative path is resolved against the cwd."""
    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", root):
        return root
    return os.path.abspath(root)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the checkpoint root for a written table."""
    return f"{absolute_root(checkpoint_root(spark))}/pairflow/{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables that this library has left under the
    checkpoint root. Frames that still read them must have been written."""
    from .sources.sinks import remove_path
    remove_path(spark, f"{absolute_root(checkpoint_root(spark))}/pairflow")
