"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that change results, not just speed: timestamps are printed in UTC and
# the text rules are written for Java regex semantics.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings for throughput at scale; all are safe defaults on a cluster too.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcast hash joins only for sides that are really small; every broadcast in
    # this package is also guarded by an explicit size check.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "postmill",
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package settings applied."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = {**SCALE_SETTINGS, **RESULT_SETTINGS,
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # Local mode runs everything in the driver JVM; only effective at JVM start.
            "spark.driver.memory": "16g"}
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_settings(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_settings(spark: SparkSession) -> SparkSession:
    """Apply the result-affecting settings to an existing session (e.g. the driver's)."""
    for k, v in RESULT_SETTINGS.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and job outputs.

    This is ``spark.checkpoint.dir``, a shared file system. Only a single-JVM session (tests, local
    runs) that names none gets a local folder; on a cluster it would be one machine's disk, so
    an unset folder is an error there.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        local = tempfile.mkdtemp(prefix="postmill-ckpt-")
        sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one job's output."""
    base = checkpoint_dir(spark).rstrip("/")
    suffix = os.urandom(6).hex()
    return f"{base}/postmill/{name}-{suffix}"


def stored(df, name: str):
    """``df`` written once to a fresh scratch folder and read from there: a lineage cut in compressed columns, of which a
    reader takes those that it needs."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes inside drop their shuffle files as soon as they end, not when the driver next collects garbage. (A file that
    is still asked for is computed again.)"""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
