"""SparkSession helpers.

Cluster settings (checkpoint dir, shuffle partitions, memory) belong to the
deployment.  This module only fills in what is *unset*, so the same code runs
under a cluster's spark-defaults and in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every query in the package relies on.  UTC keeps event-time
# arithmetic and `unix_timestamp` identical to the SQL oracle.
_REQUIRED = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "zonewatch",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package's required settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the executor
            builder = builder.config("spark.driver.memory", "8g")
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in _REQUIRED.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_required(spark)
    return spark


def apply_required(spark: SparkSession) -> None:
    """Set the runtime SQL confs the package depends on (idempotent)."""
    for key, value in _REQUIRED.items():
        spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it to shared storage.  Only when it is
    unset (local tests) do we create a scratch folder and register it.
    """
    configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    conf_value = spark.conf.get("spark.checkpoint.dir", None)
    if conf_value:
        spark.sparkContext.setCheckpointDir(conf_value)
        return spark.sparkContext.getCheckpointDir() or conf_value
    if spark.sparkContext.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="zonewatch-ckpt-")
        spark.sparkContext.setCheckpointDir(path)
        return spark.sparkContext.getCheckpointDir() or path
    raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required on a cluster")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name


def run_dir(spark: SparkSession, name: str) -> str:
    """A new sub-folder for what one run writes, removed when the driver's JVM ends."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(at)
    fs.deleteOnExit(at)
    return path


# What an execution has shuffled is removed when it ends, not when the driver next collects garbage; a plan
# that runs again makes its shuffles again.
SHUFFLES_END = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, **values) -> Iterator[None]:
    """SQL settings, ``**{"spark.sql...": value}``, for what starts inside; then as before."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
