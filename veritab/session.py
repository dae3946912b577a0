"""Session construction and cluster-safe settings."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job relies on: adaptive execution (runtime broadcast decisions based on
# measured sizes, partition coalescing, skew-join splitting) and UTC timestamps.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app: str = "veritab",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the adaptive settings the operators assume."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent (local tests) is ``fallback`` installed; a cluster must
    name a shared folder, never a machine-local one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if fallback:
        os.makedirs(fallback, exist_ok=True)
        sc.setCheckpointDir(fallback)
        return sc.getCheckpointDir()
    return None


def require_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; operators that write intermediate tables fail without one."""
    current = checkpoint_dir(spark)
    if not current:
        raise RuntimeError("spark.checkpoint.dir is not set; this operator writes intermediate tables to a shared folder")
    return current


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder; on a local master with none configured, a fresh local one.

    A cluster must name its shared folder in ``spark.checkpoint.dir``; nothing local is installed there."""
    current = checkpoint_dir(spark)
    if current or not spark.sparkContext.master.startswith("local"):
        return current
    import tempfile

    return checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="veritab-ckpt-"))
