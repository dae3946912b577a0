"""Where catalogue queries that must write (sinks, run tables) put their data: a fresh folder under the
shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from veritab.session import checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    root = checkpoint_dir(spark)
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set; writing queries need a shared folder")
    return f"{root.rstrip('/')}/veritab-{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that no later step reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
