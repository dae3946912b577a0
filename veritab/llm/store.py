"""Cut lineage into written tables under the folder the cluster names in ``spark.checkpoint.dir``.

A table that several branches read is written once as Parquet in that shared folder and read back, so a lost
executor costs a re-read of files that every executor sees, never a recomputation from the start.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from veritab.session import checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder; fails when the session names none."""
    root = checkpoint_dir(spark)
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set; this operator writes intermediate tables to a shared folder")
    return f"{root.rstrip('/')}/veritab-llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the table as read back."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """:func:`materialize` with the folder, for a step that calls :func:`drop_table` when the table is used up."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table of :func:`write_table` that no later step reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
