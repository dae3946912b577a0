"""The corpus pipeline: quality classifier, near-duplicate join, decontamination, mixing, sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veritab.llm.stages import STAGES, run_stages

ORACLE_SQL = None  # the fitted classifier and the keyed permutations have no SQL form; tests/llm has brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_stages(spark, sf_dir)


__all__ = ["STAGES", "run", "ORACLE_SQL"]
