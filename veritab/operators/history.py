"""Run history and model versions as append-only tables (S7, H1–H6, D-9).

Runs, their parameters and metrics, model versions and stage events are plain DataFrames (written
with ``mode("append")`` under one folder), so "best runs", version numbering, current stage and model
cards are ordinary grouped / joined queries rather than calls to a tracking service.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RUNS = "runs"
PARAMS = "run_params"
METRICS = "run_metrics"
VERSIONS = "model_versions"
STAGES = "stage_events"

SCHEMAS = {
    RUNS: "run_id string, experiment string, run_name string, status string, start_time timestamp, tags map<string,string>",
    PARAMS: "run_id string, key string, value string",
    METRICS: "run_id string, key string, value double",
    VERSIONS: "name string, version int, run_id string, registered_at timestamp, tags map<string,string>",
    STAGES: "name string, version int, stage string, event_time timestamp",
}

# Run status and stage names.
STATUS_OK = "FINISHED"
STAGE_STAGING, STAGE_PRODUCTION, STAGE_ARCHIVED = "Staging", "Production", "Archived"


class RunStore:
    """Append-only run tables under ``root`` (a shared folder on a cluster)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):  # nothing written yet
                return self.spark.createDataFrame([], SCHEMAS[name])
            raise

    def append(self, name: str, df: DataFrame) -> None:
        df.select(*[f.name for f in self.spark.createDataFrame([], SCHEMAS[name]).schema]).write.mode("append").parquet(self.path(name))

    def log_run(self, run_id: str, experiment: str, run_name: str, params: Mapping | None = None, metrics: Mapping | None = None,
                tags: Mapping | None = None, status: str = STATUS_OK, start_time: dt.datetime | None = None) -> None:
        """Record one run: its row, parameters (as text) and numeric metrics."""
        now = start_time or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        tags = {k: str(v) for k, v in (tags or {}).items()}
        self.append(RUNS, self.spark.createDataFrame([(run_id, experiment, run_name, status, now, tags)], SCHEMAS[RUNS]))
        if params:
            self.append(PARAMS, self.spark.createDataFrame([(run_id, k, str(v)) for k, v in params.items()], SCHEMAS[PARAMS]))
        if metrics:
            self.append(METRICS, self.spark.createDataFrame([(run_id, k, float(v)) for k, v in metrics.items()], SCHEMAS[METRICS]))

    def log_metrics_frame(self, run_id: str, metrics_row: DataFrame, prefix: str = "") -> None:
        """Store a one-row metrics DataFrame (computed on the cluster) without collecting it."""
        p = f"{prefix}_" if prefix else ""
        long = metrics_row.unpivot([], metrics_row.columns, "key", "value").select(
            F.lit(run_id).alias("run_id"), F.concat(F.lit(p), F.col("key")).alias("key"), F.col("value").cast("double").alias("value"))
        self.append(METRICS, long)


def metrics_wide(metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``run_id`` + one column per metric key."""
    return metrics.where(F.col("key").isin(*keys)).groupBy("run_id").pivot("key", list(keys)).agg(F.max("value"))


def best_runs(runs: DataFrame, metrics: DataFrame, metric: str = "test_roc_auc", n: int = 4, status: str = STATUS_OK,
              experiment: str | None = None) -> DataFrame:
    """Successful runs (of one experiment, when named) ordered by ``metric`` (best first), top ``n`` (H1). Raise when
    there is none."""
    if experiment is not None:
        runs = runs.where(F.col("experiment") == experiment)
    m = metrics.where(F.col("key") == metric).groupBy("run_id").agg(F.max("value").alias(metric))
    ok = runs.where(F.col("status") == status).join(m, "run_id")
    if ok.isEmpty():
        raise LookupError(f"no {status} runs with metric {metric}")
    return ok.orderBy(F.col(metric).desc(), "run_id").limit(n)


def register_versions(versions: DataFrame, candidates: DataFrame, order: Sequence[str] = ("registered_at", "run_id")) -> DataFrame:
    """New version rows for ``candidates(name, run_id, registered_at, …)``: next numbers after the highest
    existing version of each name, in registration order (``order``) (H2)."""
    top = versions.groupBy("name").agg(F.max("version").alias("_top"))
    w = Window.partitionBy("name").orderBy(*order)
    return (
        candidates.join(top, "name", "left")
        .withColumn("version", (F.coalesce(F.col("_top"), F.lit(0)) + F.row_number().over(w)).cast("int"))
        .drop("_top")
    )


def version_tags(model_type: str, roc_auc, f1, run_id, at=None):
    """Tag map: model type (a text or a column), test AUC and F1 to 4 places, registration time, run id (H3)."""
    at = at if at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return F.create_map(
        F.lit("model_type"), F.lit(model_type) if isinstance(model_type, str) else model_type,
        F.lit("test_roc_auc"), F.format_number(F.bround(roc_auc, 4), 4),
        F.lit("test_f1"), F.format_number(F.bround(f1, 4), 4),
        F.lit("registered_at"), at,
        F.lit("run_id"), run_id,
    )


def current_stages(events: DataFrame) -> DataFrame:
    """Latest stage per (name, version) (H4)."""
    return events.groupBy("name", "version").agg(F.max_by("stage", F.struct("event_time", "stage")).alias("stage"))


def promote(events: DataFrame, name: str, version: int, stage: str, at: dt.datetime) -> DataFrame:
    """Stage events for a transition: the promotion itself and, for Production, an ``Archived`` event
    for every other version of the model currently in Production (H4)."""
    spark = events.sparkSession
    new = spark.createDataFrame([(name, version, stage, at)], SCHEMAS[STAGES])
    if stage != STAGE_PRODUCTION:
        return new
    prod = current_stages(events).where((F.col("name") == name) & (F.col("version") != version) & (F.col("stage") == STAGE_PRODUCTION))
    archived = prod.select("name", "version", F.lit(STAGE_ARCHIVED).alias("stage"), F.lit(at).cast("timestamp").alias("event_time"))
    return new.unionByName(archived)


def model_card(runs: DataFrame, params: DataFrame, metrics: DataFrame, run_id: str) -> DataFrame:
    """One record for a run: identity, tags, metrics and parameters as maps (H6)."""
    r = runs.where(F.col("run_id") == run_id)
    m = metrics.where(F.col("run_id") == run_id).groupBy("run_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("metrics"))
    p = params.where(F.col("run_id") == run_id).groupBy("run_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("params"))
    return r.join(m, "run_id", "left").join(p, "run_id", "left")


def retrain_due(metrics: DataFrame, metric: str = "production_roc_auc", floor: float = 0.95) -> DataFrame:
    """Runs whose production metric fell below the floor (D-9)."""
    return metrics.where((F.col("key") == metric) & (F.col("value") < floor)).select("run_id", F.col("value").alias(metric))
