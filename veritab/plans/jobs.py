"""Composed jobs: ETL (S5), load-and-clean (S6), monitoring snapshot (D-6) and model registry (H5)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veritab.operators import clean as C
from veritab.operators import drift as D
from veritab.operators import history as H
from veritab.operators import quality as Q
from veritab.sources.files import read_csv, write_report_json, write_table
from veritab.spec import CREDIT_SPEC, TableSpec


def transform(raw: DataFrame, spec: TableSpec = CREDIT_SPEC, encode: bool = True):
    """Strip header names, drop ids, strip text values, clip configured negatives, encode the target by
    sorted class order. Returns (processed, report DataFrame, counts of the clipped values); the report
    is computed in one pass over the data."""
    named = C.strip_column_names(raw)
    df = C.drop_columns(named, spec.id_cols)
    tagged = Q.tag_raw_negatives(df, spec.numeric)
    tagged, counts = C.clean_table(tagged, spec)
    if encode:
        tagged, _ = C.encode_target_sorted(tagged, spec.target)
    report = Q.etl_report_single_pass(tagged, spec.numeric, spec.target, len(named.columns))
    processed = tagged.drop(*[c for c in tagged.columns if c.startswith(Q.RAW_FLAG)])
    return processed, report, counts


def run_etl(spark: SparkSession, data_path: str, output_path: str, spec: TableSpec = CREDIT_SPEC, fmt: str = "parquet",
            store: H.RunStore | None = None, schema=None) -> tuple[DataFrame, DataFrame]:
    """Extract → transform → load (→ record the run). Returns the written table (read back) and the report."""
    raw = read_csv(spark, data_path, schema) if schema is not None else read_csv(spark, data_path)
    processed, report, _ = transform(raw, spec)
    write_table(processed, output_path, fmt)
    written = spark.read.format(fmt).load(output_path) if fmt != "csv" else spark.read.option("header", True).csv(output_path)
    if store is not None:
        run_id = f"etl-{dt.datetime.now(dt.timezone.utc).strftime('%Y%m%d%H%M%S%f')}"
        store.log_run(run_id, "credit_approval/baseline", "etl", params={"source": data_path, "output": output_path},
                      tags={"phase": "etl", "status": "SUCCESS"})
        store.log_metrics_frame(run_id, report.select(F.concat_ws("::", "metric", "column").alias("k"), "value")
                                .groupBy().pivot("k").agg(F.first("value")))
    return written, report


def load_and_clean(spark: SparkSession, data_path: str, spec: TableSpec = CREDIT_SPEC, schema=None):
    """Read, drop ids, clean and label-encode the target; returns (DataFrame, fitted indexer)."""
    raw = read_csv(spark, data_path, schema) if schema is not None else read_csv(spark, data_path)
    df = C.drop_columns(C.strip_column_names(raw), spec.id_cols)
    df, _ = C.clean_table(df, spec)
    return C.encode_target_sorted(df, spec.target)


def monitoring_snapshot(reference: DataFrame, current: DataFrame, spec: TableSpec = CREDIT_SPEC, out_path: str | None = None,
                        numeric=None, categorical=None, quantile_method: str = "exact") -> DataFrame:
    """Feature drift + summary + prediction drift as one nested report row (written as JSON when a
    path is given). Feature rows are gathered per method: bounded by the number of features."""
    report, missing = D.drift_report(reference, current, numeric or spec.numeric, categorical or spec.categorical, spec,
                                     quantile_method=quantile_method)
    summary = D.drift_summary(report, missing)
    feat = F.struct("feature", "method", "score", "threshold", "drift_detected")
    rows = report.agg(
        F.array_sort(F.collect_list(F.when(F.col("method") == "PSI", feat))).alias("numeric_features"),
        F.array_sort(F.collect_list(F.when(F.col("method") == "TVD", feat))).alias("categorical_features"),
    )
    pred = D.prediction_drift(reference, current, spec.target)
    out = summary.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("generated_at_utc"),
        "status",
        F.struct("total_features_evaluated", "features_with_drift", "drift_ratio", "missing_columns").alias("summary"),
    )
    out = out.select("*", rows.select("numeric_features").scalar().alias("numeric_features"),
                     rows.select("categorical_features").scalar().alias("categorical_features"))
    out = out.select("*", pred.select(F.struct(*pred.columns)).scalar().alias("prediction_drift"))
    if out_path:
        write_report_json(out, out_path)
    return out


def registry_job(store: H.RunStore, model_name: str, metric: str = "test_roc_auc", n: int = 4,
                 model_type: str = "classifier", at: dt.datetime | None = None) -> DataFrame:
    """Register the top ``n`` runs as new versions, tag them, move all to Staging and the best to
    Production (archiving earlier Production versions); returns the current stages (H5)."""
    at = at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    runs, metrics = store.read(H.RUNS), store.read(H.METRICS)
    best = H.best_runs(runs, metrics, metric, n).cache()
    f1 = metrics.where(F.col("key") == metric.replace("roc_auc", "f1")).groupBy("run_id").agg(F.max("value").alias("_f1"))
    # `best` holds at most n rows: ranking them in one window partition is bounded.
    rank = F.row_number().over(Window.orderBy(F.col(metric).desc(), "run_id"))
    cands = best.join(f1, "run_id", "left").select(
        F.lit(model_name).alias("name"), "run_id", F.lit(at).cast("timestamp").alias("registered_at"), metric, "_f1", rank.alias("_rank"))
    versions = H.register_versions(store.read(H.VERSIONS), cands, ("registered_at", "_rank")).drop("_rank")
    tagged = versions.withColumn("tags", H.version_tags(model_type, F.col(metric), F.col("_f1"), F.col("run_id")))
    # Fix the (at most n) new rows before writing: appending to the versions folder would otherwise make
    # the lazy plan re-read it and number the versions again.
    spark = store.spark
    tagged = spark.createDataFrame(tagged.collect(), tagged.schema)
    store.append(H.VERSIONS, tagged)
    staged = tagged.select("name", "version", F.lit(H.STAGE_STAGING).alias("stage"), F.col("registered_at").alias("event_time"))
    store.append(H.STAGES, staged)
    top = tagged.orderBy(F.col(metric).desc(), "run_id").select("version").first()["version"]
    store.append(H.STAGES, H.promote(store.read(H.STAGES), model_name, int(top), H.STAGE_PRODUCTION, at + dt.timedelta(seconds=1)))
    best.unpersist()
    return H.current_stages(store.read(H.STAGES)).where(F.col("name") == model_name)
