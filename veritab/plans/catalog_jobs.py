"""Queries for the composed jobs and sinks (S1, S3, S5, S7, D-6, D-9, M4, M7, H5).

Writing queries put their output in a fresh folder under the shared checkpoint folder and read it back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from veritab.operators import history as H
from veritab.operators import ml as ML
from veritab.plans import jobs as J
from veritab.plans.catalog_drift import DRIFT_ORDERS_SQL, _cur, _ref
from veritab.plans.catalog_history import _MONTHLY_AUC_SQL, monthly_runs
from veritab.operators.sampling import stratified_folds
from veritab.plans.catalog_ml import CATEGORICAL, KEYS, NUMERIC, PARAMS, _split
from veritab.plans.catalog_sampling import HASH15, scored_orders
from veritab.plans.catalog_quality import CUSTOMER_SPEC
from veritab.plans.oracle_sql import STRIP, tvd_sql
from veritab.plans.registry import register, table
from veritab.plans.scratch import scratch_path
from veritab.sources import files

CUSTOMER_SCHEMA = StructType([
    StructField("c_custkey", LongType()), StructField("c_name", StringType()), StructField("c_nationkey", IntegerType()),
    StructField("c_acctbal", DoubleType()), StructField("c_mktsegment", StringType()),
])


def customer_csv(spark, sf) -> str:
    path = scratch_path(spark, "customer-csv")
    files.write_table(table(spark, sf, "customer"), path, fmt="csv")
    return path


@register("s1_s3_csv_roundtrip_customer", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s1_s3_csv_roundtrip_customer(spark, sf):
    return files.read_csv(spark, customer_csv(spark, sf), CUSTOMER_SCHEMA)


_LINE = "concat_ws(',', CAST(o_orderkey AS {t}), {cust}, o_orderstatus{last})"
_CUST = "CASE WHEN o_orderkey % 29 = 0 THEN 'n/a' ELSE CAST(o_custkey AS {t}) END"


def _damaged_line(text_type: str) -> str:
    """Orders as CSV lines: some without the last field, some with one too many, some with a number that is none."""
    whole = _LINE.format(t=text_type, cust="CAST(o_custkey AS " + text_type + ")", last="{}")
    bad = _LINE.format(t=text_type, cust=_CUST.format(t=text_type), last=", o_orderpriority")
    return f"CASE WHEN o_orderkey % 17 = 0 THEN {whole.format('')} WHEN o_orderkey % 23 = 0 THEN {whole.format(', o_orderpriority')} || ',x' ELSE {bad} END"


@register(
    "s1_malformed_csv_orders",
    f"""WITH l AS (SELECT *, {_damaged_line('VARCHAR')} AS line, CASE WHEN o_orderkey % 17 = 0 OR o_orderkey % 23 = 0 THEN 'columns'
      WHEN o_orderkey % 29 = 0 THEN 'o_custkey' END AS problem FROM orders)
    SELECT 'valid' AS sink, o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(NULL AS VARCHAR) AS record, CAST(NULL AS VARCHAR) AS problem FROM l WHERE problem IS NULL
    UNION ALL SELECT 'quarantine', NULL, NULL, NULL, NULL, line, problem FROM l WHERE problem IS NOT NULL""",
)
def s1_malformed_csv_orders(spark, sf):
    source, valid, bad = (scratch_path(spark, n) for n in ("damaged", "valid", "quarantine"))
    table(spark, sf, "orders").select(F.expr(_damaged_line("STRING"))).write.text(source)
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"
    files.split_csv(spark, source, valid, bad, StructType.fromDDL(schema), header=False)
    good = spark.read.parquet(valid).withColumn("sink", F.lit("valid"))
    return good.unionByName(spark.read.parquet(bad).withColumn("sink", F.lit("quarantine")), allowMissingColumns=True)


@register(
    "s5_etl_job_customer",
    f"""SELECT {STRIP.format(c='c_name')} AS c_name, c_nationkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal,
  CAST(dense_rank() OVER (ORDER BY {STRIP.format(c='c_mktsegment')}) - 1 AS INTEGER) AS c_mktsegment FROM customer""",
)
def s5_etl_job_customer(spark, sf):
    spec = CUSTOMER_SPEC.with_(categorical=["c_name"])
    out, _ = J.run_etl(spark, customer_csv(spark, sf), scratch_path(spark, "etl-out"), spec, schema=CUSTOMER_SCHEMA)
    return out


@register("d6_monitoring_snapshot_orders")
def d6_monitoring_snapshot_orders(spark, sf):
    from veritab.plans.catalog_drift import CAT, NUM, orders_split

    ref, cur = orders_split(spark, sf)
    spec = CUSTOMER_SPEC.with_(target="o_orderstatus", numeric=NUM, categorical=CAT)
    return J.monitoring_snapshot(ref, cur, spec, out_path=scratch_path(spark, "snapshot"))


_SNAPSHOT_SQL = f"""WITH rep AS ({DRIFT_ORDERS_SQL}), p AS ({tvd_sql("o_orderstatus", _ref("o_orderstatus"), _cur("o_orderstatus"), threshold=0.1)})
SELECT CASE WHEN count_if(rep.drift_detected) > 0 THEN 'drift_detectado' ELSE 'estable' END AS status, count(*) AS total, CAST(count_if(rep.drift_detected) AS BIGINT) AS with_drift,
  round(count_if(rep.drift_detected) / count(*), 4) AS drift_ratio, string_agg(feature, ',' ORDER BY feature) FILTER (method = 'PSI') AS numeric_features,
  string_agg(feature, ',' ORDER BY feature) FILTER (method = 'TVD') AS categorical_features, (SELECT CASE WHEN drift_detected THEN 'drift_detectado' ELSE 'estable' END FROM p) AS prediction_status,
  (SELECT score FROM p) AS prediction_score FROM rep"""


@register("d6_snapshot_fields_orders", _SNAPSHOT_SQL)
def d6_snapshot_fields_orders(spark, sf):
    """The monitoring snapshot's fields as one flat row."""
    s = d6_monitoring_snapshot_orders(spark, sf)
    names = lambda c: F.array_join(F.transform(c, lambda f: f["feature"]), ",")
    return s.select("status", F.col("summary.total_features_evaluated").alias("total"), F.col("summary.features_with_drift").alias("with_drift"), F.col("summary.drift_ratio").alias("drift_ratio"),
                    names("numeric_features").alias("numeric_features"), names("categorical_features").alias("categorical_features"),
                    F.col("prediction_drift.status").alias("prediction_status"), F.col("prediction_drift.score").alias("prediction_score"))


@register(
    "d9_retrain_due_orders",
    _MONTHLY_AUC_SQL
    + "\nSELECT run_id, round(auc, 6) AS test_roc_auc FROM a WHERE auc < 0.95",
)
def d9_retrain_due_orders(spark, sf):
    _, metrics = monthly_runs(spark, sf)
    return H.retrain_due(metrics, "test_roc_auc", 0.95).withColumn("test_roc_auc", F.round("test_roc_auc", 6))


@register("m4_svm_orders")
def m4_svm_orders(spark, sf):
    train, test = _split(spark, sf)
    n = train.count()
    m = ML.model_pipeline(ML.make_estimator("svm", {"C": 1.0}, n), NUMERIC, CATEGORICAL, n).fit(train)
    return ML.evaluate_model(m, test).select(F.lit("svm").alias("model"), "*")


@register("m7_cv_metrics_orders")
def m7_cv_metrics_orders(spark, sf):
    """All four models: cross-validated train and validation metrics, and metrics on the test split."""
    train, test = _split(spark, sf)
    folded = ML.FoldedRows(ML.fold_rows(train, KEYS), NUMERIC, CATEGORICAL, KEYS)
    out = None
    for name in ML.MODELS:
        rows = ML.run_experiment(name, train, test, NUMERIC, CATEGORICAL, KEYS, PARAMS[name], folded=folded)[1].select(F.lit(name).alias("model"), "*")
        out = rows if out is None else out.unionByName(rows)
    folded.drop()
    return out


_FOLD_SQL = f"""WITH s AS (SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS y, floor(o_totalprice / 5000.0) / 100.0 AS p FROM orders),
k AS (SELECT s.*, CAST((count(*) OVER (PARTITION BY y ORDER BY {HASH15.format(seed=42)}) - 1) % 5 AS INTEGER) AS own FROM s),
f AS (SELECT y, p, CAST(p > 0.5 AS INTEGER) AS yhat, fold, CASE WHEN own = fold THEN 'val' ELSE 'train' END AS side FROM k, (SELECT unnest(range(0, 5)) AS fold)),
c AS (SELECT fold, side, count_if(y = 1 AND yhat = 1) AS tp, count_if(y = 0 AND yhat = 1) AS fp, count_if(y = 1 AND yhat = 0) AS fn, count_if(y = 0 AND yhat = 0) AS tn FROM f GROUP BY ALL),
a AS (SELECT fold, side, p, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM f GROUP BY ALL),
r AS (SELECT *, sum(neg) OVER (PARTITION BY fold, side ORDER BY p ROWS UNBOUNDED PRECEDING) - neg AS below FROM a),
u AS (SELECT fold, side, sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS roc_auc FROM r GROUP BY ALL),
m AS (SELECT fold, side, (tp + tn) / (tp + fp + fn + tn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1, roc_auc FROM c JOIN u USING (fold, side)),
l AS (UNPIVOT m ON accuracy, precision, recall, f1, roc_auc INTO NAME metric VALUE value)
SELECT metric, round(avg(value) FILTER (side = 'train'), 6) AS train_mean, round(avg(value) FILTER (side = 'val'), 6) AS val_mean, round(stddev_pop(value) FILTER (side = 'val'), 6) AS val_std FROM l GROUP BY metric"""


@register("m7_fold_metrics_orders", _FOLD_SQL)
def m7_fold_metrics_orders(spark, sf):
    """The stand-in score evaluated over five folds from one long score table."""
    s = stratified_folds(scored_orders(spark, sf), "y", KEYS, ML.CV_FOLDS, ML.RANDOM_STATE, exact=True, out="own")
    long = s.select("y", "p", "own", F.explode(F.sequence(F.lit(0), F.lit(ML.CV_FOLDS - 1))).alias("fold"))
    long = long.select(F.lit(0).alias("trial"), "fold", F.when(F.col("own") == F.col("fold"), "val").otherwise("train").alias("side"), "y", "p")
    out = ML.cv_summary(ML.fold_metrics(long)).drop("trial")
    return out.select("metric", *[F.round(c, 6).alias(c) for c in ("train_mean", "val_mean", "val_std")])


@register(
    "h5_registry_job_orders",
    _MONTHLY_AUC_SQL
    + """
SELECT 'credit_model' AS name, CAST(rk AS INTEGER) AS version, CASE WHEN rk = 1 THEN 'Production' ELSE 'Staging' END AS stage
FROM (SELECT run_id, row_number() OVER (ORDER BY auc DESC, run_id) AS rk FROM a) WHERE rk <= 4""",
)
def h5_registry_job_orders(spark, sf):
    store = H.RunStore(spark, scratch_path(spark, "runs"))
    runs, metrics = monthly_runs(spark, sf)
    store.append(H.RUNS, runs)
    store.append(H.METRICS, metrics)
    out = J.registry_job(store, "credit_model", "test_roc_auc", 4, "price_band_score", at=dt.datetime(2024, 1, 1))
    return out.select("name", "version", "stage")


@register(
    "s6_load_and_clean_customer",
    f"""SELECT {STRIP.format(c='c_name')} AS c_name, c_nationkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal,
  CAST(dense_rank() OVER (ORDER BY {STRIP.format(c='c_mktsegment')}) - 1 AS INTEGER) AS c_mktsegment FROM customer""",
)
def s6_load_and_clean_customer(spark, sf):
    df, _ = J.load_and_clean(spark, customer_csv(spark, sf), CUSTOMER_SPEC, schema=CUSTOMER_SCHEMA)
    return df


def _padded_csv(spark, df, name: str) -> str:
    """Write ``df`` as headed CSV whose header names carry surrounding blanks (kept verbatim)."""
    path = scratch_path(spark, name)
    padded = df.select(*[F.col(c).alias(f"  {c} ") for c in df.columns])
    files.write_table(padded, path, fmt="csv", options={"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    return path


def _monitoring_inputs(spark, sf):
    from veritab.plans.catalog_drift import orders_split

    ref, cur = orders_split(spark, sf)
    cols = ["o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus"]
    return (files.read_monitoring_csv(spark, _padded_csv(spark, ref.select(*cols), "monitor-ref")),
            files.read_monitoring_csv(spark, _padded_csv(spark, cur.select(*cols), "monitor-cur")))


@register("s2_monitoring_csv_drift_orders", DRIFT_ORDERS_SQL)
def s2_monitoring_csv_drift_orders(spark, sf):
    """Reference and current tables read back from CSV with padded headers (names stripped, values as
    text), then the feature drift report."""
    from veritab.operators import drift as D
    from veritab.plans.catalog_drift import CAT, NUM

    ref, cur = _monitoring_inputs(spark, sf)
    report, _ = D.drift_report(ref, cur, NUM, CAT)
    return report


@register("s4_report_json_orders", DRIFT_ORDERS_SQL)
def s4_report_json_orders(spark, sf):
    """The snapshot report written as one JSON document, read back and flattened to feature rows."""
    from veritab.plans.catalog_drift import CAT, NUM, orders_split

    ref, cur = orders_split(spark, sf)
    spec = CUSTOMER_SPEC.with_(target="o_orderstatus", numeric=NUM, categorical=CAT)
    path = scratch_path(spark, "report-json")
    J.monitoring_snapshot(ref, cur, spec, out_path=path)
    doc = spark.read.json(path)
    rows = doc.select(F.explode(F.concat("numeric_features", "categorical_features")).alias("f"))
    return rows.select(
        F.col("f.feature").alias("feature"), F.col("f.method").alias("method"), F.col("f.score").cast("double").alias("score"),
        F.col("f.threshold").cast("double").alias("threshold"), F.col("f.drift_detected").alias("drift_detected"),
    )


@register(
    "s7_run_metrics_orders",
    _MONTHLY_AUC_SQL + "\nSELECT run_id, 'test_roc_auc' AS key, round(auc, 6) AS value FROM a",
)
def s7_run_metrics_orders(spark, sf):
    """Run rows and metrics appended to the run tables, read back: finished runs' test ROC AUC."""
    store = H.RunStore(spark, scratch_path(spark, "run-records"))
    runs, metrics = monthly_runs(spark, sf)
    store.append(H.RUNS, runs)
    store.append(H.METRICS, metrics)
    done = store.read(H.RUNS).where(F.col("status") == H.STATUS_OK).select("run_id")
    m = store.read(H.METRICS).where(F.col("key") == "test_roc_auc").join(done, "run_id", "left_semi")
    return m.select("run_id", "key", F.round("value", 6).alias("value"))


_MONTHLY_F1_SQL = """WITH b AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(o_orderstatus = 'F' AS INTEGER) AS y,
  CAST(floor(o_totalprice / 5000.0) / 100.0 >= 0.5 AS INTEGER) AS yhat FROM orders),
c AS (SELECT 'run-' || month AS run_id, count_if(y = 1 AND yhat = 1) AS tp, count_if(y = 0 AND yhat = 1) AS fp,
  count_if(y = 1 AND yhat = 0) AS fn FROM b GROUP BY month),
f AS (SELECT run_id, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1 FROM c)
SELECT run_id, round(f1, 6) AS test_f1, CAST(row_number() OVER (ORDER BY f1 DESC, run_id) AS INTEGER) AS rank FROM f"""


@register("m9_compare_runs_f1_orders", _MONTHLY_F1_SQL)
def m9_compare_runs_f1_orders(spark, sf):
    """All monthly runs ranked by test F1, best first (the baseline comparison ranks by F1)."""
    from veritab.operators.history import metrics_wide

    runs, metrics = monthly_runs(spark, sf)
    wide = metrics_wide(metrics.join(runs.select("run_id"), "run_id", "left_semi"), ["test_f1"])
    ranked = ML.rank_models(wide.withColumnRenamed("run_id", "model"), "test_f1")
    return ranked.select(F.col("model").alias("run_id"), F.round("test_f1", 6).alias("test_f1"), "rank")


@register("m8_random_search_orders")
def m8_random_search_orders(spark, sf):
    """Seeded random search over the logistic-regression space by cross-validated ROC AUC, best refit."""
    train, _ = _split(spark, sf)
    best, auc, _, trials = ML.random_search("logistic_regression", train, NUMERIC, CATEGORICAL, KEYS)  # 30 trials x 5 folds
    rows = [(i, str(sorted(p.items())), float(m), float(sd), p == best) for i, (p, m, sd) in enumerate(trials)]
    return spark.createDataFrame(rows, "trial int, params string, cv_auc_mean double, cv_auc_std double, best boolean")


@register("m8_tuned_model_orders")
def m8_tuned_model_orders(spark, sf):
    """Tuning of logistic regression over four trials: the best is refitted, tested and recorded, and the run records
    are read back: best parameters, ``cv_roc_auc_best``, ``n_trials`` and the test metrics."""
    train, test = _split(spark, sf)
    store = H.RunStore(spark, scratch_path(spark, "tuning"))
    ML.tune_model("logistic_regression", train, test, NUMERIC, CATEGORICAL, KEYS, n_trials=4, store=store)
    params = store.read(H.PARAMS).select("run_id", F.lit("param").alias("kind"), "key", "value")
    metrics = store.read(H.METRICS).select("run_id", F.lit("metric").alias("kind"), "key", F.round("value", 4).cast("string").alias("value"))
    return params.unionByName(metrics)
