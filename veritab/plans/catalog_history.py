"""Run-history queries (H1–H6, S7 tables) built from monthly evaluation runs over `orders`.

Each month of orders is one evaluation run of the stand-in scorer; its metrics come from one grouped
metrics job, and the registry queries operate on those run tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from veritab.operators import history as H
from veritab.operators import metrics as M
from veritab.plans.catalog_sampling import scored_orders
from veritab.plans.registry import register, table
from veritab.session import checkpoint_dir

MODEL = "credit_model"


def monthly_runs(spark, sf):
    """(runs, metrics) tables: one run per month with test_* metrics."""
    o = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    s = scored_orders(spark, sf).join(o, "o_orderkey")
    m = M.classification_metrics(s, "y", "yhat", "p", prefix="test", by=["month"])
    if checkpoint_dir(spark):
        # One small row per run feeds both the runs and the metrics table: evaluate it once.
        m = m.checkpoint(eager=True)
    run_id = F.concat(F.lit("run-"), F.col("month"))
    runs = m.select(
        run_id.alias("run_id"), F.lit("monthly_eval").alias("experiment"), F.col("month").alias("run_name"),
        F.lit(H.STATUS_OK).alias("status"), F.to_timestamp(F.concat(F.col("month"), F.lit("-01"))).alias("start_time"),
        F.create_map(F.lit("phase"), F.lit("evaluation")).alias("tags"),
    )
    keys = [c for c in m.columns if c != "month"]
    metrics = m.select(run_id.alias("run_id"), *keys).unpivot(["run_id"], keys, "key", "value")
    return runs, metrics


_MONTHLY_AUC_SQL = """WITH b AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(o_orderstatus = 'F' AS INTEGER) AS y,
  floor(o_totalprice / 5000.0) / 100.0 AS p FROM orders),
s AS (SELECT month, p, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM b GROUP BY ALL),
r AS (SELECT month, pos, neg, sum(neg) OVER (PARTITION BY month ORDER BY p ROWS UNBOUNDED PRECEDING) - neg AS neg_below FROM s),
a AS (SELECT 'run-' || month AS run_id,
  CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)) END AS auc FROM r GROUP BY month)"""


@register(
    "h1_best_runs_orders",
    _MONTHLY_AUC_SQL + "\nSELECT run_id, round(auc, 6) AS test_roc_auc FROM a ORDER BY auc DESC, run_id LIMIT 4",
)
def h1_best_runs_orders(spark, sf):
    runs, metrics = monthly_runs(spark, sf)
    return H.best_runs(runs, metrics, "test_roc_auc", 4).select("run_id", F.round("test_roc_auc", 6).alias("test_roc_auc"))


@register(
    "h2_h4_registry_stages_orders",
    _MONTHLY_AUC_SQL
    + f"""
SELECT '{MODEL}' AS name, CAST(rk AS INTEGER) AS version, run_id, CASE WHEN rk = 1 THEN 'Production' ELSE 'Staging' END AS stage
FROM (SELECT run_id, row_number() OVER (ORDER BY auc DESC, run_id) AS rk FROM a) WHERE rk <= 4""",
)
def h2_h4_registry_stages_orders(spark, sf):
    runs, metrics = monthly_runs(spark, sf)
    best = H.best_runs(runs, metrics, "test_roc_auc", 4)
    t0 = dt.datetime(2024, 1, 1)
    # `best` holds at most 4 rows, so ordering them in one window partition is bounded.
    rank_ts = F.timestamp_seconds(F.lit(int(t0.replace(tzinfo=dt.timezone.utc).timestamp())) + F.row_number().over(
        Window.orderBy(F.col("test_roc_auc").desc(), "run_id")))
    candidates = best.select(F.lit(MODEL).alias("name"), "run_id", rank_ts.alias("registered_at"))
    existing = spark.createDataFrame([], H.SCHEMAS[H.VERSIONS])
    versions = H.register_versions(existing, candidates)
    staged = versions.select("name", "version", F.lit(H.STAGE_STAGING).alias("stage"), F.col("registered_at").alias("event_time"))
    events = staged.unionByName(H.promote(staged, MODEL, 1, H.STAGE_PRODUCTION, dt.datetime(2024, 1, 2)))
    cur = H.current_stages(events)
    return versions.join(cur, ["name", "version"]).select("name", "version", "run_id", "stage")


@register("h6_model_card_orders")
def h6_model_card_orders(spark, sf):
    runs, metrics = monthly_runs(spark, sf)
    best = H.best_runs(runs, metrics, "test_roc_auc", 1).select("run_id").first()["run_id"]
    params = spark.createDataFrame([(best, "scorer", "price_band_score"), (best, "threshold", "0.5")], H.SCHEMAS[H.PARAMS])
    return H.model_card(runs, params, metrics, best)
