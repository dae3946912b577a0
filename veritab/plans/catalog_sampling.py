"""Sampling, splitting and metric queries (R1–R4, E1–E9, M12) on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritab.operators import metrics as M
from veritab.operators import sampling as S
from veritab.plans.registry import register, table

HASH8 = "substr(md5(concat_ws('|', '{seed}', CAST(o_orderkey AS VARCHAR))), 1, 8)"
HASH15 = "substr(md5(concat_ws('|', '{seed}', CAST(o_orderkey AS VARCHAR))), 1, 15)"


@register("r1_hash_sample_orders", f"SELECT o_orderkey, o_totalprice FROM orders WHERE {HASH8.format(seed=42)} < '4ccccccc'")
def r1_hash_sample_orders(spark, sf):
    return S.hash_sample(table(spark, sf, "orders"), 0.30, 42, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@register(
    "r2_weighted_choice_orders",
    f"SELECT o_orderkey, CASE WHEN {HASH8.format(seed='42:target')} < '66666666' THEN 'Approved' ELSE 'Rejected' END AS drawn FROM orders",
)
def r2_weighted_choice_orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", S.weighted_choice("42:target", ["o_orderkey"], ["Approved", "Rejected"], [0.4, 0.6]).alias("drawn")
    )


@register(
    "r3_stratified_split_orders",
    f"SELECT o_orderkey, o_orderstatus, CASE WHEN {HASH8.format(seed=42)} < '33333333' THEN 'test' ELSE 'train' END AS split FROM orders",
)
def r3_stratified_split_orders(spark, sf):
    s = S.stratified_split(table(spark, sf, "orders"), "o_orderstatus", ["o_orderkey"], 0.2, 42)
    return s.select("o_orderkey", "o_orderstatus", "split")


@register(
    "r3_exact_stratified_split_orders",
    f"""SELECT o_orderkey, o_orderstatus,
  CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY {HASH15.format(seed=42)}, CAST(o_orderkey AS VARCHAR))
            <= floor(0.2 * count(*) OVER (PARTITION BY o_orderstatus) + 0.5) THEN 'test' ELSE 'train' END AS split
FROM orders""",
)
def r3_exact_stratified_split_orders(spark, sf):
    s = S.stratified_split(table(spark, sf, "orders"), "o_orderstatus", ["o_orderkey"], 0.2, 42, exact=True)
    return s.select("o_orderkey", "o_orderstatus", "split")


@register(
    "r4_stratified_folds_orders",
    f"""SELECT o_orderkey, o_orderstatus,
  CAST((count(*) OVER (PARTITION BY o_orderstatus ORDER BY {HASH15.format(seed=42)}) - 1) % 5 AS INTEGER) AS fold FROM orders""",
)
def r4_stratified_folds_orders(spark, sf):
    f = S.stratified_folds(table(spark, sf, "orders"), "o_orderstatus", ["o_orderkey"], 5, 42, exact=True)
    return f.select("o_orderkey", "o_orderstatus", "fold")


def scored_orders(spark, sf):
    """Stand-in for predictions: label = status F, score from price in 0.01 steps (many ties)."""
    o = table(spark, sf, "orders")
    p = F.floor(F.col("o_totalprice") / 5000.0) / 100.0
    return o.select(
        "o_orderkey",
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        p.alias("p"),
        (p >= 0.5).cast("int").alias("yhat"),
    )


_SCORED_SQL = """SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS y, floor(o_totalprice / 5000.0) / 100.0 AS p,
  CAST(floor(o_totalprice / 5000.0) / 100.0 >= 0.5 AS INTEGER) AS yhat FROM orders"""

E_SQL = f"""WITH b AS ({_SCORED_SQL}),
cm AS (SELECT CAST(count_if(y = 1 AND yhat = 1) AS DOUBLE) AS tp, CAST(count_if(y = 0 AND yhat = 1) AS DOUBLE) AS fp,
              CAST(count_if(y = 1 AND yhat = 0) AS DOUBLE) AS fn, CAST(count_if(y = 0 AND yhat = 0) AS DOUBLE) AS tn FROM b),
s AS (SELECT p, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM b GROUP BY p),
r AS (SELECT pos, neg, sum(neg) OVER (ORDER BY p ROWS UNBOUNDED PRECEDING) - neg AS neg_below,
             sum(pos) OVER (ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS tp_at,
             sum(neg) OVER (ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS fp_at FROM s),
rk AS (SELECT sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc,
              sum(CASE WHEN pos > 0 THEN pos * (tp_at / (tp_at + fp_at)) ELSE 0 END) / sum(pos) AS ap FROM r)
SELECT round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
       round(coalesce((tp * tn - fp * fn) / nullif(sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0), 6) AS mcc,
       round(auc, 6) AS roc_auc, round(ap, 6) AS avg_precision FROM cm, rk"""


@register("e1_e7_classification_metrics_orders", E_SQL)
def e1_e7_classification_metrics_orders(spark, sf):
    m = M.classification_metrics(scored_orders(spark, sf), "y", "yhat", "p")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@register(
    "e8_prefixed_metrics_orders",
    f"WITH m AS ({E_SQL}) SELECT accuracy AS test_accuracy, precision AS test_precision, recall AS test_recall, f1 AS test_f1, mcc AS test_mcc FROM m",
)
def e8_prefixed_metrics_orders(spark, sf):
    m = M.classification_metrics(scored_orders(spark, sf), "y", "yhat", prefix="test")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@register(
    "e9_per_class_recall_orders",
    f"WITH b AS ({_SCORED_SQL}) SELECT y AS class, count(*) AS support, round(avg(CAST(yhat = y AS DOUBLE)), 6) AS recall FROM b GROUP BY y",
)
def e9_per_class_recall_orders(spark, sf):
    r = M.per_class_recall(scored_orders(spark, sf), "y", "yhat")
    return r.withColumn("recall", F.round("recall", 6))


@register(
    "m12_balanced_weights_orders",
    """SELECT o_orderstatus, count(*) AS n, round((SELECT count(*) FROM orders) / ((SELECT count(DISTINCT o_orderstatus) FROM orders) * count(*)), 6) AS weight
FROM orders GROUP BY o_orderstatus""",
)
def m12_balanced_weights_orders(spark, sf):
    w = M.balanced_class_weights(table(spark, sf, "orders"), "o_orderstatus")
    return w.withColumn("weight", F.round("weight", 6))


_LABELS_SCORED_SQL = """SELECT l.doc_id, l.quality AS y, floor(d.n_chars * 1000.0 / (d.n_chars + 5000.0)) / 1000.0 AS p,
  CAST(floor(d.n_chars * 1000.0 / (d.n_chars + 5000.0)) / 1000.0 >= 0.5 AS INTEGER) AS yhat
FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""


def scored_documents(spark, sf):
    """Second stand-in: label = `labels.quality`, score = a monotone function of the document length
    (ties in 0.001 steps). Only `doc_id` and `n_chars` of `documents` are read."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    p = F.floor(F.col("n_chars") * 1000.0 / (F.col("n_chars") + 5000.0)) / 1000.0
    return table(spark, sf, "labels").join(d, "doc_id").select(
        "doc_id", F.col("quality").alias("y"), p.alias("p"), (p >= 0.5).cast("int").alias("yhat")
    )


@register("e1_e7_metrics_labels_documents", E_SQL.replace(_SCORED_SQL, _LABELS_SCORED_SQL))
def e1_e7_metrics_labels_documents(spark, sf):
    m = M.classification_metrics(scored_documents(spark, sf), "y", "yhat", "p")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])
