"""Binary-classification metrics as aggregations (E1–E9).

Confusion counts are one aggregate. ROC AUC (ties count half) and average precision (Σ ΔRecall ·
Precision over distinct thresholds) need cumulative positives/negatives in score order: scores are
pre-aggregated to ``(score, positives, negatives)`` and cumulated with distributed running totals,
never with an unpartitioned window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.operators.cumulative import running_totals
from veritab.operators.joins import join_null_safe


def _d(c: Column) -> Column:
    return c.cast("double")


def _rows_where(condition: Column, n: str | None) -> Column:
    """Rows that meet a condition; a row stands for as many as the column ``n`` says."""
    return F.count_if(condition) if n is None else F.coalesce(F.sum(F.when(condition, F.col(n))), F.lit(0))


def confusion_counts(df: DataFrame, y_true: str, y_pred: str, positive=1, by: Sequence[str] = (), n: str | None = None) -> DataFrame:
    y, p = F.col(y_true) == F.lit(positive), F.col(y_pred) == F.lit(positive)
    return df.groupBy(*by).agg(
        _rows_where(y & p, n).alias("tp"),
        _rows_where(~y & p, n).alias("fp"),
        _rows_where(y & ~p, n).alias("fn"),
        _rows_where(~y & ~p, n).alias("tn"),
    )


def _metric_cols(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    tp, fp, fn, tn = _d(tp), _d(fp), _d(fn), _d(tn)
    zero = F.lit(0.0)
    den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return {
        "accuracy": F.try_divide(tp + tn, tp + fp + fn + tn),
        "precision": F.coalesce(F.try_divide(tp, tp + fp), zero),
        "recall": F.coalesce(F.try_divide(tp, tp + fn), zero),
        "f1": F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero),
        "mcc": F.coalesce(F.try_divide(tp * tn - fp * fn, den), zero),
    }


def ranking_metrics(df: DataFrame, y_true: str, y_prob: str, positive=1, by: Sequence[str] = (), n: str | None = None) -> DataFrame:
    """``by…, roc_auc, avg_precision`` (NULL when a class is absent)."""
    by = list(by)
    y = F.col(y_true) == F.lit(positive)
    by_score = df.where(F.col(y_prob).isNotNull()).groupBy(*by, F.col(y_prob).cast("double").alias("_s")).agg(
        _rows_where(y, n).alias("_pos"), _rows_where(~y, n).alias("_neg")
    )
    rt = running_totals(by_score, by, "_s", ["_pos", "_neg"])
    P, N = _d(F.col("total__pos")), _d(F.col("total__neg"))
    pos, neg = _d(F.col("_pos")), _d(F.col("_neg"))
    neg_below = _d(F.col("cum__neg")) - neg
    tp_at = P - (_d(F.col("cum__pos")) - pos)  # positives scored >= s
    fp_at = N - (_d(F.col("cum__neg")) - neg)
    terms = rt.select(
        *by,
        (pos * (neg_below + 0.5 * neg)).alias("_auc"),
        F.when(pos > 0, pos * (tp_at / (tp_at + fp_at))).otherwise(0.0).alias("_ap"),
        P.alias("_P"),
        N.alias("_N"),
    )
    agg = terms.groupBy(*by).agg(F.sum("_auc").alias("_auc"), F.sum("_ap").alias("_ap"), F.max("_P").alias("_P"), F.max("_N").alias("_N"))
    ok = (F.col("_P") > 0) & (F.col("_N") > 0)
    return agg.select(
        *by,
        F.when(ok, F.col("_auc") / (F.col("_P") * F.col("_N"))).alias("roc_auc"),
        F.when(F.col("_P") > 0, F.col("_ap") / F.col("_P")).alias("avg_precision"),
    )


def classification_metrics(
    df: DataFrame, y_true: str, y_pred: str, y_prob: str | None = None, prefix: str = "", positive=1, by: Sequence[str] = (),
    n: str | None = None,
) -> DataFrame:
    """accuracy, precision, recall, f1, mcc (+ roc_auc, avg_precision when ``y_prob`` is given).

    One row, or one per ``by`` group. Zero denominators give 0 (MCC too). ``prefix`` prepends
    ``<prefix>_`` to every metric name. With ``n``, a row counts as often as that column says.
    """
    by = list(by)
    cm = confusion_counts(df, y_true, y_pred, positive, by, n)
    cols = _metric_cols(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    out = cm.select(*by, *[v.alias(k) for k, v in cols.items()])
    if y_prob is not None:
        rk = ranking_metrics(df, y_true, y_prob, positive, by, n)
        if by:
            out = join_null_safe(out, rk, by, "left")
        else:
            out = out.select(*out.columns, rk.select("roc_auc").scalar().alias("roc_auc"), rk.select("avg_precision").scalar().alias("avg_precision"))
    p = f"{prefix}_" if prefix else ""
    return out.select(*by, *[F.col(c).alias(p + c) for c in out.columns if c not in by])


def evaluation_report(df: DataFrame, y_true: str, y_pred: str, y_prob: str, positive=1) -> DataFrame:
    """The four headline numbers: accuracy, f1, recall, roc_auc."""
    return classification_metrics(df, y_true, y_pred, y_prob, positive=positive).select("accuracy", "f1", "recall", "roc_auc")


def per_class_recall(df: DataFrame, y_true: str, y_pred: str) -> DataFrame:
    """Recall of every class: ``(class, support, recall)``."""
    return df.where(F.col(y_true).isNotNull()).groupBy(F.col(y_true).alias("class")).agg(
        F.count(F.lit(1)).alias("support"),
        F.avg((F.col(y_pred) == F.col(y_true)).cast("double")).alias("recall"),
    )


BROADCAST_CLASSES = 100_000


def balanced_class_weights(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, weight)`` with weight = n_rows / (n_classes · n_class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.select(F.sum("n")).scalar()
    k = counts.select(F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", total / (k * F.col("n")))


def add_balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Per-row balanced class weight. The one-row-per-class table is written once and broadcast when measured
    small, so rows are not shuffled by their class."""
    w = balanced_class_weights(df, label).select(label, F.col("weight").alias(out)).checkpoint(eager=True)
    return df.join(F.broadcast(w) if w.count() <= BROADCAST_CLASSES else w, label, "left")
