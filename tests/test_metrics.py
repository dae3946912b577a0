"""Classification metrics against brute-force definitions."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from veritab.operators import metrics as M


def brute_auc(y, s):
    pos = [a for a, t in zip(s, y) if t == 1]
    neg = [a for a, t in zip(s, y) if t == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def brute_ap(y, s):
    P = sum(y)
    ap = 0.0
    for t in sorted(set(s), reverse=True):
        sel = [yy for yy, ss in zip(y, s) if ss >= t]
        tp = sum(sel)
        dr = sum(yy for yy, ss in zip(y, s) if ss == t) / P
        ap += dr * tp / len(sel)
    return ap


def test_ranking_metrics_with_ties(spark):
    rng = np.random.default_rng(3)
    y = [int(v) for v in rng.integers(0, 2, 300)]
    s = [float(v) for v in np.round(rng.random(300), 1)]
    df = spark.createDataFrame(list(zip(y, s)), "y int, s double")
    r = M.ranking_metrics(df, "y", "s").first()
    assert r["roc_auc"] == pytest.approx(brute_auc(y, s), abs=1e-12)
    assert r["avg_precision"] == pytest.approx(brute_ap(y, s), abs=1e-12)


def test_grouped_ranking_metrics(spark):
    rows = [(g, int(i % 3 == 0), float((i * 7) % 11)) for g in ("a", "b") for i in range(40)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    got = {r["g"]: r["roc_auc"] for r in M.ranking_metrics(df, "y", "s", by=["g"]).collect()}
    for g in ("a", "b"):
        y = [r[1] for r in rows if r[0] == g]
        s = [r[2] for r in rows if r[0] == g]
        assert got[g] == pytest.approx(brute_auc(y, s))


def test_confusion_metrics_and_zero_division(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 1), (1, 1)], "y int, p int")
    r = M.classification_metrics(df, "y", "p", prefix="test").first()
    tp, fp, fn, tn = 2, 1, 1, 1
    assert r["test_accuracy"] == pytest.approx(3 / 5)
    assert r["test_precision"] == pytest.approx(2 / 3)
    assert r["test_recall"] == pytest.approx(2 / 3)
    assert r["test_f1"] == pytest.approx(2 / 3)
    mcc = (tp * tn - fp * fn) / np.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    assert r["test_mcc"] == pytest.approx(mcc)
    none = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    z = M.classification_metrics(none, "y", "p").first()
    assert z["precision"] == 0.0 and z["recall"] == 0.0 and z["f1"] == 0.0 and z["mcc"] == 0.0


def test_auc_null_when_one_class(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.4)], "y int, s double")
    assert M.ranking_metrics(df, "y", "s").first()["roc_auc"] is None


def test_per_class_recall_and_weights(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1), (0, 0)], "y int, p int")
    rec = {r["class"]: r["recall"] for r in M.per_class_recall(df, "y", "p").collect()}
    assert rec == {1: 0.5, 0: 0.75}
    w = {r["y"]: r["weight"] for r in M.balanced_class_weights(df, "y").collect()}
    assert w[1] == pytest.approx(6 / (2 * 2)) and w[0] == pytest.approx(6 / (2 * 4))
    assert M.add_balanced_weights(df, "y").where(F.col("weight").isNull()).count() == 0
