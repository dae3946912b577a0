"""Quantiles by selection: equal to sorting, whatever the brackets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from veritab.operators import cumulative as C

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]


def values(rng, kind, n):
    return {"normal": rng.normal(size=n), "ties": rng.integers(0, 9, n).astype(float), "hot": np.where(rng.random(n) < 0.6, 5.0, rng.normal(size=n)),
            "wide": 10.0 ** rng.integers(-300, 300, n) * rng.choice([-1, 1], n)}[kind]


@pytest.mark.parametrize("kind", ["normal", "ties", "hot", "wide"])
def test_equal_to_numpy(spark, monkeypatch, kind):
    monkeypatch.setattr(C, "SKETCH_SIZE", 64)
    monkeypatch.setattr(C, "_RANK_ERROR", 2 * 2.296 / 64**0.9021)
    rng = np.random.default_rng(7)
    groups = {"a": values(rng, kind, 20_000), "b": values(rng, kind, 3), "c": np.array([4.0]), None: values(rng, kind, 500)}
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [("a", None), ("a", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r["g"]: r["q"] for r in C.exact_quantiles(df, ["g"], "v", PROBS, out="q").collect()}
    assert set(got) == set(groups)
    for g, v in groups.items():
        s = np.sort(v)
        for q, p in zip(got[g], PROBS):
            h = (len(s) - 1) * p
            lo, hi = s[int(np.floor(h))], s[int(np.ceil(h))]
            assert q == lo + (hi - lo) * (h - np.floor(h))


def test_few_values_are_kept(spark):
    df = spark.range(200_000).select(F.rand(3).alias("v"))
    counts, most = C.bracketed_counts(df, [], "v", [0.1, 0.5, 0.9])
    kept = counts.count()
    assert kept < 0.05 * 200_000 and kept <= most
    assert counts.agg(F.sum("_n")).first()[0] == 200_000


def test_a_missed_bracket_is_counted_again(spark, monkeypatch):
    real = C._RANK_ERROR
    monkeypatch.setattr(C, "_RANK_ERROR", -0.2)  # brackets beside the ranks
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.rand(1).alias("v"))
    got = {r["g"]: r["quantiles"] for r in C.exact_quantiles(df, ["g"], "v", [0.3, 0.5]).collect()}
    monkeypatch.setattr(C, "_RANK_ERROR", real)
    assert got == {r["g"]: r["quantiles"] for r in C.exact_quantiles(df, ["g"], "v", [0.3, 0.5]).collect()}


def test_large_brackets_and_many_groups(spark, monkeypatch):
    df = spark.range(6000).select((F.col("id") % 2).alias("g"), F.rand(1).alias("v"))
    want = {r["g"]: r["quantiles"] for r in C.exact_quantiles(df, ["g"], "v", [0.0, 0.3, 1.0]).collect()}
    monkeypatch.setattr(C, "SINGLE_TASK_ROWS", 20)
    assert want == {r["g"]: r["quantiles"] for r in C.exact_quantiles(df, ["g"], "v", [0.0, 0.3, 1.0]).collect()}
    monkeypatch.setattr(C, "BRACKET_BYTES", 1)
    assert want == {r["g"]: r["quantiles"] for r in C.exact_quantiles(df, ["g"], "v", [0.0, 0.3, 1.0]).collect()}


def test_no_values(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert C.exact_quantiles(empty, ["g"], "v", [0.5]).count() == 0 and C.exact_quantiles(empty, [], "v", [0.5]).count() == 0
    assert spark.range(1).select(C.exact_quantile_column(empty, "v", 0.5).alias("q")).first()["q"] is None
