"""Profiling operators against pandas-style definitions."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from veritab.functions.stats import chi2_survival
from veritab.operators import profile as P


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"x": rng.gamma(2.0, 3.0, 400).round(2), "y": rng.normal(size=400), "g": rng.choice(["a", "b", "c"], 400)})
    return pdf, spark.createDataFrame(pdf)


def test_describe_matches_pandas(data):
    pdf, df = data
    d = P.describe(df, ["x"], by=["g"]).collect()
    for r in d:
        s = pdf[pdf.g == r["g"]].x.describe()
        assert r["count"] == s["count"] and r["mean"] == pytest.approx(s["mean"]) and r["std"] == pytest.approx(s["std"])
        assert (r["p25"], r["p50"], r["p75"]) == pytest.approx((s["25%"], s["50%"], s["75%"]))


def test_moments_match_pandas(data):
    pdf, df = data
    r = {x["column"]: x for x in P.moments(df, ["x", "y"]).collect()}
    assert r["x"]["skewness"] == pytest.approx(pdf.x.skew()) and r["x"]["kurtosis"] == pytest.approx(pdf.x.kurt())
    tiny = df.limit(3)
    assert P.moments(tiny, ["x"]).first()["kurtosis"] is None


def test_value_counts_and_majority(data):
    pdf, df = data
    vc = {r["value"]: r["share"] for r in P.value_counts(df, "g").collect()}
    exp = pdf.g.value_counts(normalize=True)
    assert all(vc[k] == pytest.approx(v) for k, v in exp.items())
    assert P.majority_share(df, "g").first()[0] == round(exp.iloc[0], 4)


def test_describe_categorical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "t string")
    r = P.describe_categorical(df, ["t"]).first()
    assert (r["count"], r["unique"], r["top"], r["freq"]) == (4, 2, "a", 2)


def test_chi2_plain_and_yates(spark):
    rows = [("x", "u")] * 10 + [("x", "v")] * 20 + [("y", "u")] * 15 + [("y", "v")] * 9
    df = spark.createDataFrame(rows, "a string, b string")
    r = P.chi2_independence(df, "a", "b", yates=False).first()
    assert r["statistic"] == pytest.approx(4.5621, abs=1e-4) and r["dof"] == 1
    o = np.array([[10, 20], [15, 9]], dtype=float)
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    yates = (((np.abs(o - e) - 0.5).clip(min=0)) ** 2 / e).sum()
    ry = P.chi2_independence(df, "a", "b").first()
    assert ry["statistic"] == pytest.approx(yates)
    assert ry["p_value"] == pytest.approx(math.erfc(math.sqrt(yates / 2)))


def test_chi2_survival_values():
    assert chi2_survival(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    y = 7.5
    assert chi2_survival(2 * y, 8) == pytest.approx(math.exp(-y) * sum(y**i / math.factorial(i) for i in range(4)))


def test_correlation_and_target(data):
    pdf, df = data
    c = {(r["column_a"], r["column_b"]): r["corr"] for r in P.correlation_matrix(df, ["x", "y"]).collect()}
    assert c[("x", "y")] == pytest.approx(pdf.x.corr(pdf.y)) and c[("y", "x")] == c[("x", "y")]
    t = P.target_correlation(df.withColumn("t", F.col("x") * 2 + F.col("y")), ["x", "y", "t"], "t").collect()
    assert [r["column"] for r in t][0] == "x"


def test_histogram_counts_every_value(data):
    pdf, df = data
    h = P.histogram(df, "x", 30).collect()
    assert len(h) == 30 and sum(r["count"] for r in h) == 400
    np_counts, _ = np.histogram(pdf.x, 30)
    assert [r["count"] for r in sorted(h, key=lambda r: r["bin"])] == list(np_counts)


def test_box_stats(data):
    pdf, df = data
    b = P.box_stats(df, "x").first()
    q1, q3 = np.quantile(pdf.x, [0.25, 0.75])
    hi = q3 + 1.5 * (q3 - q1)
    assert b["n_outliers"] == int((pdf.x > hi).sum() + (pdf.x < q1 - 1.5 * (q3 - q1)).sum())
    assert b["whisker_high"] == pdf.x[pdf.x <= hi].max()
    assert P.box_outliers(df, "x").count() == b["n_outliers"]


def test_crosstabs(spark):
    df = spark.createDataFrame([("a", "u"), ("a", "v"), ("a", "v"), ("b", "u")], "r string, c string")
    wide = {r["r"]: (r["u"], r["v"]) for r in P.crosstab(df, "r", "c").collect()}
    assert wide == {"a": (1, 2), "b": (1, 0)}
    pct = {(r["r"], r["c"]): r["percent"] for r in P.crosstab_row_percent(df, "r", "c").collect()}
    assert pct[("a", "v")] == pytest.approx(200 / 3)
    melted = P.melt(P.crosstab_row_percent_wide(df, "r", "c"), ["r"], "c", "percent")
    assert {(r["r"], r["c"]): r["percent"] for r in melted.collect()}[("b", "v")] == 0.0


def test_distinct_and_nulls(spark):
    from veritab.operators import quality as Q

    df = spark.createDataFrame([(1, None), (1, "a"), (2, "b")], "i int, s string")
    d = {r["column"]: r["n_unique"] for r in P.distinct_counts(df).collect()}
    assert d == {"i": 2, "s": 2}
    n = {r["column"]: r["nulls"] for r in Q.null_profile(df).collect()}
    assert n["s"] == 1 and n["*total"] == 1 and n["*rows_with_null"] == 1
    sp = Q.schema_profile(df).collect()
    assert [(r["column"], r["type"], r["non_null"]) for r in sp] == [("i", "int", 3), ("s", "string", 2)]


def test_grouped_describe_gives_null_group_its_quantiles(spark):
    import numpy as np

    from veritab.operators.profile import describe

    rows = [(None, float(i)) for i in range(11)] + [("a", float(i) * 2) for i in range(5)]
    d = {r["g"]: r for r in describe(spark.createDataFrame(rows, "g string, x double"), ["x"], by=["g"]).collect()}
    assert d[None]["count"] == 11 and d[None]["p50"] == 5.0 and d[None]["p25"] == float(np.quantile(range(11), 0.25))
    assert d["a"]["p75"] == 6.0


def test_value_counts_come_most_frequent_first(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "g string")
    assert [(r["value"], r["count"]) for r in P.value_counts(df, "g").collect()] == [("c", 2), ("a", 1), ("b", 1)]
