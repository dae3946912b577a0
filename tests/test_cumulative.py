"""Distributed running totals and exact quantiles against local brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from veritab.operators.cumulative import exact_quantiles, row_ranks, running_totals


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_running_totals_match_cumsum(spark, buckets):
    rng = np.random.default_rng(7)
    g = rng.integers(0, 3, 500)
    order = rng.permutation(500).astype(float)
    v = rng.integers(0, 10, 500)
    df = spark.createDataFrame([(int(a), float(b), int(c)) for a, b, c in zip(g, order, v)], "g int, o double, v long")
    got = {(r["g"], r["o"]): (r["cum_v"], r["total_v"]) for r in running_totals(df, ["g"], "o", ["v"], buckets=buckets).collect()}
    for k in range(3):
        idx = np.argsort(order[g == k])
        cs = np.cumsum(v[g == k][idx])
        for o, c in zip(order[g == k][idx], cs):
            assert got[(k, o)] == (c, cs[-1])


def test_running_totals_without_groups(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("o"), F.lit(1).cast("long").alias("v"))
    r = {x["o"]: x["cum_v"] for x in running_totals(df, [], "o", ["v"], buckets=7).collect()}
    assert all(r[float(i)] == i for i in range(1, 101))


@pytest.mark.parametrize("n", [1, 2, 5, 101])
def test_exact_quantiles_match_numpy(spark, n):
    rng = np.random.default_rng(n)
    x = np.round(rng.normal(size=n) * 10, 1)  # ties on purpose
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    df = spark.createDataFrame([("a", float(v)) for v in x] + [("b", None)], "g string, v double")
    q = {r["g"]: r["quantiles"] for r in exact_quantiles(df, ["g"], "v", probs, buckets=4).collect()}
    assert "b" not in q
    assert np.allclose(q["a"], np.quantile(x, probs), rtol=0, atol=1e-9)


def test_row_ranks(spark):
    df = spark.createDataFrame([(k % 2, float(k * 7 % 23)) for k in range(20)], "g int, o double")
    got = {(r["g"], r["o"]): r["rank"] for r in row_ranks(df, ["g"], "o", buckets=3).collect()}
    for g in (0, 1):
        vals = sorted(o for (gg, o) in got if gg == g)
        assert [got[(g, o)] for o in vals] == list(range(1, len(vals) + 1))


def test_hot_group_is_split_and_matches_fast_path(spark):
    # One key holds most of the rows; force the bucketed path with a tiny single-task limit.
    rows = [("hot", float(i), 1) for i in range(3000)] + [("cold", float(i), 2) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, o double, v long").repartition(5)
    fast = {(r["g"], r["o"]): (r["cum_v"], r["total_v"]) for r in running_totals(df, ["g"], "o", ["v"]).collect()}
    split = running_totals(df, ["g"], "o", ["v"], single_task_rows=100)
    assert "_bucket" not in split.columns
    got = {(r["g"], r["o"]): (r["cum_v"], r["total_v"]) for r in split.collect()}
    assert got == fast
    assert got[("hot", 2999.0)] == (3000, 3000) and got[("cold", 49.0)] == (100, 100)


def test_quantiles_same_for_any_partitioning(spark):
    rng = np.random.default_rng(5)
    vals = [(int(g), float(v)) for g, v in zip(rng.integers(0, 4, 800), np.round(rng.exponential(size=800), 2))]
    df = spark.createDataFrame(vals, "g int, v double")
    a = {r["g"]: r["quantiles"] for r in exact_quantiles(df.repartition(1), ["g"], "v", [0.1, 0.5, 0.9]).collect()}
    b = {r["g"]: r["quantiles"] for r in exact_quantiles(df.repartition(9), ["g"], "v", [0.1, 0.5, 0.9], buckets=6).collect()}
    assert a == b


def test_quantiles_mix_small_and_hot_groups(spark, monkeypatch):
    # A hot group above the single-task limit takes the bucketed path, the others one weighted
    # percentile aggregate; a NULL group key stays its own group. All must equal numpy's quantiles.
    import veritab.operators.cumulative as C

    monkeypatch.setattr(C, "SINGLE_TASK_ROWS", 200)
    rng = np.random.default_rng(11)
    rows = [("hot", float(v)) for v in rng.integers(0, 5000, 4000)]
    rows += [("cold", float(v)) for v in rng.integers(0, 50, 300)]
    rows += [(None, float(v)) for v in rng.normal(size=40).round(3)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: r["quantiles"] for r in C.exact_quantiles(df, ["g"], "v", probs).collect()}
    for g in ("hot", "cold", None):
        exp = np.quantile([v for gg, v in rows if gg == g], probs)
        assert np.allclose(got[g], exp, rtol=0, atol=1e-9), g


def test_many_groups_take_the_single_task_path(spark):
    # Far more groups than any collected list would hold comfortably; only one count reaches the driver.
    df = spark.range(0, 60000).select((F.col("id") % 20000).alias("g"), F.col("id").cast("double").alias("o"), F.lit(1).alias("v"))
    out = running_totals(df, ["g"], "o", ["v"])
    assert out.where(F.col("cum_v") != F.col("total_v")).count() == 40000
    assert out.agg(F.max("total_v")).first()[0] == 3


def test_global_running_total_over_the_single_task_limit(spark):
    # No group keys and more rows than the single-task limit: the one global group is bucketed.
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).cast("double").alias("o"), F.lit(2).alias("v")).repartition(4)
    out = {r["o"]: (r["cum_v"], r["total_v"]) for r in running_totals(df, [], "o", ["v"], single_task_rows=500).collect()}
    assert len(out) == 5000
    assert all(out[float(i)] == (2 * (i + 1), 10000) for i in range(5000))


def test_hot_null_group_is_split_null_safely(spark):
    # The oversized group has a NULL key: the semi / anti split must match it null-safely.
    rows = [(None, float(i), 1) for i in range(1200)] + [("a", float(i), 3) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, o double, v long").repartition(3)
    got = {(r["g"], r["o"]): (r["cum_v"], r["total_v"]) for r in running_totals(df, ["g"], "o", ["v"], single_task_rows=100).collect()}
    assert len(got) == 1240
    assert got[(None, 1199.0)] == (1200, 1200) and got[(None, 0.0)] == (1, 1200)
    assert got[("a", 39.0)] == (120, 120)


def test_quantiles_are_bit_equal_for_any_forced_size(spark, monkeypatch):
    import veritab.operators.cumulative as C

    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(rng.integers(0, 3, 900), rng.lognormal(size=900) * 1e5)], "g int, v double")
    probs = [i / 37 for i in range(38)]
    want = None
    for limit in (1_000_000, 200, 7):
        monkeypatch.setattr(C, "SINGLE_TASK_ROWS", limit)
        got = {r["g"]: r["quantiles"] for r in C.exact_quantiles(df, ["g"], "v", probs).collect()}
        want = got if want is None else want
        assert got == want
