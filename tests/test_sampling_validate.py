"""Sampling / splitting properties and validation gates with quarantine (FIXTURES F8)."""

import pytest
from pyspark.sql import functions as F

from veritab.operators import sampling as S
from veritab.operators import validate as V


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(0, 2000).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("y"))


def test_hash_sample_is_repeatable_and_sized(spark, labelled):
    a = S.hash_sample(labelled, 0.3, 42, ["k"])
    b = S.hash_sample(labelled.repartition(7), 0.3, 42, ["k"])
    assert sorted(r[0] for r in a.select("k").collect()) == sorted(r[0] for r in b.select("k").collect())
    assert 500 < a.count() < 700


@pytest.mark.parametrize("exact", [False, True])
def test_split_disjoint_complete_stratified(spark, labelled, exact):
    s = S.stratified_split(labelled, "y", ["k"], 0.2, 42, exact=exact)
    assert s.count() == 2000 and s.select("k").distinct().count() == 2000
    counts = {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()}
    n1, n0 = 667, 1333
    if exact:
        assert counts[(1, "test")] == round(0.2 * n1) and counts[(0, "test")] == round(0.2 * n0)
    else:
        assert abs(counts[(1, "test")] / n1 - 0.2) < 0.05


def test_exact_folds_balanced_within_class(spark, labelled):
    f = S.stratified_folds(labelled, "y", ["k"], 5, 42, exact=True)
    sizes = f.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        c = [r["count"] for r in sizes if r["y"] == y]
        assert len(c) == 5 and max(c) - min(c) <= 1


def test_weighted_choice_shares(spark, labelled):
    d = labelled.select(S.weighted_choice(7, ["k"], ["A", "R"], [0.4, 0.6]).alias("c")).groupBy("c").count().collect()
    share = {r["c"]: r["count"] / 2000 for r in d}
    assert abs(share["A"] - 0.4) < 0.05


REQ = ("no_of_dependents int, income_annum double, loan_amount double, loan_term int, cibil_score int, "
       "residential_assets_value double, commercial_assets_value double, luxury_assets_value double, bank_asset_value double, "
       "education string, self_employed string")
GOOD = (2, 5800000.0, 12000000.0, 10, 720, 8000000.0, 2000000.0, 500000.0, 3000000.0, "Graduate", "No")


def test_quarantine_one_row_per_rule(spark):
    bad = []
    changes = [(0, 11), (1, 0.0), (2, -1.0), (3, 31), (4, 299), (5, -1.0), (6, -1.0), (7, -1.0), (8, -1.0), (9, "PhD"), (10, "Maybe"), (4, None)]
    for pos, val in changes:
        row = list(GOOD)
        row[pos] = val
        bad.append(tuple(row))
    df = spark.createDataFrame([GOOD, (GOOD[0],) + GOOD[1:9] + (" Not Graduate ", "Yes")] + bad, REQ)
    valid, quarantine = V.split_valid(df)
    assert valid.count() == 2
    got = [r["violations"] for r in quarantine.collect()]
    assert len(got) == len(changes) and all(len(v) == 1 for v in got)
    assert "cibil_score:required" in [v[0] for v in got]


def test_gates(spark):
    df = spark.createDataFrame([(1, 2.0), (2, -1.0)], "a long, b double")
    with pytest.raises(V.GateError, match="missing"):
        V.run_gates(df, ["a", "c"], ["a"])
    with pytest.raises(V.GateError, match="negative values in b"):
        V.run_gates(df, ["a", "b"], ["a", "b"])
    with pytest.raises(V.GateError, match="nulls"):
        V.run_gates(spark.createDataFrame([(None,)], "a long"), ["a"], ["a"], null_mode="total")


def test_batch_size_rule(spark):
    df = spark.range(0, 205).select((F.col("id") % 2).alias("req"))
    df = df.unionByName(spark.createDataFrame([(9,)], "req long"))
    got = {r["req"]: (r["n_records"], r["batch_ok"]) for r in V.batch_sizes(df, "req").collect()}
    assert got[0] == (103, False) and got[9] == (1, True)


def test_folds_and_exact_split_keep_null_label_rows(spark):
    from veritab.operators.sampling import stratified_folds, stratified_split

    rows = [(i, None if i % 10 == 0 else ("x" if i % 3 else "y")) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, lab string")
    folds = stratified_folds(df, "lab", ["k"], 5, 42, exact=True)
    assert folds.count() == 300
    per = {(r["lab"], r["fold"]): r["count"] for r in folds.groupBy("lab", "fold").count().collect()}
    assert sorted(v for (lab, _), v in per.items() if lab is None) == [6, 6, 6, 6, 6]
    split = stratified_split(df, "lab", ["k"], 0.2, 42, exact=True)
    assert split.count() == 300
    assert split.where(F.col("lab").isNull() & (F.col("split") == "test")).count() == 6
