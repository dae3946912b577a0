"""Operators without a bound on columns or categories, and malformed CSV lines."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from veritab.operators import clean as C
from veritab.operators import features as FE
from veritab.operators import profile as P
from veritab.operators.ml import build_preprocessor
from veritab.sources import files


def _matrix(rows, n):
    return pd.DataFrame([(r["column_a"], r["column_b"], r["corr"]) for r in rows], columns=["a", "b", "c"]).pivot(index="a", columns="b", values="c").to_numpy(dtype=float)[:n, :n]


def test_correlations_of_500_columns_with_gaps(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 500)) @ np.diag(rng.uniform(0.1, 5, 500)) + 1e6
    x[:, 1] += x[:, 0]
    x[rng.random(x.shape) < 0.1] = np.nan
    names = [f"x{i:03d}" for i in range(500)]
    frame = pd.DataFrame(x, columns=names)
    got = _matrix(P.correlation_matrix_wide(spark.createDataFrame(frame).repartition(3), names, tile=128).collect(), 500)
    assert np.allclose(got, frame.corr().to_numpy(), atol=1e-8)


@pytest.mark.parametrize("pairs", [4, 1 << 20])
def test_wide_correlations_equal_the_narrow_ones(spark, pairs):
    rows = [(float(i), i * i % 7, 5.0, None if i % 3 else float(-i)) for i in range(40)] + [(None, 1, 5.0, None)]
    df = spark.createDataFrame(rows, "a double, b int, k double, g double")
    cols = ["a", "b", "k", "g"]
    key = lambda d: {(r["column_a"], r["column_b"]): r["corr"] for r in d.collect()}
    wide, narrow = key(P.correlation_matrix_wide(df, cols, tile=2, pairs_at_once=pairs)), key(P.correlation_matrix(df, cols))
    assert wide.keys() == narrow.keys()
    for pair, r in narrow.items():
        assert (wide[pair] is None) == (r is None) == ("k" in pair) and (r is None or wide[pair] == pytest.approx(r))


def test_wide_correlation_edges(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("inf"), 3.0), (2.0, 5.0)], "x double, y double")
    got = {(r["column_a"], r["column_b"]): r["corr"] for r in P.correlation_matrix_wide(df, ["x", "y"]).collect()}
    assert np.isnan(got["x", "y"]) and got["y", "y"] == 1.0
    assert all(r["corr"] is None for r in P.correlation_matrix_wide(df.limit(0), ["x", "y"]).collect())


def test_category_codes_of_many_values(spark):
    df = spark.range(300_000).select(F.concat(F.lit("v"), F.col("id") % 100_000).alias("c"), "id")
    codes = C.category_codes(df, "c")
    want = {v: i for i, v in enumerate(sorted(f"v{i}" for i in range(100_000)))}
    got = codes.toPandas()
    assert dict(zip(got["value"], got["code"])) == want and (got["n"] == 3).all()


def test_encode_categories(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("b", 4)], "c string, value int")
    codes = C.category_codes(df, "c")
    assert sorted((r["value"], r["c"]) for r in C.encode_categories(df, "c", codes).collect() if r["value"] != 3) == [(1, 1), (2, 0), (4, 1)]
    assert [r["c"] for r in C.encode_categories(df, "c", codes).where("value = 3").collect()] == [None]
    assert {r["value"]: r["code"] for r in C.category_codes(df, "c", descending=True).collect()} == {"b": 0, "a": 1}
    new = spark.createDataFrame([("z", 1)], df.schema)
    assert C.encode_categories(new, "c", codes, "e", unseen="null").collect()[0]["e"] is None
    with pytest.raises(Exception, match="unseen category"):
        C.encode_categories(new, "c", codes).collect()
    assert C.category_codes(df.limit(0), "c").count() == 0
    nan = spark.createDataFrame([(float("nan"),), (2.0,)], "x double")
    assert [tuple(r) for r in C.category_codes(nan, "x").collect()] == [(2.0, 0, 1)]


def test_too_many_dummies_raise(spark):
    with pytest.raises(ValueError, match="more than 5"):
        FE.category_values(spark.range(6), "id", most=5)


def test_preprocessor_lists():
    kinds = lambda stages: [type(s).__name__ for s in stages]
    assert "StandardScaler" in kinds(build_preprocessor()) and "OneHotEncoder" in kinds(build_preprocessor())
    assert "StandardScaler" not in kinds(build_preprocessor([], None)) and "OneHotEncoder" not in kinds(build_preprocessor(None, []))
    with pytest.raises(ValueError):
        build_preprocessor([], [])


def test_malformed_lines_go_to_quarantine(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("b , a,s\n1, 2,x\n3,4\n5,6,y,z\nno,7,w\n,8,\n9,oops,v\n")
    schema = StructType.fromDDL("a long, b long, s string")
    files.split_csv(spark, str(path), str(tmp_path / "good"), str(tmp_path / "bad"), schema)
    good = {tuple(r) for r in spark.read.parquet(str(tmp_path / "good")).select("a", "b", "s").collect()}
    bad = {(r["record"], r["problem"]) for r in spark.read.parquet(str(tmp_path / "bad")).collect()}
    assert good == {(2, 1, "x"), (8, None, None)}
    assert bad == {("3,4", "columns"), ("5,6,y,z", "columns"), ("no,7,w", "b"), ("9,oops,v", "a")}
