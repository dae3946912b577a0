"""Quality report and fixes (ported assertions of the source's unit tests, FIXTURES F1/F2)."""

from pyspark.sql import functions as F

from veritab.operators import clean as C
from veritab.operators import quality as Q

F1_SCHEMA = ("loan_id long, income_annum long, loan_amount long, residential_assets_value long, "
             "commercial_assets_value long, luxury_assets_value long, bank_asset_value long, education string")
F1_ROWS = [(1, 1000, 500, -10, 0, 0, 0, "Graduate"), (1, 1000, 500, -10, 0, 0, 0, "Graduate"), (2, 2000, 1000, -20, 10, 5, 1, None)]


def _report(df):
    return {(r["metric"], r["column"]): r["value"] for r in Q.quality_report(df).collect()}


def test_quality_report_counts_duplicates_nulls_and_negatives(spark):
    rep = _report(spark.createDataFrame(F1_ROWS, F1_SCHEMA))
    assert rep[("rows", "*")] == 3
    assert rep[("columns", "*")] == 8
    assert rep[("duplicate_rows", "*")] == 1
    assert rep[("null_count", "education")] == 1
    assert rep[("negative_count", "residential_assets_value")] == 3


def test_quality_report_skips_absent_check_columns_and_counts_nan_as_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "income_annum double")
    rep = _report(df)
    assert rep[("null_count", "income_annum")] == 2
    assert ("negative_count", "loan_amount") not in rep


def test_apply_quality_fixes_clips_negative_residential_assets(spark):
    df = spark.createDataFrame([(-100,), (0,), (50,)], "residential_assets_value long")
    out = C.apply_quality_fixes(df)
    assert [r[0] for r in out.collect()] == [0, 0, 50]


def test_clip_keeps_missing_values_and_counts_negatives(spark):
    df = spark.createDataFrame([(-1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    out, counts = C.clip_negatives(df, ["x"])
    vals = [r[0] for r in out.collect()]
    assert vals[0] == 0.0 and vals[1] is None and vals[2] != vals[2] and vals[3] == 3.0
    assert counts.first()["negatives_x"] == 1


def test_strip_removes_tabs_and_newlines(spark):
    df = spark.createDataFrame([(" \tGraduate\n",)], "education string")
    assert C.strip_values(df, ["education"]).first()[0] == "Graduate"


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a")], "a int, b string")
    assert Q.duplicate_count(df).first()[0] == 1


def test_encode_target_sorted_and_mapped(spark):
    df = spark.createDataFrame([("Rejected",), ("Approved",), ("Other",)], "loan_status string")
    enc, model = C.encode_target_sorted(df.where(F.col("loan_status") != "Other"), "loan_status")
    assert sorted((r[0] for r in enc.collect())) == [0, 1]
    assert list(model.labels) == ["Approved", "Rejected"]
    mapped = [r[0] for r in C.map_target(df, "loan_status").collect()]
    assert mapped == [0, 1, None]


def test_etl_report_measures_before_and_after(spark):
    raw = spark.createDataFrame(F1_ROWS, F1_SCHEMA).withColumn("loan_status", F.lit("Approved"))
    df, _ = C.clip_negatives(raw.drop("loan_id"), ["residential_assets_value"])
    rep = {(r["metric"], r["column"]): r["value"] for r in Q.etl_report(raw, df, ["residential_assets_value", "income_annum"], "loan_status").collect()}
    assert rep[("negative_before", "residential_assets_value")] == 3
    assert ("negative_after", "residential_assets_value") not in rep
    assert rep[("rows_raw", "*")] == 3 and rep[("cols_raw", "*")] == 9
    assert rep[("duplicates", "*")] == 1
    assert rep[("target_balance", "loan_status")] == 1.0


def test_single_pass_etl_report_equals_report(spark):
    raw = spark.createDataFrame(F1_ROWS, F1_SCHEMA).withColumn("loan_status", F.lit("Approved"))
    num = ["residential_assets_value", "income_annum"]
    df, _ = C.clip_negatives(raw.drop("loan_id"), ["residential_assets_value"])
    tagged = Q.tag_raw_negatives(raw.drop("loan_id"), num)
    tagged, _ = C.clip_negatives(tagged, ["residential_assets_value"])
    a = {(r["metric"], r["column"]): r["value"] for r in Q.etl_report(raw, df, num, "loan_status").collect()}
    b = {(r["metric"], r["column"]): r["value"] for r in Q.etl_report_single_pass(tagged, num, "loan_status", len(raw.columns)).collect()}
    assert a == b


def test_duplicate_count_matches_pandas_with_nulls_nan_and_signed_zero(spark):
    import math

    import pandas as pd

    from veritab.operators.quality import duplicate_count

    rows = [(1, "a", 0.0), (1, "a", -0.0), (1, "a", 0.0), (None, "b", None), (None, "b", None), (2, None, math.nan),
            (2, None, math.nan), (3, "c", 1.5)] + [(i % 7, "k", float(i % 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "a long, b string, c double").repartition(3)
    got = duplicate_count(df).first()["duplicate_rows"]
    exp = int(pd.DataFrame(rows, columns=["a", "b", "c"]).duplicated().sum())
    assert got == exp
