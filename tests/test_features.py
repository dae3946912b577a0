"""Feature building (FIXTURES F3, F4) and encodings."""

from pyspark.sql import functions as F

from veritab.operators import clean as C
from veritab.operators import features as FE
from veritab.operators.ml import build_preprocessor

F3_SCHEMA = "income_annum long, loan_amount long, residential_assets_value long, commercial_assets_value long, luxury_assets_value long, bank_asset_value long"


def test_add_financial_features_creates_expected_columns(spark):
    df = spark.createDataFrame([(100000, 50000, 10000, 5000, 8000, 3000), (0, 12000, -10, 1000, 500, 2000)], F3_SCHEMA)
    out = FE.add_financial_features(df).collect()
    for c in ["total_assets", "loan_to_income_ratio", "loan_to_assets_ratio", "net_worth_proxy"]:
        assert c in out[0].asDict()
    assert out[0]["total_assets"] == 26000
    assert out[1]["total_assets"] == 3500
    assert out[1]["loan_to_income_ratio"] == 0.0
    assert out[1]["loan_to_assets_ratio"] > 0
    assert out[0]["net_worth_proxy"] == 26000 - 50000


def test_ratios_are_zero_for_missing_denominators(spark):
    df = spark.createDataFrame([(None, 10, 0, 0, 0, 0)], F3_SCHEMA)
    r = FE.add_financial_features(df).first()
    assert r["loan_to_income_ratio"] == 0.0 and r["loan_to_assets_ratio"] == 0.0


def test_bands_are_right_closed_and_exclude_lowest_edge(spark):
    df = spark.createDataFrame([(300,), (301,), (450,), (451,), (900,), (901,)], "cibil_score int")
    edges, labels = [300, 450, 600, 700, 750, 900], ["a", "b", "c", "d", "e"]
    got = [r[0] for r in FE.add_bands(df, "cibil_score", edges, labels, "band").select("band").collect()]
    assert got == [None, "a", "a", "b", "e", None]


def test_dummies_drop_first_sorted_category(spark):
    df = spark.createDataFrame([("No",), ("Yes",), ("No",)], "self_employed string")
    out = FE.one_hot_dummies(df, "self_employed")
    assert out.columns == ["self_employed_Yes"]
    assert [r[0] for r in out.collect()] == [0, 1, 0]


def test_standardize_uses_population_std_and_zero_variance_gives_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = FE.standardize(df, ["a", "b"]).collect()
    assert abs(out[0]["a"] - (-1.224744871391589)) < 1e-12
    assert [r["b"] for r in out] == [0.0, 0.0, 0.0]


def test_flag_above_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert [r[0] for r in FE.flag_above_median(df, "x", "hi").select("hi").collect()] == [0, 0, 1, 1]


def test_split_features_target_drops_id_and_target(spark):
    df = spark.createDataFrame([(1, 1000, "Approved"), (2, 2000, "Rejected")], "loan_id long, income_annum long, loan_status string")
    feats, target = C.split_features_target(df, "loan_status")
    assert "loan_id" not in feats and "loan_status" not in feats and target == "loan_status"


def test_preprocessor_keeps_rows(spark):
    from pyspark.ml import Pipeline

    cols = ["no_of_dependents", "income_annum", "loan_amount", "loan_term", "cibil_score", "residential_assets_value",
            "commercial_assets_value", "luxury_assets_value", "bank_asset_value"]
    rows = [tuple([i + 1] * 9) + (10 * i, 0.5 * i, 0.1 * i, 5 - i, ["Graduate", "Not Graduate", "Graduate"][i], ["No", "Yes", "No"][i]) for i in range(3)]
    schema = ", ".join(f"{c} long" for c in cols) + ", total_assets long, loan_to_income_ratio double, loan_to_assets_ratio double, net_worth_proxy long, education string, self_employed string"
    df = spark.createDataFrame(rows, schema)
    num = cols + ["total_assets", "loan_to_income_ratio", "loan_to_assets_ratio", "net_worth_proxy"]
    model = Pipeline(stages=build_preprocessor(num, ["education", "self_employed"], 3)).fit(df)
    out = model.transform(df).select("features").collect()
    assert len(out) == 3 and out[0][0].size >= 1
    assert out[0][0].size == len(num) + 2  # one dummy kept per binary category
