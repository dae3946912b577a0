"""Drift monitoring (ported assertions of the source's monitoring tests, FIXTURES F6) plus values."""

import pytest
from pyspark.sql import functions as F

from veritab.operators import drift as D
from veritab.plans.jobs import monitoring_snapshot

# Inputs and expectations of the ported assertions.
COLS = {
    "income_annum": [500000, 600000, 700000, 800000, 900000, 1000000],
    "loan_amount": [200000, 250000, 300000, 350000, 400000, 450000],
    "cibil_score": [650, 680, 700, 720, 740, 760],
    "no_of_dependents": [0, 1, 2, 3, 0, 1],
    "loan_term": [5, 10, 15, 20, 10, 5],
    "residential_assets_value": [100000, 200000, 300000, 400000, 500000, 600000],
    "commercial_assets_value": [50000, 100000, 150000, 200000, 250000, 300000],
    "luxury_assets_value": [10000, 20000, 30000, 40000, 50000, 60000],
    "bank_asset_value": [80000, 90000, 100000, 110000, 120000, 130000],
}
TEXT = {
    "self_employed": ["No", "Yes", "No", "No", "Yes", "No"],
    "loan_status": ["Approved", "Rejected", "Approved", "Approved", "Rejected", "Approved"],
}


@pytest.fixture(scope="module")
def reference(spark):
    rows = []
    for i in range(30):
        j = i % 6
        rows.append(tuple(COLS[c][j] for c in COLS) + (["Graduate", "Not Graduate"][i % 2],) + tuple(TEXT[c][j] for c in TEXT))
    schema = ", ".join(f"{c} long" for c in COLS) + ", education string, self_employed string, loan_status string"
    return spark.createDataFrame(rows, schema)


def _report(ref, cur, **kw):
    rep, missing = D.drift_report(ref, cur, **kw)
    summ = D.drift_summary(rep, missing).first()
    return {r["feature"]: r for r in rep.collect()}, summ


def test_stable_when_reference_equals_current(reference):
    rows, summ = _report(reference, reference)
    assert summ["status"] == "estable"
    assert summ["features_with_drift"] == 0
    assert summ["drift_ratio"] == 0.0
    assert summ["total_features_evaluated"] == 11
    assert all(r["score"] == 0.0 for r in rows.values())


def test_numeric_drift_detected(reference):
    cur = reference.withColumn("cibil_score", F.col("cibil_score") * 10)
    rows, summ = _report(reference, cur)
    assert rows["cibil_score"]["method"] == "PSI"
    assert rows["cibil_score"]["drift_detected"] is True
    assert rows["cibil_score"]["score"] == pytest.approx(12.254805, abs=1e-6)


def test_out_of_range_current_values_are_dropped(reference):
    cur = reference.unionByName(reference.withColumn("cibil_score", F.col("cibil_score") * 10))
    rows, _ = _report(reference, cur)
    assert rows["cibil_score"]["score"] == 0.0


def test_categorical_drift_detected(reference):
    rows, _ = _report(reference, reference.withColumn("self_employed", F.lit("Yes")))
    assert rows["self_employed"]["method"] == "TVD"
    assert rows["self_employed"]["drift_detected"] is True


def test_report_structure_and_missing_columns(reference):
    rep, missing = D.drift_report(reference, reference.drop("loan_term"), ["cibil_score", "loan_term", "nope"], ["education"])
    assert set(rep.columns) == {"feature", "method", "score", "threshold", "drift_detected"}
    s = D.drift_summary(rep, missing).first()
    assert s["missing_columns"] == ["loan_term", "nope"]
    assert {"status", "total_features_evaluated", "features_with_drift", "drift_ratio"} <= set(s.asDict())


def test_reference_deciles_are_the_edges(spark, reference):
    from veritab.operators.cumulative import exact_quantiles

    long = reference.select(F.lit("c").alias("feature"), F.col("cibil_score").cast("double").alias("value"))
    q = exact_quantiles(long, ["feature"], "value", [i / 10 for i in range(11)]).first()["quantiles"]
    assert sorted(set(q)) == [650.0, 680.0, 700.0, 710.0, 720.0, 740.0, 760.0]


def test_prediction_drift_stable(reference):
    r = D.prediction_drift(reference, reference).first()
    assert r["status"] == "estable" and r["score"] < 0.10


def test_prediction_drift_detected(reference):
    r = D.prediction_drift(reference, reference.withColumn("loan_status", F.lit("Rejected"))).first()
    assert r["status"] == "drift_detectado" and r["drift_detected"] is True and r["score"] >= 0.10
    assert r["reference_distribution"]["Approved"] == pytest.approx(20 / 30)
    assert r["current_distribution"]["Approved"] == 0.0


def test_prediction_drift_unavailable_without_target(reference):
    r = D.prediction_drift(reference, reference.drop("loan_status")).first()
    assert r["status"] == "no_disponible" and r["score"] is None and r["reason"]
    assert r["reference_distribution"]["Rejected"] == pytest.approx(10 / 30)
    r2 = D.prediction_drift(reference.drop("loan_status"), reference).first()
    assert r2["status"] == "no_disponible" and r2["score"] is None


def test_tvd_properties(spark, reference):
    a = reference.select("education")
    b = reference.select(F.when(F.col("education") == "Graduate", None).otherwise(F.col("education")).alias("education"))
    ab = D.tvd_scores(a, b, ["education"]).first()["score"]
    ba = D.tvd_scores(b, a, ["education"]).first()["score"]
    assert ab == pytest.approx(ba) and 0.0 <= ab <= 1.0
    assert ab == pytest.approx(0.5)  # missing values form their own <NA> category


def test_psi_by_run_matches_single_runs(spark, reference):
    cur = reference.withColumn("run", F.lit("a")).unionByName(
        reference.withColumn("cibil_score", F.col("cibil_score") * 10).withColumn("run", F.lit("b")))
    rep, _ = D.drift_report(reference, cur, ["cibil_score"], ["self_employed"], by=["run"])
    got = {(r["run"], r["feature"]): r["score"] for r in rep.collect()}
    assert got[("a", "cibil_score")] == 0.0
    assert got[("b", "cibil_score")] == pytest.approx(12.254805, abs=1e-6)
    assert got[("a", "self_employed")] == 0.0


def test_decisions_from_history(spark):
    rows = [("m1", "a", True), ("m1", "b", False), ("m2", "a", True), ("m2", "b", False), ("m3", "a", False), ("m3", "b", False),
            ("m4", "a", True), ("m4", "b", True)]
    rep = spark.createDataFrame(rows, "run string, feature string, drift_detected boolean")
    d = {r["run"]: r["decision"] for r in D.drift_decisions(rep, ["run"], ["a"]).collect()}
    assert d == {"m1": "incident", "m2": "incident", "m3": "keep", "m4": "incident"}
    d2 = {r["run"]: (r["retrain"], r["decision"]) for r in D.drift_decisions(rep, ["run"], ["a"], incident_ratio=0.9).collect()}
    assert d2["m2"] == (True, "retrain") and d2["m1"] == (False, "monitor") and d2["m4"] == (False, "incident")


def test_simulated_copy_changes_what_exists(spark, reference):
    ref = reference.withColumn("loan_id", F.monotonically_increasing_id())
    cur = D.simulate_drifted_copy(ref, ["loan_id"])
    r = cur.agg(F.min("cibil_score"), F.countDistinct("self_employed"), F.count("*")).first()
    assert r[0] >= 300 and r[1] == 1 and 0 < r[2] < 30
    assert set(cur.columns) == set(ref.columns)


def test_snapshot_report_row(spark, reference, tmp_path):
    out = monitoring_snapshot(reference, reference.withColumn("self_employed", F.lit("Yes")), out_path=str(tmp_path / "rep"))
    r = out.first()
    assert r["status"] == "drift_detectado"
    assert len(r["numeric_features"]) == 9 and len(r["categorical_features"]) == 2
    assert r["prediction_drift"]["status"] == "estable"
    back = spark.read.json(str(tmp_path / "rep")).first()
    assert back["summary"]["features_with_drift"] == 1


def test_report_same_for_any_partitioning(spark, reference):
    cur = reference.withColumn("cibil_score", F.col("cibil_score") + 15)
    a, _ = D.drift_report(reference.repartition(1), cur.repartition(1))
    b, _ = D.drift_report(reference.repartition(7), cur.repartition(5))
    key = lambda r: (r["feature"], r["method"])
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    assert any(r["feature"] == "cibil_score" and r["score"] > 0 for r in a.collect())
