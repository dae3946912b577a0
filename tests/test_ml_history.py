"""Model training / scoring (FIXTURES F5) and run-history tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from veritab.operators import history as H
from veritab.operators import ml as ML
from tests.conftest import SF_SMALL
from veritab.plans.jobs import registry_job

NUM = ["no_of_dependents", "income_annum", "loan_amount", "loan_term", "cibil_score", "residential_assets_value",
       "commercial_assets_value", "luxury_assets_value", "bank_asset_value"]


@pytest.fixture(scope="module")
def loans(spark):
    i = F.col("id")
    return spark.range(60).select(
        (i + 1).alias("loan_id"), (i % 4).alias("no_of_dependents"),
        F.when(i % 3 != 0, "Graduate").otherwise("Not Graduate").alias("education"),
        F.when(i % 5 == 0, "Yes").otherwise("No").alias("self_employed"),
        (900000 + 15000 * i).alias("income_annum"), (300000 + 5000 * i).alias("loan_amount"), (10 + i % 6).alias("loan_term"),
        F.when(i % 2 == 0, 740).otherwise(540).alias("cibil_score"), (400000 + 10000 * i).alias("residential_assets_value"),
        (200000 + 8000 * i).alias("commercial_assets_value"), (100000 + 6000 * i).alias("luxury_assets_value"),
        (150000 + 7000 * i).alias("bank_asset_value"), F.when(i % 2 == 0, "Approved").otherwise("Rejected").alias("loan_status"),
    )


def test_baseline_models_return_metrics(loans):
    res = ML.train_baseline_models(loans, "loan_status", ["loan_id"], NUM, ["education", "self_employed"])
    rows = {r["model"]: r.asDict() for r in res["metrics"].collect()}
    assert set(rows) == {"logistic_regression", "random_forest"}
    for m in rows.values():
        assert set(m) == {"model", "accuracy", "f1", "recall", "roc_auc"}
        assert m["roc_auc"] > 0.9  # the score column separates the classes
    assert res["test_size"] > 0


def test_train_model_cv_and_scoring(spark, loans):
    lab = ML.prepare_labelled(loans, "loan_status", "Approved", "Rejected")
    r = ML.train_model("logistic_regression", lab, NUM, ["education"], ["loan_id"], k=3)
    assert 0.0 <= r.cv_auc_std and r.cv_auc_mean > 0.9
    scored = ML.score(r.model, lab, keep=["loan_id"])
    summ = ML.batch_summary(scored).first()
    assert summ["total"] == 60 and summ["approved"] + summ["rejected"] == 60
    assert set(scored.columns) == {"loan_id", "prediction", "approved", "probability", "label_text"}
    assert ML.score(r.model, lab, carry="cibil_score").where("score IS NULL OR approved <> (prediction = 1)").count() == 0
    with pytest.raises(ValueError):
        ML.make_estimator("nope")


def test_random_search_and_svm(spark, loans):
    lab = ML.prepare_labelled(loans, "loan_status", "Approved", "Rejected")
    params, auc, model, trials = ML.random_search("logistic_regression", lab, NUM, [], ["loan_id"], n_trials=2, k=3)
    assert len(trials) == 2 and auc == max(t[1] for t in trials)
    svm = ML.model_pipeline(ML.make_estimator("svm", {"C": 1.0}, 60), NUM, [], 60).fit(lab)
    ev = ML.evaluate_model(svm, lab).first()
    assert ev["roc_auc"] > 0.8


def test_run_store_and_registry(spark, tmp_path):
    store = H.RunStore(spark, str(tmp_path / "runs"))
    for i, auc in enumerate([0.91, 0.97, 0.95, 0.93, 0.99]):
        status = "FAILED" if i == 4 else H.STATUS_OK
        store.log_run(f"r{i}", "exp", f"run{i}", params={"C": i}, metrics={"test_roc_auc": auc, "test_f1": auc - 0.1}, status=status)
    best = [r["run_id"] for r in H.best_runs(store.read(H.RUNS), store.read(H.METRICS)).collect()]
    assert best == ["r1", "r2", "r3", "r0"]
    stages = {r["version"]: r["stage"] for r in registry_job(store, "m", at=dt.datetime(2024, 1, 1)).collect()}
    assert stages == {1: "Production", 2: "Staging", 3: "Staging", 4: "Staging"}
    # A second registration continues the numbering and archives the old Production version.
    stages2 = {r["version"]: r["stage"] for r in registry_job(store, "m", n=1, at=dt.datetime(2024, 2, 1)).collect()}
    assert stages2[5] == "Production" and stages2[1] == "Archived"
    tags = store.read(H.VERSIONS).where("version = 1").first()["tags"]
    assert tags["test_roc_auc"] == "0.9700" and tags["run_id"] == "r1"
    card = H.model_card(store.read(H.RUNS), store.read(H.PARAMS), store.read(H.METRICS), "r1").first()
    assert card["metrics"]["test_roc_auc"] == 0.97 and card["params"]["C"] == "1"
    with pytest.raises(LookupError):
        H.best_runs(store.read(H.RUNS), store.read(H.METRICS), "missing_metric")


def test_random_search_query_picks_best_trial(spark):
    import __spark_entry__ as E

    rows = E.queries()["m8_random_search_orders"](spark, SF_SMALL).collect()
    assert len(rows) == 30
    best = [r for r in rows if r["best"]]
    assert len(best) == 1
    assert best[0]["cv_auc_mean"] == max(r["cv_auc_mean"] for r in rows)
    assert all(0.0 <= r["cv_auc_mean"] <= 1.0 for r in rows)


def test_rank_models_orders_by_metric_then_name(spark):
    from veritab.operators.ml import rank_models

    df = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", None), ("d", 0.95)], "model string, roc_auc double")
    got = [(r["model"], r["rank"]) for r in rank_models(df).orderBy("rank").collect()]
    assert got == [("d", 1), ("a", 2), ("b", 3), ("c", 4)]


def test_checkpoint_dir_is_kept_when_set(spark):
    from veritab.session import ensure_checkpoint_dir

    before = spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == before
