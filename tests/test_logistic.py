"""Logistic regressions fitted in common passes against Spark's own, one fit at a time."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from veritab.operators import ml as ML


@pytest.fixture(scope="module")
def folded(spark):
    rng = np.random.default_rng(3)
    x, c = rng.normal(size=(1200, 2)) * [3.0, 50.0] + [1.0, 200.0], rng.integers(0, 3, 1200)
    y = (x[:, 0] + 0.02 * x[:, 1] + c + 2 * rng.normal(size=1200) > 6).astype(int)
    rows = [(i, float(x[i, 0]), float(x[i, 1]), "abc"[c[i]], int(y[i]), i % 3) for i in range(1200)]
    return spark.createDataFrame(rows, "id long, a double, b double, c string, label int, fold int").cache()


def test_folds_and_trials_match_single_fits(folded, monkeypatch):
    trials = [{"C": 0.05, "penalty": "l1"}, {"C": 0.02, "penalty": "l2"}, {}]
    fits = []
    single = ML.LogisticRegression.fit
    monkeypatch.setattr(ML.LogisticRegression, "fit", lambda *a, **k: fits.append(1) or single(*a, **k))
    scores, _ = ML.fold_scores("logistic_regression", trials, folded, ["a", "b"], ["c"], ["id"], 3)
    assert not fits  # no fit for every fold and trial
    got = {}
    for r in scores.groupBy("trial", "fold", "side").agg(F.count("*").alias("rows"), F.sort_array(F.collect_list("p")).alias("p")).collect():
        got[r["trial"], r["fold"], r["side"]] = r["p"]
    assert len(got) == 18
    for (i, f) in ((0, 1), (1, 2), (2, 0)):
        est = ML.make_estimator("logistic_regression", {**trials[i], "tol": 1e-12}, 1200)
        model = ML.model_pipeline(est, ["a", "b"], ["c"], 1200).fit(folded.where(F.col("fold") != f))
        p = [r[0] for r in model.transform(folded.where(F.col("fold") == f)).select(vector_to_array("probability")[1]).collect()]
        assert np.allclose(sorted(p), got[i, f, "val"], atol=1e-6)


def test_only_the_asked_side_is_scored(folded):
    scores, _ = ML.fold_scores("logistic_regression", [{}], folded, ["a", "b"], ["c"], ["id"], 3, sides=("val",))
    assert scores.count() == 1200 and {r["side"] for r in scores.select("side").distinct().collect()} == {"val"}


def test_one_class(folded):
    scores, _ = ML.fold_scores("logistic_regression", [{}], folded.where("label = 1"), ["a", "b"], ["c"], ["id"], 3, sides=("val",))
    assert {r["p"] for r in scores.select("p").distinct().collect()} == {1.0}


def test_svm_margin_without_a_column_of_random_features(folded):
    est = ML.make_estimator("svm", {"C": 1.0}, 1200)
    est.maxIter, est.n_components = 5, 20
    model = ML.model_pipeline(est, ["a", "b"], ["c"], 1200).fit(folded)
    own = model.stages[-1]
    src = model.transform(folded).drop("rawPrediction", "probability", "prediction")
    long = own.svm.transform(ML._rff(src, ML.FEATURES, own.W, own.b)).select("id", vector_to_array("rawPrediction")[1].alias("m"))
    short = ML._with_margin(src, ML.FEATURES, own.W, own.b, own.svm).select("id", vector_to_array("__m")[0].alias("m"))
    a, b = (np.array([r["m"] for r in d.orderBy("id").collect()]) for d in (long, short))
    assert len(a) == 1200 and np.allclose(a, b, atol=1e-12)
    assert "__rff" not in model.transform(folded).columns


def test_svms_of_all_folds_in_common_passes(folded, monkeypatch):
    """Every fold and trial as Spark's own linear SVM fits it on stored random features, one at a time."""
    from pyspark.ml.classification import LinearSVC, LinearSVCModel

    trials = [{"C": 1.0}, {"C": 0.2, "gamma": "auto"}]
    make = ML.make_estimator

    def small(*a, **k):
        est = make(*a, **k)
        est.maxIter, est.n_components = 12, 20
        return est

    monkeypatch.setattr(ML, "make_estimator", small)
    passes = []
    monkeypatch.setattr(ML.S, "_summed", lambda *a, own=ML.S._summed: passes.append(len(a[1])) or own(*a))
    scores, (whole, _) = ML.fold_scores("svm", trials, folded, ["a", "b"], ["c"], ["id"], 3, refit=True)
    assert max(passes) == 8 and len(passes) < 30  # not passes of their own for each of the eight models
    got = {(r["trial"], r["fold"], r["side"]): r["p"] for r in scores.groupBy("trial", "fold", "side").agg(F.sort_array(F.collect_list("p")).alias("p")).collect()}
    assert len(got) == 12
    for i, f in ((0, 1), (1, 2), (0, None)):
        est = small("svm", trials[i], 1200)
        used = folded if f is None else folded.where(F.col("fold") != f)
        pre = ML.Pipeline(stages=ML.build_preprocessor(["a", "b"], ["c"], 1200)).fit(used)
        src = pre.transform(used)
        d = 4
        var = src.select(F.explode(vector_to_array("features")).alias("v")).agg(F.var_pop("v")).first()[0]
        W, b = ML.S.random_projection(d, 20, 1 / d if i else 1 / (d * var), est.seed)
        svm = LinearSVC(featuresCol="__rff", regParam=1 / (est.C * 1200), maxIter=12).fit(ML._rff(src, "features", W, b))
        platt = ML.LogisticRegression(featuresCol="__m", maxIter=100).fit(ML._with_margin(src, "features", W, b, svm))
        if f is None:
            own = whole.stages[-1]
            assert isinstance(own.svm, LinearSVCModel) and np.allclose(own.svm.coefficients.toArray(), svm.coefficients.toArray(), atol=1e-8) and abs(own.svm.intercept - svm.intercept) < 1e-8
            continue
        val = pre.transform(folded.where(F.col("fold") == f))
        p = [r[0] for r in platt.transform(ML._with_margin(val, "features", W, b, svm)).select(vector_to_array("probability")[1]).collect()]
        assert np.allclose(sorted(p), got[i, f, "val"], atol=1e-6)


def test_svm_of_a_constant_feature(folded):
    est = ML.make_estimator("svm", {"C": 1.0})
    est.maxIter, est.n_components = 3, 5
    model = ML.model_pipeline(est, ["a"], [], None).fit(folded.withColumn("a", F.lit(7.0)))
    assert not model.stages[-1].svm.coefficients.toArray().any()


def test_validation_aucs_match_ranked_scores(folded, monkeypatch):
    trials = [{"C": 0.05, "penalty": "l1"}, {"C": 5.0}]
    tied = folded.withColumn("a", F.round("a")).withColumn("b", F.round(F.col("b") / 50))
    scores, _ = ML.fold_scores("logistic_regression", trials, tied, ["a", "b"], ["c"], ["id"], 3, sides=("val",))
    want = {(r["trial"], r["fold"]): r["roc_auc"] for r in ML.fold_metrics(scores).collect()}
    monkeypatch.setattr(ML, "LOGISTIC_TRIALS", 1)
    for part, held in ((1 << 19, 1 << 22), (37, 100)):
        monkeypatch.setattr(ML.L, "PART_SCORES", part)
        monkeypatch.setattr(ML.L, "SCORES_HELD", held)
        got = ML.logistic_search(trials, tied, ["a", "b"], ["c"], 3)
        assert all(abs(got[i][f] - want[i, f]) < 1e-12 for i in range(2) for f in range(3))
    assert ML.logistic_search(trials[:1], tied.where("label = 1"), ["a", "b"], ["c"], 3) == [[None] * 3]


def test_trials_of_a_fold_share_passes(folded, monkeypatch):
    """Weights of weakly penalised trials without passes of their own are those of fits one at a time."""
    rows = ML.FoldedRows(folded, ["a", "b"], ["c"], ["id"])
    rows.n = 10_000_000  # the penalties follow it
    trials = [{"C": 10.0 + i, "penalty": "l1" if i % 2 else "l2"} for i in range(6)]
    evaluated = []
    monkeypatch.setattr(ML.L, "_sums", lambda w, f, own=ML.L._sums: evaluated.append(len(w)) or own(w, f))
    asked = [(i, f) for i in range(6) for f in range(3)]
    weights = ML.logistic_folds(trials, asked, rows)
    assert max(evaluated) == 3  # one model a fold, not eighteen
    for m in (4, 17):
        i, f = asked[m]
        penalty = (1.0 / (trials[i]["C"] * 10_000_000), trials[i]["penalty"] == "l1")
        alone = ML.L.fit_folds(rows.blocks, [f], [penalty], 2, rows.factor)
        assert np.allclose(alone[0], weights[m], atol=1e-6)


def test_models_share_what_is_made_from_the_folds(folded, monkeypatch):
    rows = ML.FoldedRows(folded, ["a", "b"], ["c"], ["id"])
    made = []
    for module, name in ((ML.B, "block_table"), (ML.T, "binned_table")):
        monkeypatch.setattr(module, name, lambda *a, own=getattr(module, name), name=name, **k: made.append(name) or own(*a, **k))
    small = {"xgboost": {"n_estimators": 3}, "random_forest": {"n_estimators": 2, "max_depth": 2}, "logistic_regression": {}}
    shared = {m: ML.train_model(m, folded, ["a", "b"], ["c"], ["id"], p, 3, folded=rows).fold_scores for m, p in small.items()}
    tested = ML.run_experiment("logistic_regression", folded, folded, ["a", "b"], ["c"], ["id"], {}, 3, folded=rows)[1]
    val = {r["metric"]: r["val_mean"] for r in tested.collect()}
    assert abs(val["roc_auc"] - np.mean(shared["logistic_regression"])) < 1e-12 and len(val) == 5
    assert sorted(made) == ["binned_table", "block_table"]
    rows.drop()
    own, _ = ML.fold_scores("xgboost", [small["xgboost"]], folded, ["a", "b"], ["c"], ["id"], 3)
    alone = [r["roc_auc"] for r in ML.fold_metrics(own).where("side = 'val'").orderBy("fold").collect()]
    assert np.allclose(alone, shared["xgboost"], atol=1e-12)
