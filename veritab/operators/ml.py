"""Distributed model building with ``pyspark.ml`` (T14–T17, M1–M12, A20, H7).

The preprocessor is a fitted ``Pipeline`` (indexers → one-hot → assembler → scaler → assembler) so
the same object scores batch and streaming DataFrames. Forests and boosting are the level-wise ensembles of
:mod:`veritab.operators.trees`; all folds and trials of a cross-validation grow in common passes. Metrics come from
:mod:`veritab.operators.metrics` (exact ROC AUC with ties, not the binned evaluator): all folds of all trials are scored
into one long table and evaluated by one grouped aggregate.
"""

from __future__ import annotations

import math
import random
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVCModel, LogisticRegression
from pyspark.ml.feature import ElementwiseProduct, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.operators import blocks as B
from veritab.operators import logistic as L
from veritab.operators import svm as S
from veritab.operators import trees as T
from veritab.operators.metrics import add_balanced_weights, classification_metrics, evaluation_report
from veritab.operators.sampling import stratified_folds, stratified_split
from veritab.plans.scratch import drop_path
from veritab.spec import CREDIT_SPEC

LABEL = "label"
FEATURES = "features"
RANDOM_STATE = 42

# Default estimator settings and search spaces of the source project.
RANDOM_FOREST_PARAMS = {"n_estimators": 100, "max_depth": 8}
XGBOOST_PARAMS = {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1}
LOGISTIC_REGRESSION_PARAMS = {"max_iter": 1000}
SEARCH_SPACES = {
    "random_forest": {"n_estimators": (50, 300), "max_depth": (3, 15), "min_samples_split": (2, 10),
                      "min_samples_leaf": (1, 5), "max_features": ["sqrt", "log2"]},
    "xgboost": {"n_estimators": (50, 300), "max_depth": (3, 10), "learning_rate": (0.01, 0.3), "subsample": (0.6, 1.0),
                "colsample_bytree": (0.6, 1.0), "reg_alpha": (0.0, 1.0), "reg_lambda": (0.5, 2.0)},
    "logistic_regression": {"C": (0.01, 10.0), "penalty": ["l1", "l2"], "solver": ["liblinear", "saga"]},
    "svm": {"C": (0.1, 10.0), "gamma": ["scale", "auto"], "kernel": ["rbf", "poly"]},
}
# Settings of the spaces above without a counterpart here: never sampled, never reported.
NOT_APPLIED = {"solver", "kernel"}
MODELS = ("random_forest", "xgboost", "logistic_regression", "svm")
CV_METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")
N_TRIALS = 30
CV_FOLDS = 5
FITS_AT_ONCE = 4  # probability fits of the SVM side by side
TEST_SIZE = 0.2


def build_preprocessor(numeric: Sequence[str] | None = None, categorical: Sequence[str] | None = None, n_rows: int | None = None, out: str = FEATURES) -> list:
    """None takes the credit table's own lists, ``[]`` means no column of that kind. Stages: standardise numerics (population std when ``n_rows`` is given), one-hot categoricals over
    sorted categories dropping the first (unseen categories raise), assemble into ``out``."""
    numeric = list(CREDIT_SPEC.numeric) if numeric is None else numeric
    categorical = list(CREDIT_SPEC.categorical) if categorical is None else categorical
    if not numeric and not categorical:
        raise ValueError("no column to assemble")
    stages: list = []
    parts: list[str] = []
    if numeric:
        stages.append(VectorAssembler(inputCols=list(numeric), outputCol="__num", handleInvalid="error"))
        stages.append(StandardScaler(inputCol="__num", outputCol="__num_z", withMean=True, withStd=True))
        last = "__num_z"
        if n_rows and n_rows > 1:
            f = math.sqrt(n_rows / (n_rows - 1))  # sample → population standard deviation
            stages.append(ElementwiseProduct(scalingVec=Vectors.dense([f] * len(numeric)), inputCol=last, outputCol="__num_pop"))
            last = "__num_pop"
        parts.append(last)
    if categorical:
        idx = [f"__{c}_idx" for c in categorical]
        ohe = [f"__{c}_ohe" for c in categorical]
        for c, i in zip(categorical, idx):
            # Descending order puts the alphabetically first category last, which dropLast removes.
            stages.append(StringIndexer(inputCol=c, outputCol=i, stringOrderType="alphabetDesc", handleInvalid="error"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True, handleInvalid="error"))
        parts += ohe
    stages.append(VectorAssembler(inputCols=parts, outputCol=out))
    return stages


class RffSvm(Estimator):
    """RBF-kernel SVM approximation: random Fourier features (cos(Wx + b)), a linear SVM, and a
    logistic (Platt) fit on the margin for probabilities. An approximation of a kernel SVC."""

    def __init__(self, n_components: int = 200, C: float = 1.0, gamma: str | float = "scale", n_train: int | None = None,
                 seed: int = RANDOM_STATE, featuresCol: str = FEATURES, labelCol: str = LABEL, maxIter: int = 100):
        super().__init__()
        self.n_components, self.C, self.gamma, self.n_train = n_components, C, gamma, n_train
        self.seed, self.featuresCol, self.labelCol, self.maxIter = seed, featuresCol, labelCol, maxIter

    def _fit(self, df: DataFrame) -> "RffSvmModel":
        table, path = B.block_table(df, self.featuresCol, self.labelCol)
        first = B.first_row(table)
        if first is None:
            raise ValueError("no row to fit on")
        maps, sizes, spreads = B.fold_maps(B.fold_moments(table), [None], 0, 1.0)
        projection = self.projection(maps[None], spreads[None], None)
        (coefficients, intercept), = S.fit_svms(table, [projection], [1.0 / (self.C * (self.n_train or sizes[None][0]))], first, self.maxIter)
        platt = _platt(S.margin_columns(table, [projection], [(coefficients, intercept)]), 0, None, self.labelCol)
        drop_path(df.sparkSession, path)
        return RffSvmModel(projection.W, projection.b, _linear_svc(coefficients, intercept), platt, self.featuresCol)

    def projection(self, on_rows: np.ndarray, spread: float, fold: int | None) -> S.Projection:
        """Random features for the rows that are not of ``fold``; ``on_rows`` maps the table's features to this fold's,
        whose entries have the variance ``spread``."""
        d = len(on_rows) - 1
        gamma = 1.0 / (d * (spread or 1.0)) if self.gamma == "scale" else 1.0 / d if self.gamma == "auto" else float(self.gamma)
        W, b = S.random_projection(d, self.n_components, gamma, self.seed)
        return S.Projection(W, b, 0.5 * on_rows.T @ np.vstack([np.array(W).T, b]), fold)


def _linear_svc(coefficients: np.ndarray, intercept: float) -> LinearSVCModel:
    model = LinearSVCModel(LinearSVCModel._new_java_obj("org.apache.spark.ml.classification.LinearSVCModel", f"LinearSVC_{uuid.uuid4().hex[:12]}", Vectors.dense(coefficients), intercept))
    return model.setFeaturesCol("__rff")


def _platt(margins: DataFrame, model: int, left_out: int | None, label: str = LABEL):
    """Logistic fit on the margins of one model, over the rows that are not of the fold ``left_out``."""
    used = margins if left_out is None else margins.where(F.col("fold") != left_out)
    used = used.select(F.col("y").alias(label), array_to_vector(F.array(F.col("m")[model])).alias("__m"))
    return LogisticRegression(featuresCol="__m", labelCol=label, regParam=0.0, maxIter=100).fit(used)


def _projection(W, b):
    """Random features of a batch of vectors, a row each."""
    w, shift, scale = np.array(W).T, np.array(b), math.sqrt(2.0 / len(W))
    return lambda x: scale * np.cos(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1) @ w + shift)


def _rff(df: DataFrame, col: str, W, b) -> DataFrame:
    """Add the random features of the vectors, a batch of rows at a time."""
    features, size = _projection(W, b), len(W)

    @F.arrow_udf("array<double>")
    def project(x: pa.Array) -> pa.Array:
        flat = features(x).ravel() if len(x) else np.zeros(0)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, size), pa.int32()), pa.array(flat))

    return df.withColumn("__rff", array_to_vector(project(vector_to_array(col))))


def _with_margin(df: DataFrame, col: str, W, b, svm) -> DataFrame:
    """Add the SVM's margin as a vector of one entry; the random features stay inside the tasks."""
    features, weights, intercept = _projection(W, b), svm.coefficients.toArray(), svm.intercept

    @F.arrow_udf("double")
    def margin(x: pa.Array) -> pa.Array:
        return pa.array(features(x) @ weights + intercept if len(x) else np.zeros(0))

    return df.withColumn("__m", array_to_vector(F.array(margin(vector_to_array(col)))))


class RffSvmModel(Model):
    def __init__(self, W, b, svm, platt, featuresCol):
        super().__init__()
        self.W, self.b, self.svm, self.platt, self.featuresCol = W, b, svm, platt, featuresCol

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = df.columns
        p = self.platt.transform(_with_margin(df, self.featuresCol, self.W, self.b, self.svm))
        return p.select(*cols, "rawPrediction", "probability", "prediction")


def tree_settings(name: str, params: Mapping):
    """Settings of a forest or of boosting from the parameter names of the search spaces."""
    known = {"random_forest": ("n_estimators", "max_depth", "min_samples_split", "min_samples_leaf", "max_features", "class_weight", "seed"),
             "xgboost": ("n_estimators", "max_depth", "learning_rate", "subsample", "colsample_bytree", "reg_alpha", "reg_lambda", "min_child_weight", "seed")}[name]
    unknown = sorted(set(params) - set(known))
    if unknown:
        raise ValueError(f"unknown settings of {name}: {unknown}")
    return (T.Forest if name == "random_forest" else T.Boosting)(**{"seed": RANDOM_STATE, **params})


def make_estimator(name: str, params: Mapping | None = None, n_train: int | None = None, weight_col: str | None = None, key_cols: Sequence[str] = ()):
    """Estimator for a model name of the source project; unknown names raise. ``key_cols`` name the rows for the row
    samples of forests and boosting."""
    params = dict(params or {})
    if name == "logistic_regression":
        C = float(params.get("C", 1.0))
        l1 = params.get("penalty", "l2") == "l1"
        lr = LogisticRegression(maxIter=int(params.get("max_iter", 1000)), standardization=False, tol=float(params.get("tol", 1e-6)),
                                regParam=(1.0 / (C * n_train)) if n_train else 0.0, elasticNetParam=1.0 if l1 else 0.0, featuresCol=FEATURES, labelCol=LABEL)
        return lr.setWeightCol(weight_col) if weight_col else lr
    if name in ("random_forest", "xgboost"):
        return T.TreeClassifier(tree_settings(name, params), FEATURES, LABEL, weight_col, key_cols)
    if name == "svm":
        return RffSvm(C=float(params.get("C", 1.0)), gamma=params.get("gamma", "scale"), n_train=n_train)
    raise ValueError(f"unknown model name: {name}")


def model_pipeline(estimator, numeric: Sequence[str], categorical: Sequence[str], n_rows: int | None = None) -> Pipeline:
    return Pipeline(stages=build_preprocessor(numeric, categorical, n_rows) + [estimator])


def positive_probability(df: DataFrame, prob_col: str = "probability", out: str = "p1") -> DataFrame:
    return df.withColumn(out, vector_to_array(prob_col)[1])


def evaluate_model(model, df: DataFrame, label: str = LABEL) -> DataFrame:
    """accuracy, f1, recall, roc_auc of a fitted model on labelled rows (one row)."""
    scored = positive_probability(model.transform(df)).withColumn("__pred", F.col("prediction").cast("int"))
    return evaluation_report(scored, label, "__pred", "p1")


def prepare_labelled(df: DataFrame, target: str, positive, negative) -> DataFrame:
    """Numeric label 1/0 from the target text; rows with another value take no part (:func:`unlabelled_rows`
    counts them, and the trainers report that number)."""
    lab = F.when(F.col(target) == F.lit(positive), F.lit(1)).when(F.col(target) == F.lit(negative), F.lit(0))
    return df.withColumn(LABEL, lab).where(F.col(LABEL).isNotNull())


def prepare_against_rest(df: DataFrame, target: str, positive) -> DataFrame:
    """Numeric label: 1 where the target is ``positive``, 0 where it is any other known value; rows without a target
    take no part."""
    return df.withColumn(LABEL, (F.col(target) == F.lit(positive)).cast("int")).where(F.col(LABEL).isNotNull())


def unlabelled_rows(df: DataFrame, target: str, positive, negative) -> int:
    """Rows whose target is neither value (or missing), which no model is trained or tested on."""
    named = F.col(target).isin(positive, negative)
    return df.agg(F.count_if(~F.coalesce(named, F.lit(False)))).first()[0]


def train_baseline_models(df: DataFrame, target: str, key_cols: Sequence[str], numeric: Sequence[str], categorical: Sequence[str],
                          positive="Approved", negative="Rejected", lr_params=None, rf_params=None) -> dict:
    """Logistic regression (balanced weights) and random forest (classes balanced in every tree's bag) baselines on a
    stratified 80/20 split.

    Returns ``models``, a ``metrics`` DataFrame ``(model, accuracy, f1, recall, roc_auc)`` and ``test_size``.
    """
    lab = prepare_labelled(df, target, positive, negative)
    split = stratified_split(lab, LABEL, key_cols, TEST_SIZE, RANDOM_STATE, exact=True).cache()
    train = add_balanced_weights(split.where(F.col("split") == "train"), LABEL, "__w")
    test = split.where(F.col("split") == "test")
    n_train = train.count()
    lr = make_estimator("logistic_regression", {"max_iter": 2000, **(lr_params or {})}, n_train, "__w")
    rf = make_estimator("random_forest", {"n_estimators": 300, "max_depth": None, "class_weight": "balanced_subsample", **(rf_params or {})}, key_cols=key_cols)
    models = {
        "logistic_regression": model_pipeline(lr, numeric, categorical, n_train).fit(train),
        "random_forest": model_pipeline(rf, numeric, categorical, n_train).fit(train),
    }
    metrics = None
    for name, m in models.items():
        row = evaluate_model(m, test).select(F.lit(name).alias("model"), "*")
        metrics = row if metrics is None else metrics.unionByName(row)
    return {"models": models, "metrics": metrics, "test_size": test.count(), "split": split,
            "unlabelled_rows": unlabelled_rows(df, target, positive, negative)}


class FoldedRows:
    """Rows with their ``fold``, and what the cross-validations of several models prepare from them: the number of rows,
    the fitted preprocessing, the binned table of the trees and the blocks of the linear models, each made once."""

    def __init__(self, rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], key_cols: Sequence[str]):
        self.rows, self.numeric, self.categorical, self.key_cols = rows, numeric, categorical, key_cols
        self.n = rows.count()
        self.paths: list[str] = []

    @cached_property
    def preprocessor(self) -> PipelineModel:
        return Pipeline(stages=build_preprocessor(self.numeric, self.categorical, self.n)).fit(self.rows)

    @cached_property
    def blocks(self) -> DataFrame:
        table, path = B.block_table(self.preprocessor.transform(self.rows), FEATURES, LABEL, "fold")
        self.paths.append(path)
        return table

    @cached_property
    def binned(self) -> tuple[DataFrame, list[list[float]]]:
        made = T.TreeClassifier(tree_settings("xgboost", {}), FEATURES, LABEL, None, self.key_cols)
        table, path, edges = made.prepare(self.preprocessor.transform(self.rows), "fold")
        self.paths.append(path)
        return table, edges

    @property
    def factor(self) -> float:
        """Sample to population deviation."""
        return math.sqrt(self.n / (self.n - 1)) if self.n > 1 else 1.0

    def drop(self) -> None:
        for path in self.paths:
            drop_path(self.rows.sparkSession, path)


def fold_scores(name: str, trials: Sequence[Mapping], folded: DataFrame | FoldedRows, numeric: Sequence[str], categorical: Sequence[str], key_cols: Sequence[str],
                k: int = CV_FOLDS, refit: bool = False, sides: Sequence[str] = ("train", "val")) -> tuple[DataFrame, list[PipelineModel]]:
    """``(trial, fold, side, y, p, n)``: every row of ``folded`` (with its ``fold``) scored by every trial's model of
    every fold; ``side`` is ``val`` for the rows the model was not fitted on, ``n`` the number of rows with that score
    that the row stands for; only rows of ``sides`` are scored. With ``refit``, also each trial's model fitted on all rows.

    All trials and folds of a forest or of boosting grow in common passes over one binned table and are scored in
    one pass. Their preprocessing is fitted once: cuts of a tree do not change under a per-fold scaling. Logistic
    regressions and SVMs of all trials and folds are likewise fitted in common passes, each under its fold's own scaling."""
    if not isinstance(folded, FoldedRows):
        folded = FoldedRows(folded, numeric, categorical, key_cols)
        try:
            return fold_scores(name, trials, folded, numeric, categorical, key_cols, k, refit, sides)
        finally:
            folded.drop()
    n, rows = folded.n, folded.rows
    wanted = [(i, f) for i in range(len(trials)) for f in [*range(k), *([None] if refit else [])]]
    if name in ("random_forest", "xgboost"):
        made = [T.TreeClassifier(tree_settings(name, p), FEATURES, LABEL, None, key_cols) for p in trials]
        if any(m.how.seed != RANDOM_STATE for m in made[:1]):  # the row draws follow the seed
            table, path, edges = made[0].prepare(folded.preprocessor.transform(rows), "fold")
            folded.paths.append(path)
        else:
            table, edges = folded.binned
        combined_rows, combined = T.combine(table, edges, [m.how for m in made])
        grown = T.grow(combined_rows, edges, [(made[i].how, f) for i, f in wanted], bagged=table)
        tested = [(g, w) for g, w in zip(grown, wanted) if w[1] is not None]
        scores = T.score_models(combined_rows, [g for g, _ in tested], [w for _, w in tested]).where(F.col("side").isin(*sides)).checkpoint(eager=True)
        if combined:
            drop_path(rows.sparkSession, combined)
        whole = [PipelineModel([*folded.preprocessor.stages, T.TreeClassifierModel(g, made[i].how, FEATURES)]) for g, (i, f) in zip(grown, wanted) if f is None]
        return scores, whole
    if name == "logistic_regression":
        whole = [model_pipeline(make_estimator(name, p, n), numeric, categorical, n).fit(rows) for p in trials if refit]
        asked = [(i, f) for i, f in wanted if f is not None]
        return L.score_folds(folded.blocks, logistic_folds(trials, asked, folded), asked, sides).checkpoint(eager=True), whole
    if name != "svm":
        raise ValueError(f"unknown model name: {name}")
    own = [make_estimator(name, p, n) for p in trials]
    maps, _, spreads = B.fold_maps(B.fold_moments(folded.blocks), [f for _, f in wanted], len(numeric), folded.factor)
    projections = [own[i].projection(maps[f], spreads[f], f) for i, f in wanted]
    fitted = S.fit_svms(folded.blocks, projections, [1.0 / (own[i].C * n) for i, _ in wanted], B.first_row(folded.blocks), own[0].maxIter)
    margins = S.margin_columns(folded.blocks, projections, fitted).checkpoint(eager=True)
    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        platts = list(pool.map(lambda m: _platt(margins, m, wanted[m][1]), range(len(wanted))))
    scored = []
    for m, ((i, f), platt) in enumerate(zip(wanted, platts)):
        if f is not None:
            p = 1.0 / (1.0 + F.exp(-(F.lit(float(platt.coefficients[0])) * F.col("m")[m] + F.lit(float(platt.intercept)))))
            scored.append(F.struct(F.lit(i).alias("trial"), F.lit(f).alias("fold"), F.when(F.col("fold") == f, "val").otherwise("train").alias("side"), F.col("y").cast("int").alias("y"), p.alias("p"), F.lit(1).cast("long").alias("n")))
    scores = margins.select(F.inline(F.array(*scored))).where(F.col("side").isin(*sides)).checkpoint(eager=True)
    whole = [PipelineModel([*folded.preprocessor.stages, RffSvmModel(q.W, q.b, _linear_svc(*fit), platt, FEATURES)]) for (_, f), q, fit, platt in zip(wanted, projections, fitted, platts) if f is None]
    return scores, whole


def logistic_folds(trials: Sequence[Mapping], asked: Sequence[tuple[int, int]], folded: FoldedRows) -> np.ndarray:
    """Weights of the logistic regressions of every (trial, fold left out) of ``asked`` on the blocks of ``folded``."""
    penalties = [(1.0 / (float(trials[i].get("C", 1.0)) * folded.n), trials[i].get("penalty", "l2") == "l1") for i, _ in asked]
    return L.fit_folds(folded.blocks, [f for _, f in asked], penalties, len(folded.numeric), folded.factor)


def logistic_search(trials: Sequence[Mapping], rows: DataFrame, numeric, categorical, k: int = CV_FOLDS) -> list[list[float | None]]:
    """ROC AUC of every trial on every fold's own rows. All models are fitted on one table and their scores are ranked
    as they are made, without a table of scores."""
    asked = [(i, f) for i in range(len(trials)) for f in range(k)]
    folded = FoldedRows(rows, numeric, categorical, ())
    weights = logistic_folds(trials, asked, folded)
    out: list = []
    for at in range(0, len(asked), LOGISTIC_TRIALS * k):
        own = slice(at, at + LOGISTIC_TRIALS * k)
        out += L.validation_aucs(folded.blocks, weights[own], [f for _, f in asked[own]])
    folded.drop()
    return [out[i * k : (i + 1) * k] for i in range(len(trials))]


def fold_metrics(scores: DataFrame, by: Sequence[str] = ("trial", "fold", "side"), threshold: float = 0.5) -> DataFrame:
    """The five cross-validation metrics of every group of a long score table, in one grouped job. A column ``n``
    says how many rows a row stands for."""
    flagged = scores.withColumn("__pred", (F.col("p") > threshold).cast("int"))
    return classification_metrics(flagged, "y", "__pred", "p", by=by, n="n" if "n" in scores.columns else None).select(*by, *CV_METRICS)


def cv_summary(per_fold: DataFrame, by: Sequence[str] = ("trial",)) -> DataFrame:
    """``(by…, metric, train_mean, val_mean, val_std)`` over the folds; ``val_std`` is the population std (M7)."""
    side = lambda s: F.when(F.col("side") == s, F.col("value"))
    long = per_fold.unpivot([*by, "fold", "side"], list(CV_METRICS), "metric", "value")
    return long.groupBy(*by, "metric").agg(F.avg(side("train")).alias("train_mean"), F.avg(side("val")).alias("val_mean"), F.stddev_pop(side("val")).alias("val_std"))


def fold_rows(train: DataFrame, key_cols: Sequence[str], k: int = CV_FOLDS) -> DataFrame:
    """Training rows with exact stratified folds, written once: every fold's fit reads them."""
    return stratified_folds(train, LABEL, key_cols, k, RANDOM_STATE, exact=True).checkpoint(eager=True)


@dataclass
class TrainResult:
    name: str
    model: PipelineModel
    cv_auc_mean: float
    cv_auc_std: float
    fold_scores: list


def train_model(name: str, train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], key_cols: Sequence[str],
                params: Mapping | None = None, k: int = CV_FOLDS, folded: FoldedRows | None = None) -> TrainResult:
    """CV ROC AUC over exact stratified folds (mean, population std) and a model fitted on all training rows (M6);
    ``folded`` shares the folds of ``train`` and what is made from them between several models."""
    scores, whole = fold_scores(name, [params or {}], folded or fold_rows(train, key_cols, k), numeric, categorical, key_cols, k, refit=True)
    per_fold = [float("nan") if r["roc_auc"] is None else r["roc_auc"] for r in fold_metrics(scores).where("side = 'val'").orderBy("fold").collect()]
    mean = sum(per_fold) / len(per_fold)
    return TrainResult(name, whole[0], mean, math.sqrt(sum((x - mean) ** 2 for x in per_fold) / len(per_fold)), per_fold)


def cross_validate_metrics(name: str, train: DataFrame, numeric, categorical, key_cols, params: Mapping | None = None, k: int = CV_FOLDS) -> DataFrame:
    """Five metrics over the folds: ``(metric, train_mean, val_mean, val_std)`` (M7)."""
    scores, _ = fold_scores(name, [params or {}], fold_rows(train, key_cols, k), numeric, categorical, key_cols, k)
    return cv_summary(fold_metrics(scores)).drop("trial")


def run_experiment(name: str, train: DataFrame, test: DataFrame, numeric, categorical, key_cols, params: Mapping | None = None, k: int = CV_FOLDS,
                   store=None, run_id: str | None = None, folded: FoldedRows | None = None) -> tuple[PipelineModel, DataFrame]:
    """One model's experiment (M7): cross-validated metrics, a fit on all training rows, metrics on the test rows. Returns
    the model and ``(metric, train_mean, val_mean, val_std, test)``; recorded as a run where a store is given."""
    scores, whole = fold_scores(name, [params or {}], folded or fold_rows(train, key_cols, k), numeric, categorical, key_cols, k, refit=True)
    cv = cv_summary(fold_metrics(scores)).drop("trial")
    tested = held_out_metrics(whole[0], test)
    out = cv.join(tested.unpivot([], list(CV_METRICS), "metric", "test"), "metric").checkpoint(eager=True)  # five rows
    if store is not None:
        store.log_run(run_id or name, "baseline", name, params={f"model_{a}": b for a, b in (params or {}).items()}, tags={"model_type": name, "phase": "baseline"},
                      metrics={f"{p}{r['metric']}{e}": r[c] for r in out.collect() for c, p, e in (("train_mean", "cv_train_", "_mean"), ("val_mean", "cv_val_", "_mean"), ("val_std", "cv_val_", "_std"), ("test", "test_", "")) if r[c] is not None})
    return whole[0], out


def held_out_metrics(model: PipelineModel, test: DataFrame) -> DataFrame:
    """The five metrics of a fitted model on held-out rows (one row)."""
    s = positive_probability(model.transform(test)).withColumn("__pred", F.col("prediction").cast("int"))
    return classification_metrics(s, LABEL, "__pred", "p1").select(*CV_METRICS)


def sample_params(name: str, n_trials: int = N_TRIALS, seed: int = RANDOM_STATE) -> list[dict]:
    """Seeded random search over the model's space (integers uniform, C log-uniform)."""
    space = SEARCH_SPACES[name]
    rng = random.Random(seed)
    out = []
    for _ in range(n_trials):
        p = {}
        for k, v in space.items():
            if k in NOT_APPLIED:
                continue
            if isinstance(v, list):
                p[k] = rng.choice(v)
            elif k == "C":
                p[k] = math.exp(rng.uniform(math.log(v[0]), math.log(v[1])))
            elif isinstance(v[0], int) and isinstance(v[1], int):
                p[k] = rng.randint(v[0], v[1])
            else:
                p[k] = rng.uniform(v[0], v[1])
        out.append(p)
    return out


TREE_TRIALS = 8  # tree trials grown in common passes; a pass holds one margin a row for each of their folds
LOGISTIC_TRIALS = 10  # logistic regressions evaluated together, for each of their folds
OTHER_TRIALS = 3  # trials of other models evaluated together


def random_search(name: str, train: DataFrame, numeric, categorical, key_cols, n_trials: int = N_TRIALS, k: int = CV_FOLDS):
    """Maximise CV ROC AUC over seeded random trials of the model's search space; refit the best on all
    rows (M8). Returns (best params, best mean AUC, fitted model, [(params, mean AUC, std AUC)…])."""
    params = sample_params(name, n_trials)
    folded = fold_rows(train, key_cols, k)
    nan = float("nan")  # a fold of one class has no AUC
    trials = []
    if name == "logistic_regression":
        for own, found in zip(params, logistic_search(params, folded, numeric, categorical, k)):
            aucs = [a for a in found if a is not None]
            trials.append((own, float(np.mean(aucs)) if aucs else nan, float(np.std(aucs)) if aucs else nan))
    group = TREE_TRIALS if name in ("random_forest", "xgboost") else OTHER_TRIALS
    shared = None if trials else FoldedRows(folded, numeric, categorical, key_cols)
    for at in range(0, n_trials if shared else 0, group):
        own = params[at : at + group]
        scores, _ = fold_scores(name, own, shared, numeric, categorical, key_cols, k, sides=("val",))
        auc = fold_metrics(scores).groupBy("trial").agg(F.avg("roc_auc").alias("mean"), F.stddev_pop("roc_auc").alias("std"))
        trials += [(own[r["trial"]], nan if r["mean"] is None else r["mean"], nan if r["std"] is None else r["std"]) for r in auc.orderBy("trial").collect()]
    if shared:
        shared.drop()
    best = max(trials, key=lambda t: (t[1] if t[1] == t[1] else -1.0))
    n = folded.count()
    model = model_pipeline(make_estimator(name, best[0], n, key_cols=key_cols), numeric, categorical, n).fit(folded)
    return best[0], best[1], model, trials


def tune_model(name: str, train: DataFrame, test: DataFrame, numeric, categorical, key_cols, n_trials: int = N_TRIALS, k: int = CV_FOLDS,
               store=None, run_id: str | None = None) -> tuple[dict, PipelineModel, dict]:
    """Search, refit of the best trial, test metrics, and the run's record: (best params, model, metrics with the
    ``test_`` prefix, ``cv_roc_auc_best`` and ``n_trials``)."""
    best, auc, model, _ = random_search(name, train, numeric, categorical, key_cols, n_trials, k)
    metrics = {f"test_{m}": v for m, v in held_out_metrics(model, test).first().asDict().items() if v is not None}
    metrics |= {"cv_roc_auc_best": auc, "n_trials": n_trials}
    if store is not None:
        store.log_run(run_id or f"{name}_best", "hyperopt", f"{name}_best", params=best, metrics=metrics, tags={"model_type": name, "phase": "hyperopt"})
    return best, model, metrics


def compare_models(metrics: DataFrame, by: str = "roc_auc") -> DataFrame:
    """Rank models by a metric, best first (M9)."""
    return metrics.orderBy(F.col(by).desc_nulls_last(), "model")


def rank_models(metrics: DataFrame, by: str = "roc_auc") -> DataFrame:
    """:func:`compare_models` with an explicit 1-based ``rank`` column (ties broken by ``model``).

    The input is a model / run table (one row per trained model), which does not grow with the data,
    so one ordered window over it is bounded."""
    from pyspark.sql import Window

    w = Window.orderBy(F.col(by).desc_nulls_last(), F.col("model"))
    return metrics.withColumn("rank", F.row_number().over(w))


def score(model, df: DataFrame, positive_label: str = "Approved", negative_label: str = "Rejected", keep: Sequence[str] = (), carry: str | None = None) -> DataFrame:
    """Predicted class, P(class 1) to 4 places, the decision as a boolean and the text label (M10), with the ``keep``
    columns and, as ``score``, the column named by ``carry``; works on streaming input too."""
    s = positive_probability(model.transform(df))
    positive = F.col("prediction") == 1
    return s.select(
        *keep,
        F.col("prediction").cast("int").alias("prediction"),
        positive.alias("approved"),
        F.bround("p1", 4).alias("probability"),
        F.when(positive, F.lit(positive_label)).otherwise(F.lit(negative_label)).alias("label_text"),
        *([F.col(carry).alias("score")] if carry else []),
    )


def batch_summary(scored: DataFrame, label_col: str = "label_text", positive_label: str = "Approved") -> DataFrame:
    """Total, approved and rejected counts of a scored batch (A20)."""
    return scored.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(label_col) == positive_label).alias("approved"),
        F.count_if(F.col(label_col) != positive_label).alias("rejected"),
    )


def train_simple(df: DataFrame, target: str, key_cols, numeric, categorical, path: str | None = None,
                 positive="Approved", negative="Rejected", params: Mapping = XGBOOST_PARAMS) -> tuple[PipelineModel, float, int]:
    """Boosting pipeline on an 80/20 split; returns the model, its test ROC AUC and the number of rows left out because
    their target is neither value, saving the model when a path is given (M11)."""
    lab = prepare_labelled(df, target, positive, negative)
    split = stratified_split(lab, LABEL, key_cols, TEST_SIZE, RANDOM_STATE, exact=True)
    train, test = split.where(F.col("split") == "train"), split.where(F.col("split") == "test")
    model = model_pipeline(make_estimator("xgboost", params, key_cols=key_cols), numeric, categorical).fit(train)
    auc = evaluate_model(model, test).first()["roc_auc"]
    if path:
        model.write().overwrite().save(path)
    return model, auc, unlabelled_rows(df, target, positive, negative)


def model_info(spark, model: PipelineModel, name: str, stage: str) -> DataFrame:
    """Name, stage, estimator type, number of features and parameters as a string map (H7)."""
    est = model.stages[-1]
    n_features = getattr(est, "numFeatures", None)
    params = {k: str(v) for k, v in est.settings().items()} if isinstance(est, T.TreeClassifierModel) else {p.name: str(v) for p, v in est.extractParamMap().items()}
    return spark.createDataFrame(
        [(name, stage, type(est).__name__, n_features, params)],
        "model_name string, stage string, model_type string, n_features int, params map<string,string>",
    )
