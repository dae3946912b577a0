"""Fitted models as plain SQL text: one expression of the probability of class 1 over the input columns.

The text runs unchanged as a Spark column (``F.expr``) and on another SQL engine, so a fitted model can be scored where
no Python worker runs, and checked there. Logistic pipelines become a weighted sum, tree ensembles nested CASE; an
ensemble of many deep trees is better scored by its model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import ElementwiseProduct, OneHotEncoderModel, StandardScalerModel, StringIndexerModel, VectorAssembler

from veritab.operators.trees import Ensemble, Tree, TreeClassifierModel


def number(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def text(x: str) -> str:
    if "\\" in x:
        raise ValueError("a category with a backslash reads differently on different engines")
    return "'" + x.replace("'", "''") + "'"


def feature_terms(stages: Sequence) -> list[str]:
    """SQL text of every entry of the features vector that the preprocessing stages assemble."""
    made: dict[str, list[str]] = {}
    out: list[str] = []
    for s in stages:
        if isinstance(s, VectorAssembler):
            out = made[s.getOutputCol()] = [t for c in s.getInputCols() for t in made.get(c, [f"CAST({c} AS DOUBLE)"])]
        elif isinstance(s, StandardScalerModel):
            # times the reciprocal, as the scaler does; a constant column has no spread and becomes 0
            made[s.getOutputCol()] = [f"(({t} - {number(m)}) * {number(1.0 / d)})" if d else number(0.0) for t, m, d in zip(made[s.getInputCol()], s.mean.toArray(), s.std.toArray())]
        elif isinstance(s, ElementwiseProduct):
            made[s.getOutputCol()] = [f"({t} * {number(f)})" for t, f in zip(made[s.getInputCol()], s.getScalingVec().toArray())]
        elif isinstance(s, StringIndexerModel):
            made[s.getOutputCol()] = [f"CASE WHEN {s.getInputCol()} = {text(v)} THEN {number(1.0)} ELSE {number(0.0)} END" for v in s.labels]
        elif isinstance(s, OneHotEncoderModel):
            for i, o in zip(s.getInputCols(), s.getOutputCols()):
                made[o] = made[i][:-1] if s.getDropLast() else made[i]
        else:
            raise NotImplementedError(f"no SQL text for {type(s).__name__}")
    return out


def tree_text(tree: Tree, edges: Sequence[Sequence[float]], terms: Sequence[str], node: int = 0) -> str:
    f = tree.feature[node]
    if f < 0:
        return number(tree.value[node])
    left, right = (tree_text(tree, edges, terms, side[node]) for side in (tree.left, tree.right))
    missing = f"{terms[f]} IS NULL"
    if tree.cut[node] == 0:  # only missing values go left
        return f"CASE WHEN {missing} THEN {left} ELSE {right} END"
    if tree.cut[node] > len(edges[f]):  # all known values go left
        return f"CASE WHEN {missing} THEN {left if tree.missing_left[node] else right} ELSE {left} END"
    below = f"{terms[f]} <= {number(edges[f][tree.cut[node] - 1])}"
    return f"CASE WHEN {below}{' OR ' + missing if tree.missing_left[node] else ''} THEN {left} ELSE {right} END"


def ensemble_text(model: Ensemble, terms: Sequence[str]) -> str:
    total = " + ".join(tree_text(t, model.edges, terms) for t in model.trees) or number(0.0)
    return f"(({total}) / {max(1, len(model.trees))})" if model.kind == "forest" else f"(1 / (1 + exp(-({total}))))"


def probability_text(model: PipelineModel) -> str:
    """P(class 1) of a fitted pipeline (preprocessing, then logistic regression or a tree ensemble) as SQL text."""
    *stages, last = model.stages
    terms = feature_terms(stages)
    if isinstance(last, LogisticRegressionModel):
        total = " + ".join([number(last.intercept), *[f"{number(w)} * {t}" for w, t in zip(last.coefficients.toArray(), terms)]])
        return f"(1 / (1 + exp(-({total}))))"
    if isinstance(last, TreeClassifierModel):
        return ensemble_text(last.ensemble, terms)
    raise NotImplementedError(f"no SQL text for {type(last).__name__}")
