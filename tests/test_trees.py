"""Regularised boosting, balanced forests and models as SQL text."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from veritab.functions.expressions import probability_text
from veritab.operators import ml as ML
from veritab.operators import trees as T


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3))
    x[:, 2] = rng.integers(0, 3, 400)
    y = (x[:, 0] + 0.5 * (x[:, 2] == 1) + 0.3 * rng.normal(size=400) > 0.2).astype(int)
    x[rng.random(400) < 0.1, 1] = np.nan
    df = spark.createDataFrame([(i, [float(v) for v in r], int(t), i % 3) for i, (r, t) in enumerate(zip(x, y))], "id long, x array<double>, label int, fold int")
    return df.repartition(3), x, y


def fit(rows, models):
    df, x, _ = rows
    edges = T.bin_edges(df, "x", 16)
    table, _ = T.binned_table(df, "x", "label", edges, ["id"], fold="fold")
    return T.grow(table, edges, models), table, edges


def brute(bins, y, how, allowed):
    """The same boosting, row by row and cut by cut."""
    soft = lambda g: math.copysign(max(abs(g) - how.reg_alpha, 0.0), g)
    term = lambda g, h: soft(g) ** 2 / (h + how.reg_lambda)
    margin = np.zeros(len(y))

    def grow(at, depth, g, h):
        if depth < how.max_depth:
            best = None
            for f in allowed:
                for cut in range(0, int(bins[:, f].max())):
                    for missing_left in ((False, True) if (bins[at, f] == 0).any() else (False,)):
                        b = bins[at, f]
                        left = at[np.where(b == 0, missing_left, b <= cut)]
                        right = np.setdiff1d(at, left)
                        if not len(left) or not len(right) or h[left].sum() < how.min_child_weight or h[right].sum() < how.min_child_weight:
                            continue
                        gain = round(term(g[left].sum(), h[left].sum()) + term(g[right].sum(), h[right].sum()) - term(g[at].sum(), h[at].sum()), 8)
                        if gain > T.MIN_GAIN and (best is None or gain > best[0]):
                            best = gain, left, right
            if best:
                return grow(best[1], depth + 1, g, h) + grow(best[2], depth + 1, g, h)
        return [(at, -how.learning_rate * soft(g[at].sum()) / (h[at].sum() + how.reg_lambda))]

    for _ in range(how.n_estimators):
        p = 1 / (1 + np.exp(-margin))
        for at, v in grow(np.arange(len(y)), 0, p - y, p * (1 - p)):
            margin[at] += v
    return 1 / (1 + np.exp(-margin))


def test_boosting_matches_brute_force(rows):
    how = T.Boosting(n_estimators=3, max_depth=3, learning_rate=0.3, reg_alpha=0.4, reg_lambda=1.7)
    (model,), _, edges = fit(rows, [(how, None)])
    bins = T.bin_matrix(rows[1], edges)
    assert np.allclose(T.probability_of("boosting", model.trees, bins), brute(bins, rows[2], how, range(3)), atol=1e-9)


def test_every_search_setting_changes_the_model(rows):
    base = dict(n_estimators=4, max_depth=3, learning_rate=0.2)
    variants = [{}, {"n_estimators": 5}, {"max_depth": 2}, {"learning_rate": 0.1}, {"subsample": 0.7}, {"colsample_bytree": 0.5}, {"reg_alpha": 3.0}, {"reg_lambda": 9.0}]
    models, _, edges = fit(rows, [(T.Boosting(**{**base, **v}), None) for v in variants])
    got = [m.probability(rows[1]).round(9).tolist() for m in models]
    assert len({tuple(g) for g in got}) == len(variants)
    assert all(len({f for t in models[5].trees[i : i + 1] for f in t.feature if f >= 0}) <= 1 for i in range(4))


def test_models_grown_together_equal_models_grown_alone(rows, monkeypatch):
    monkeypatch.setattr(T, "REFRESH", 2)
    monkeypatch.setattr(T, "MOST_CELLS", 200)  # nodes wait for later passes
    asked = [(T.Boosting(n_estimators=5, max_depth=2, subsample=0.8), f) for f in (None, 0, 1)] + [(T.Forest(n_estimators=3, max_depth=4), 2)]
    together, table, edges = fit(rows, asked)
    for one, how in zip(together, asked):
        alone = T.grow(table, edges, [how])[0]
        assert np.allclose(one.probability(rows[1]), alone.probability(rows[1]), atol=1e-12)


def test_forest_settings_hold(rows):
    df, x, y = rows
    how = T.Forest(n_estimators=6, min_samples_leaf=7, min_samples_split=20, class_weight="balanced_subsample")
    (model,), table, edges = fit(rows, [(how, None)])
    bins, h = T.bin_matrix(x, edges), {r["h"]: r["bins"] for r in table.collect()}
    keys = np.array(list(h))
    held = np.frombuffer(b"".join(h.values()), dtype=np.uint8).reshape(len(keys), 3)
    for number, tree in enumerate(model.trees):
        in_bag = T.bag_counts(keys, how.seed, number) > 0
        at = tree.leaves(held[in_bag])
        assert min(np.bincount(at)[np.unique(at)]) >= 7
    p = T.probability_of("forest", model.trees, bins)
    assert ((p > 0.5) == y).mean() > 0.85 and (p >= 0).all() and (p <= 1).all()
    bags = T.bootstrap_counts(table, 2).collect()
    assert {(r["tree"], r["y"]) for r in bags} == {(t, c) for t in (0, 1) for c in (0.0, 1.0)}
    assert all(abs(sum(r["bag"] * r["weight"] for r in bags if r["tree"] == t and r["y"] == c) - sum(r["bag"] for r in bags if r["tree"] == t) / 2) < 1e-6 for t in (0, 1) for c in (0.0, 1.0))


def test_pure_and_empty_inputs(spark):
    one = spark.createDataFrame([(i, [1.0, float(i)], 1) for i in range(5)], "id long, x array<double>, label int")
    edges = T.bin_edges(one, "x")
    table, _ = T.binned_table(one, "x", "label", edges, ["id"])
    forest, boost = T.grow(table, edges, [(T.Forest(n_estimators=2), None), (T.Boosting(n_estimators=2), None)])
    assert (forest.probability(np.array([[1.0, 2.0]])) == 1.0).all() and boost.probability(np.array([[1.0, 2.0]]))[0] > 0.5


@pytest.fixture(scope="module")
def loans(spark):
    i = F.col("id")
    return spark.range(300).select((i + 1).alias("loan_id"), (i * 37 % 101).cast("double").alias("income"), (i % 7).alias("dependents"),
                                   F.when(i % 3 == 0, "It's").otherwise(F.when(i % 3 == 1, "No").otherwise("Yes")).alias("kind"),
                                   ((i * 37 % 101 + i % 7 * 5) > 60).cast("int").alias("label"))


@pytest.mark.parametrize("name,params", [("logistic_regression", {"C": 2.0}), ("xgboost", {"n_estimators": 3, "max_depth": 3}), ("random_forest", {"n_estimators": 3, "max_depth": 4})])
def test_sql_text_scores_like_the_model(spark, loans, tmp_path, name, params):
    model = ML.model_pipeline(ML.make_estimator(name, params, 300, key_cols=["loan_id"]), ["income", "dependents"], ["kind"], 300).fit(loans)
    text = probability_text(model)
    both = ML.positive_probability(model.transform(loans)).select("loan_id", "p1", F.expr(text).alias("q")).collect()
    assert max(abs(r["p1"] - r["q"]) for r in both) < 1e-12
    loans.write.parquet(str(tmp_path / "loans"))
    other = dict(duckdb.sql(f"SELECT loan_id, {text} FROM read_parquet('{tmp_path}/loans/*.parquet')").fetchall())
    assert max(abs(r["p1"] - other[r["loan_id"]]) for r in both) < 1e-12


def test_saved_pipeline_scores_the_same(spark, loans, tmp_path):
    model = ML.model_pipeline(ML.make_estimator("xgboost", {"n_estimators": 2, "max_depth": 2}, key_cols=["loan_id"]), ["income"], ["kind"]).fit(loans)
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    p = [sorted(map(tuple, ML.positive_probability(m.transform(loans)).select("loan_id", "p1").collect())) for m in (model, again)]
    assert p[0] == p[1]


@pytest.mark.parametrize("name", ["random_forest", "xgboost"])
def test_search_and_experiment(spark, loans, tmp_path, monkeypatch, name):
    from veritab.operators import history as H

    monkeypatch.setitem(ML.SEARCH_SPACES, name, {**ML.SEARCH_SPACES[name], "n_estimators": (2, 4), "max_depth": (2, 3)})
    store = H.RunStore(spark, str(tmp_path / "runs"))
    test = loans.where("loan_id % 5 = 0")
    best, model, metrics = ML.tune_model(name, loans.where("loan_id % 5 <> 0"), test, ["income"], ["kind"], ["loan_id"], n_trials=3, k=3, store=store)
    assert set(best) == set(ML.SEARCH_SPACES[name]) and metrics["n_trials"] == 3 and 0.5 < metrics["cv_roc_auc_best"] <= 1
    got = {r["key"]: r["value"] for r in store.read(H.METRICS).collect()}
    assert got["cv_roc_auc_best"] == metrics["cv_roc_auc_best"] and "test_roc_auc" in got
    assert {r["key"] for r in store.read(H.PARAMS).collect()} == set(best)
    with pytest.raises(ValueError):
        ML.make_estimator(name, {"depth": 3})


def test_equal_rows_are_combined(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(3000, 2)))
    y = (x[:, 0] + rng.normal(size=3000) > 0).astype(int)
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], int(y[i]), i % 3) for i in range(3000)], "id long, x array<double>, label int, fold int")
    edges = T.bin_edges(df, "x", 16)
    table, _ = T.binned_table(df, "x", "label", edges, ["id"], fold="fold")
    models = [(T.Boosting(n_estimators=3, max_depth=3), None), (T.Boosting(n_estimators=3, max_depth=3), 1),
              (T.Forest(n_estimators=4, max_depth=5, min_samples_leaf=3, class_weight="balanced_subsample"), 0), (T.Forest(n_estimators=2), None)]
    rows, path = T.combine(table, edges, [how for how, _ in models])
    got = rows.agg({"n": "sum", "y": "count"}).first()
    assert path and got["sum(n)"] == 3000 and got["count(y)"] == table.select("y", "w", "fold", "bins").distinct().count() < 750
    bins = T.bin_matrix(x, edges)
    for a, b in zip(T.grow(table, edges, models), T.grow(rows, edges, models, bagged=table)):
        assert [t.feature for t in a.trees] == [t.feature for t in b.trees] and [t.cut for t in a.trees] == [t.cut for t in b.trees]
        assert np.allclose(T.probability_of(a.kind, a.trees, bins), T.probability_of(b.kind, b.trees, bins), atol=1e-12)
    assert T.combine(table, edges, [T.Boosting(subsample=0.5)])[1] is None
