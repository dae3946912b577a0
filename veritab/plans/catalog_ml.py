"""Model queries (T16–T17, M1–M11, A20, H7) on `orders`.

Stand-in: label = status F against the rest, so every order takes part; numerics = price and order day number,
categorical = priority. Fits that SQL can repeat (two rounds of boosting, a two-weight logistic regression, the
bootstrap samples of a forest) have an oracle; larger fits and searches have none. The boosting queries over whole
metrics, and the forests, grow ROUNDS trees instead of the operators' default hundred.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from veritab.functions.expressions import probability_text
from veritab.operators import ml as ML
from veritab.operators import trees as T
from veritab.plans.catalog_sampling import HASH15
from veritab.plans.oracle_sql import boosted_sql, logistic_sql
from veritab.plans.registry import register, table
from veritab.plans.scratch import scratch_path

NUMERIC = ["o_totalprice", "order_day"]
CATEGORICAL = ["o_orderpriority"]
KEYS = ["o_orderkey"]
ROUNDS = 20
PARAMS = {"logistic_regression": ML.LOGISTIC_REGRESSION_PARAMS, "random_forest": {**ML.RANDOM_FOREST_PARAMS, "n_estimators": ROUNDS},
          "xgboost": {**ML.XGBOOST_PARAMS, "n_estimators": ROUNDS}, "svm": {"C": 1.0}}


def orders_model_input(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        "o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus",
        F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")).cast("double").alias("order_day"),
    )


def labelled(spark, sf):
    return ML.prepare_against_rest(orders_model_input(spark, sf), "o_orderstatus", "F")


_PRIO_DESC = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH"]
_T16_SQL = """WITH o AS (SELECT o_orderkey, o_totalprice, CAST(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS order_day,
  o_orderpriority FROM orders)
SELECT o_orderkey,
  round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER (), 6) AS f0,
  round((order_day - avg(order_day) OVER ()) / stddev_pop(order_day) OVER (), 6) AS f1, """ + ", ".join(
    f"CAST(o_orderpriority = '{p}' AS DOUBLE) AS f{i + 2}" for i, p in enumerate(_PRIO_DESC)
) + " FROM o"


@register("t16_preprocessed_features_orders", _T16_SQL)
def t16_preprocessed_features_orders(spark, sf):
    df = orders_model_input(spark, sf)
    n = df.count()
    from pyspark.ml import Pipeline

    pre = Pipeline(stages=ML.build_preprocessor(NUMERIC, CATEGORICAL, n)).fit(df)
    arr = pre.transform(df).select("o_orderkey", vector_to_array("features").alias("_f"))
    return arr.select("o_orderkey", *[F.round(F.col("_f")[i], 6).alias(f"f{i}") for i in range(2 + len(_PRIO_DESC))])


def _split(spark, sf):
    from veritab.operators.sampling import stratified_split

    path = scratch_path(spark, "split")  # written once: every step of preprocessing, fits and scoring reads it
    stratified_split(labelled(spark, sf), ML.LABEL, KEYS, ML.TEST_SIZE, ML.RANDOM_STATE, exact=True).write.parquet(path)
    s = spark.read.parquet(path)
    return s.where(F.col("split") == "train"), s.where(F.col("split") == "test")


def _fit(train, name, params=None):
    n = train.count()
    est = ML.make_estimator(name, PARAMS[name] if params is None else params, n, key_cols=KEYS)
    return ML.model_pipeline(est, NUMERIC, CATEGORICAL, n).fit(train)


@register("m1_m3_model_metrics_orders")
def m1_m3_model_metrics_orders(spark, sf):
    train, test = _split(spark, sf)
    out = None
    for name in ("logistic_regression", "random_forest", "xgboost"):
        row = ML.evaluate_model(_fit(train, name), test).select(F.lit(name).alias("model"), "*")
        out = row if out is None else out.unionByName(row)
    return ML.compare_models(out)


_ROWS = """SELECT o_orderkey AS id, CAST(o_orderstatus = 'F' AS INTEGER) AS y, o_totalprice, o_orderpriority,
  CAST(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS order_day FROM orders WHERE o_orderstatus IS NOT NULL"""
_DUMMIES = [f"CAST(o_orderpriority = '{p}' AS INTEGER)" for p in _PRIO_DESC]
SMALL_BOOSTING = {"n_estimators": 2, "max_depth": 2, "learning_rate": 0.3, "reg_alpha": 0.5, "reg_lambda": 1.5}
_SMALL = {"rounds": 2, "depth": 2, "rate": 0.3, "lam": 1.5, "alpha": 0.5}


@register("m1_logistic_weights_orders", logistic_sql("SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS y, o_totalprice AS x1, CAST(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS x2 FROM orders WHERE o_orderstatus IS NOT NULL"))
def m1_logistic_weights_orders(spark, sf):
    """Weights of a ridge logistic regression on the standardised price and day."""
    df = labelled(spark, sf)
    n = df.count()
    model = ML.model_pipeline(ML.make_estimator("logistic_regression", {"tol": 1e-12}, n), NUMERIC, [], n).fit(df).stages[-1]
    rows = [("intercept", model.intercept), *zip(NUMERIC, model.coefficients.toArray().tolist())]
    return spark.createDataFrame(rows, "term string, weight double").withColumn("weight", F.round("weight", 4))


_GOLDEN, _MIX1, _MIX2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
_BAG_SQL = f"""WITH k AS (SELECT CAST('0x' || {HASH15.format(seed=42)} AS UBIGINT) AS h, CAST(o_orderstatus = 'F' AS INTEGER) AS y, unnest(range(0, 5)) AS tree FROM orders WHERE o_orderstatus IS NOT NULL),
z0 AS (SELECT *, ((CAST(h AS UHUGEINT) + CAST(42 * 1000003 + tree + 1 AS UHUGEINT) * {_GOLDEN}::UHUGEINT) % 18446744073709551616::UHUGEINT)::UBIGINT AS z FROM k),
z1 AS (SELECT * REPLACE (((xor(z, z >> 30))::UHUGEINT * {_MIX1}::UHUGEINT % 18446744073709551616::UHUGEINT)::UBIGINT AS z) FROM z0),
z2 AS (SELECT * REPLACE (((xor(z, z >> 27))::UHUGEINT * {_MIX2}::UHUGEINT % 18446744073709551616::UHUGEINT)::UBIGINT AS z) FROM z1),
u AS (SELECT tree, y, (xor(z, z >> 31) >> 11)::DOUBLE / 9007199254740992 AS u FROM z2),
c AS (SELECT tree, y, len(list_filter([{", ".join(repr(float(x)) for x in T._POISSON)}], lambda x: x <= u)) AS n FROM u),
b AS (SELECT tree, y, sum(n)::BIGINT AS bag FROM c GROUP BY ALL)
SELECT tree::INTEGER AS tree, y::INTEGER AS label, bag, round(sum(bag) OVER (PARTITION BY tree) / (count(*) OVER (PARTITION BY tree) * bag), 6) AS weight FROM b"""


@register("m2_balanced_bags_orders", _BAG_SQL)
def m2_balanced_bags_orders(spark, sf):
    """Bootstrap sample and class weights of the first five trees of a balanced forest."""
    src = labelled(spark, sf).select("o_orderkey", ML.LABEL, F.array("o_totalprice").alias("x"))
    table_, _ = T.binned_table(src, "x", ML.LABEL, [[]], KEYS)
    return T.bootstrap_counts(table_, 5).select("tree", F.col("y").cast("int").alias("label"), "bag", F.round("weight", 6).alias("weight"))


@register("m3_boosted_trees_orders", boosted_sql(_ROWS, ["o_totalprice", "order_day"], **_SMALL) + "\nSELECT id AS o_orderkey, round(p, 6) AS probability FROM scored")
def m3_boosted_trees_orders(spark, sf):
    """Two rounds of regularised boosting on price and day, scored as a plain SQL expression."""
    df = labelled(spark, sf)
    model = ML.model_pipeline(ML.make_estimator("xgboost", SMALL_BOOSTING, key_cols=KEYS), NUMERIC, []).fit(df)
    return df.select("o_orderkey", F.round(F.expr(probability_text(model)), 6).alias("probability"))


def _small_pipeline(spark, sf):
    return _fit(labelled(spark, sf), "xgboost", SMALL_BOOSTING)


_T17_SQL = boosted_sql(_ROWS, ["o_totalprice", "order_day", *_DUMMIES], **_SMALL)


@register("t17_pipeline_scores_orders", _T17_SQL + "\nSELECT id AS o_orderkey, round(p, 6) AS probability, CAST(p > 0.5 AS INTEGER) AS prediction FROM scored")
def t17_pipeline_scores_orders(spark, sf):
    """Preprocessing (scaling, one-hot) and boosting as one fitted pipeline."""
    s = ML.positive_probability(_small_pipeline(spark, sf).transform(labelled(spark, sf)))
    return s.select("o_orderkey", F.round("p1", 6).alias("probability"), F.col("prediction").cast("int").alias("prediction"))


_DECISION_SQL = _T17_SQL + """
SELECT id AS o_orderkey, CAST(p > 0.5 AS INTEGER) AS prediction, p > 0.5 AS approved, round_even(p, 4) AS probability,
  CASE WHEN p > 0.5 THEN 'F' ELSE 'O' END AS label_text, o_totalprice AS score FROM scored JOIN orders ON o_orderkey = id"""


@register("m10_decisions_orders", _DECISION_SQL)
def m10_decisions_orders(spark, sf):
    return ML.score(_small_pipeline(spark, sf), labelled(spark, sf), "F", "O", keep=["o_orderkey"], carry="o_totalprice")


@register("a20_batch_summary_orders", f"SELECT count(*) AS total, CAST(count_if(approved) AS BIGINT) AS approved, CAST(count_if(NOT approved) AS BIGINT) AS rejected FROM ({_DECISION_SQL})")
def a20_batch_summary_orders(spark, sf):
    return ML.batch_summary(m10_decisions_orders(spark, sf), positive_label="F")


@register("m5_baseline_models_orders")
def m5_baseline_models_orders(spark, sf):
    """Balanced forest and balanced logistic regression; F against O, with the number of orders of other statuses,
    which take no part. The stand-in label is noise, on which trees without a depth limit would hold a leaf per order:
    50 trees of depth 10 here, the operator's default is 300 without a limit."""
    res = ML.train_baseline_models(orders_model_input(spark, sf), "o_orderstatus", KEYS, NUMERIC, CATEGORICAL, "F", "O", rf_params={"n_estimators": 50, "max_depth": 10})
    return res["metrics"].withColumn("test_size", F.lit(res["test_size"])).withColumn("unlabelled_rows", F.lit(res["unlabelled_rows"]))


@register("m6_cv_auc_orders")
def m6_cv_auc_orders(spark, sf):
    """All four models."""
    train, _ = _split(spark, sf)
    folded = ML.FoldedRows(ML.fold_rows(train, KEYS), NUMERIC, CATEGORICAL, KEYS)
    found = [ML.train_model(name, train, NUMERIC, CATEGORICAL, KEYS, PARAMS[name], folded=folded) for name in ML.MODELS]
    folded.drop()
    return spark.createDataFrame([(r.name, r.cv_auc_mean, r.cv_auc_std) for r in found], "model string, cv_auc_mean double, cv_auc_std double")


@register("m10_a20_batch_scoring_orders")
def m10_a20_batch_scoring_orders(spark, sf):
    return ML.batch_summary(m10_scored_orders(spark, sf), positive_label="F")


@register("m10_scored_orders")
def m10_scored_orders(spark, sf):
    model = _fit(_split(spark, sf)[0], "logistic_regression")
    return ML.score(model, orders_model_input(spark, sf), "F", "O", keep=["o_orderkey"])


@register("m11_simple_gbt_orders")
def m11_simple_gbt_orders(spark, sf):
    _, auc, left_out = ML.train_simple(orders_model_input(spark, sf), "o_orderstatus", KEYS, NUMERIC, CATEGORICAL, None, "F", "O", PARAMS["xgboost"])
    return spark.createDataFrame([("xgboost", float(auc) if auc is not None else None, left_out)], "model string, roc_auc double, unlabelled_rows long")


def _info(spark, sf):
    return ML.model_info(spark, _small_pipeline(spark, sf), "credit_model", "Production")


@register("h7_model_info_orders")
def h7_model_info_orders(spark, sf):
    return _info(spark, sf)


_SETTINGS = {"n_estimators": "2", "max_depth": "2", "learning_rate": "0.3", "subsample": "1.0", "colsample_bytree": "1.0", "reg_alpha": "0.5", "reg_lambda": "1.5", "min_child_weight": "1.0", "seed": "42"}


@register("h7_model_settings_orders", "SELECT 'credit_model' AS model_name, 'Production' AS stage, 'TreeClassifierModel' AS model_type, n_features, key, value FROM "
          "(SELECT CAST(count(DISTINCT o_orderpriority) + 1 AS INTEGER) AS n_features FROM orders), (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in _SETTINGS.items()) + ") AS s(key, value)")
def h7_model_settings_orders(spark, sf):
    """Model info as rows: one per setting."""
    return _info(spark, sf).select("model_name", "stage", "model_type", "n_features", F.explode("params"))
