import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veritab.llm import quality

from ..conftest import SF_CHECK
from .helpers import DOCS, frame


def _data(n=600, seed=1):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    texts, grades = [], []
    for _ in range(n):
        g = rng.randrange(3)
        words = [rng.choice(vocab) for _ in range(rng.choice([5, 40, 400]))]
        if g == 0:
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "nasty"]))
        if g == 1:
            words = [w + "###" for w in words]
        texts.append(" ".join(words))
        grades.append(g)
    return texts, np.array(grades)


def test_fit_separates_held_out_grades():
    texts, grades = _data()
    m = quality.fit(pa.array(texts[:400]), grades[:400], 3)
    assert (np.diff(m.thresholds) > 0).all()
    score = np.zeros(200)
    for first, slots, owners in quality.features(pa.array(texts[400:])):
        part = m.scores(slots, owners, int(owners.max()) + 1)
        score[first : first + len(part)] = part
    tails = m.tails(score)
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert ((tails > 0.5).sum(axis=1) == grades[400:]).mean() > 0.95


def test_fit_is_repeatable():
    texts, grades = _data(200)
    a, b = (quality.fit(pa.array(texts), grades, 3) for _ in range(2))
    assert (a.slots == b.slots).all() and (a.weights == b.weights).all()


def test_held_out_documents(spark):
    # fitted without every third labelled document, judged on those
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    model = quality.train(docs, labels.where("doc_id % 3 <> 0"), quality.document_grade(), 3)
    scored = quality.score(docs, model, ["doc_id"]).join(labels.where("doc_id % 3 = 0").withColumn("grade", quality.document_grade()), "doc_id").toPandas()
    good, bad = scored[scored.grade == 2], scored[scored.grade < 2]
    assert len(scored) > 100
    # under 300 labelled rows: a loose bound; the README gives the figures of the larger tables
    assert (good.expected_grade.median() > bad.expected_grade.median()) and (good.tails.str[1] >= quality.KEEP).mean() > 0.8


def test_edges(spark):
    texts = ["good text here", None, "", "vile ### ###", "word " * 50_000]
    df = frame(spark, texts, extra=True)
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 1), (None, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int")
    rows = quality.grade_documents(df, df, labels, df.columns).collect()
    assert len(rows) == len(texts) and all(0 <= r["p_good"] <= 1 for r in rows)
    none = quality.grade_documents(df, df, labels.limit(0), ["doc_id"]).collect()
    assert all(r["keep"] and r["p_good"] is None for r in none)
    empty = spark.createDataFrame([], DOCS)
    assert quality.grade_documents(empty, df, labels, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        quality.grade_documents(df.withColumnRenamed("lang", "tails"), df, labels, ["tails"])


def _graded(spark, grades):
    docs = frame(spark, [f"w{i} some words {i % 7}" for i in range(len(grades))])
    return docs, spark.createDataFrame(list(enumerate(grades)), "doc_id long, grade int")


def test_sample_takes_every_row_of_a_rare_grade(spark):
    docs, labels = _graded(spark, [0 if i % 100 == 0 else 2 for i in range(1000)])
    rows = quality.labelled_sample(docs, labels, F.col("grade"), 100).collect()
    assert sum(r["grade"] == 0 for r in rows) == 10 and 60 < len(rows) < 130
    assert quality.quotas({0: 10, 1: 400, 2: 590}, 100) == {0: 10, 1: 45, 2: 45}


def test_thinning_to_nothing_fails(spark):
    docs, labels = _graded(spark, [i % 3 for i in range(30)])
    with pytest.raises(RuntimeError):
        quality.train(docs, labels, F.col("grade"), 3, sample_features=1)


def test_features_of_the_executors_give_the_same_fit(spark):
    texts, grades = _data(200)
    docs, labels = frame(spark, texts), spark.createDataFrame(list(enumerate(grades.tolist())), "doc_id long, grade int")
    a, b = quality.train(docs, labels, F.col("grade"), 3), quality.fit(pa.array(texts), grades, 3)
    scores = lambda m: m.tails(np.concatenate([m.scores(s, o, int(o.max()) + 1) for _, s, o in quality.features(pa.array(texts))]))
    assert ((scores(a) > 0.5) == (scores(b) > 0.5)).mean() > 0.98


def test_train_equals_the_fit_in_one_place(spark):
    texts, grades = _data(150, 4)
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(grades)], "doc_id long, grade int")
    marks = [r[0] for r in docs.orderBy("doc_id").select(F.xxhash64("text")).collect()]
    order = sorted(range(len(texts)), key=lambda i: (grades[i], marks[i]))
    a, b = quality.train(docs, labels, F.col("grade"), 3), quality.fit(pa.array([texts[i] for i in order]), grades[order], 3)
    assert (a.slots == b.slots).all() and (a.weights == b.weights).all() and (a.thresholds == b.thresholds).all()


def test_rare_words_get_no_weight(spark):
    texts, grades = _data(150, 4)
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(grades)], "doc_id long, grade int")
    model = quality.train(docs, labels, F.col("grade"), 3, min_rows=10_000)
    assert len(model.slots) and (model.slots >= 1 << quality.BITS).all()  # only the shape of the text is left
