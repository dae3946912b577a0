import numpy as np
import pytest
from pyspark.sql import functions as F

from veritab.llm import vptree

ROWS = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20):
    seen = {}
    for i, v, _ in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        seen[i] = min(seen.get(i, v), v)
    out = set()
    for q in (i for i in seen if i % 20 == 0):
        found = []
        for i, v in seen.items():
            if i != q and len(v) == len(seen[q]):
                s = 0.0
                for a, b in zip(seen[q], v):
                    s += float(np.float32(a)) * float(np.float32(b))
                found.append((-s, i))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])}
    return out


def data(n=700, d=12, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32)
    x[50:120] = x[50]  # a common vector
    rows = [(int(i), [float(v) for v in x[i]], 0) for i in range(n)]
    bad = [(9001, None, 0), (9002, [], 0), (9003, [0.0] * d, 0), (9020, [float("nan")] + [1.0] * (d - 1), 0), (9040, [None] * d, 0), (None, rows[0][1], 0), (9060, [1.0, 2.0], 0), (9061, [2.0, 1.0], 0)]
    return rows + bad + rows[:3]


@pytest.mark.parametrize("settings", [dict(), dict(shard_rows=64, query_rows=10)])
def test_exact_search(spark, monkeypatch, settings):
    monkeypatch.setattr(vptree, "LEAF_ROWS", 16)
    rows = data()
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", "1 AS v", "2 AS shard")
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in vptree.nearest(df, F.col("vec_id") % 20 == 0, **settings).collect()}
    assert got == brute(rows)


def test_relaxed_search_keeps_recall(spark):
    rows = data(2000, 6, 5)
    df = spark.createDataFrame(rows, ROWS)
    got = {(r["query_id"], r["vec_id"]) for r in vptree.nearest(df, F.col("vec_id") % 20 == 0, relax=1.3).collect()}
    want = {(q, i) for q, _, i, _ in brute(rows)}
    assert len(got & want) / len(want) >= 0.9


def test_pruning_skips_leaves():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 2))
    top = float(np.sqrt((x**2).sum(1).max()))
    tree = vptree.Tree(np.concatenate([x, np.sqrt(np.maximum(0, top**2 - (x**2).sum(1)))[:, None]], axis=1), leaf=50)
    q = x[:5]
    bounds = tree.bounds(np.concatenate([q, np.zeros((5, 1))], axis=1))
    true = np.array([[np.sqrt(((np.append(a, 0) - tree.x[rows]) ** 2).sum(1).min()) for rows, _ in tree.leaves] for a in q])
    assert (bounds <= true + 1e-9).all() and (bounds > 0).any()


def test_empty(spark):
    assert vptree.nearest(spark.createDataFrame([], ROWS), F.col("vec_id") % 20 == 0).count() == 0
