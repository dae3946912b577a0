"""Nearest neighbours by largest inner product with a vantage-point tree per shard.

Inner products are turned into distances by one extra coordinate: with M the largest norm, a vector x becomes
(x, sqrt(M^2 - |x|^2)) and a query q becomes (q, 0), so the squared distance is |q|^2 + M^2 - 2 q.x and the
nearest vector is the one with the largest product. Each shard (bounded number of vectors) is a
vantage-point tree: a node picks the vector farthest from the centre as its vantage point and halves the rest by their
distance from it, and keeps the distance range of each half. A query skips a half whose range is farther away
than its k-th best so far, by the triangle inequality; ``relax`` scales that lower bound: at one the search is
exact, above one it skips more and may miss some.

Query blocks and shards meet by an equi-join on the shard number (a stated query set against all rows, in
blocks). Scores that are returned are summed in double precision in the order of the coordinates, the same for
every pair wherever it is computed, so equal vectors tie exactly and go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veritab.llm.store import materialize

SHARD_ROWS = 8192
QUERY_ROWS = 2048
LEAF_ROWS = 256


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed coordinate by coordinate."""
    s = np.zeros(len(q))
    for d in range(q.shape[1]):
        s += q[:, d] * x[:, d]
    return s


class Tree:
    """Vantage-point tree over the rows of ``x`` (already lifted to the distance space)."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF_ROWS):
        self.x = x
        self.vantage: list[np.ndarray] = []
        self.leaves: list[tuple[np.ndarray, list[tuple[int, float, float]]]] = []  # rows, (vantage, low, high) above
        todo = [(np.arange(len(x)), [])]
        while todo:
            rows, above = todo.pop()
            if len(rows) <= leaf:
                if len(rows):
                    self.leaves.append((rows, above))
                continue
            centre = x[rows].mean(axis=0)
            v = x[rows[int(np.argmax(((x[rows] - centre) ** 2).sum(axis=1)))]]
            d = np.sqrt(((x[rows] - v) ** 2).sum(axis=1))
            order = np.argsort(d, kind="stable")
            half = len(rows) // 2
            k = len(self.vantage)
            self.vantage.append(v)
            for part in (order[:half], order[half:]):
                todo.append((rows[part], [*above, (k, float(d[part[0]]), float(d[part[-1]]))]))

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """(queries, leaves): no row of the leaf is nearer than this."""
        if not self.vantage:
            return np.zeros((len(q), len(self.leaves)))
        v = np.array(self.vantage)
        d = np.sqrt(np.maximum(0, (q**2).sum(1)[:, None] + (v**2).sum(1)[None, :] - 2 * q @ v.T))
        out = np.zeros((len(q), len(self.leaves)))
        for i, (_, above) in enumerate(self.leaves):
            for k, low, high in above:
                np.maximum(out[:, i], np.maximum(low - d[:, k], d[:, k] - high), out=out[:, i])
        return out


def search(ids: np.ndarray, x: np.ndarray, tree: Tree, top: float, qids: np.ndarray, q: np.ndarray, k: int, relax: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of each query's k best of one shard, ties to the smaller id."""
    n = len(qids)
    # a query searches the lifted space at its own place (q, 0); |q|^2 + top^2 - 2 score is the squared distance
    lifted = np.concatenate([q, np.zeros((n, 1))], axis=1)
    bounds = tree.bounds(lifted) * relax
    order = np.argsort(bounds, axis=1)
    norm = (q**2).sum(1) + top * top
    slack = 1e-9 * (1 + norm)
    best = np.full((n, k), -np.inf)  # scores of the k best so far
    kept_q, kept_x = [], []
    active = np.arange(n)
    for step in range(len(tree.leaves)):
        leaf = order[active, step]
        worst = np.sqrt(np.maximum(0, norm[active] - 2 * best[active, 0])) + 1e-7 * np.sqrt(norm[active])
        go = ~(bounds[active, leaf] > worst)
        active, leaf = active[go], leaf[go]  # later leaves are no nearer
        if not len(active):
            break
        for li in np.unique(leaf):
            qs = active[leaf == li]
            rows = tree.leaves[li][0]
            s = q[qs] @ x[rows].T
            s[qids[qs][:, None] == ids[rows][None, :]] = -np.inf
            merged = np.concatenate([best[qs], s], axis=1)
            merged = np.partition(merged, merged.shape[1] - k, axis=1)[:, -k:] if merged.shape[1] > k else merged
            best[qs] = np.sort(merged, axis=1)
            a, b = np.nonzero((s >= best[qs][:, :1] - slack[qs][:, None]) & (s > -np.inf))
            kept_q.append(qs[a])
            kept_x.append(rows[b])
    if not kept_q:
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(0)
    a, b = np.concatenate(kept_q), np.concatenate(kept_x)
    score = exact_scores(q[a], x[b])
    ok = score >= best[a, 0] - 2 * slack[a]
    a, b, score = a[ok], b[ok], score[ok]
    o = np.lexsort((ids[b], -score, a))
    a, b, score = a[o], b[o], score[o]
    rank = np.arange(len(a)) - np.searchsorted(a, a)
    top_k = rank < k
    return qids[a[top_k]], ids[b[top_k]], score[top_k]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array([np.frombuffer(b, dtype=np.float64) for b in column]) if len(column) else np.zeros((0, 0))


def _pack(key: str, size: int):
    """Rows of one key, in blocks of at most ``size``, as one binary row each: ids and coordinates."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("vec_id", kind="stable")
        x = np.stack(f["v"].to_numpy()).astype(np.float64)
        ids = f["vec_id"].to_numpy(np.int64)
        return pd.DataFrame({key: [f[key].iloc[0]], "dim": [x.shape[1]], "ids": [ids.tobytes()], "x": [x.tobytes()]})

    return run


def _search(k: int, relax: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, tree, x, ids = None, None, None, None
        for f in frames:
            for shard, dim, top, sid, sx, qid, qx in zip(f["shard"], f["dim"], f["top"], f["ids"], f["x"], f["qids"], f["qx"]):
                if shard != last:
                    x = np.frombuffer(sx, dtype=np.float64).reshape(-1, dim)
                    ids = np.frombuffer(sid, dtype=np.int64)
                    lift = np.sqrt(np.maximum(0, top * top - (x**2).sum(1)))
                    tree, last = Tree(np.concatenate([x, lift[:, None]], axis=1)), shard
                q = np.frombuffer(qx, dtype=np.float64).reshape(-1, dim)
                a, b, s = search(ids, x, tree, top, np.frombuffer(qid, dtype=np.int64), q, k, relax)
                yield pd.DataFrame({"query_id": a, "vec_id": b, "score": s})

    return run


def usable(v: Column) -> Column:
    """Vectors that take part: not null, not empty, no null or non-finite component, not all zero."""
    fine = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return F.coalesce(fine & (F.size(v) > 0) & F.exists(v, lambda e: e != 0), F.lit(False))


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, relax: float = 1.0, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` largest inner products over all other rows.

    Unusable vectors (see ``usable``) and rows without an id take no part. An id that comes twice counts once,
    with its smallest vector. Vectors are compared with those of the same length only. Extra columns are
    ignored. An empty table gives an empty result."""
    v = F.transform(F.col(embedding), lambda e: e.cast("double"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL").where(usable(F.col("v")))
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    rows = materialize(rows.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e)).withColumn("q", F.coalesce(is_query, F.lit(False))), "vectors")
    dims = rows.groupBy("dim").agg(F.sqrt(F.max("norm2")).alias("top"), F.count("*").alias("n"), F.sum(F.col("q").cast("long")).alias("nq"))
    # lengths are few; the shard numbers of all lengths follow one another
    first = F.coalesce(F.sum("shards").over(W.orderBy("dim").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    dims = dims.withColumn("shards", F.ceil(F.col("n") / shard_rows).cast("int")).withColumn("first", first).withColumn("blocks", F.greatest(F.ceil(F.col("nq") / query_rows), F.lit(1)).cast("int"))
    dims = F.broadcast(dims)
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30))
    placed = rows.join(dims, "dim").withColumn("shard", (F.col("first") + F.floor(salt * F.col("shards") / (1 << 30))).cast("long")).withColumn("block", F.concat_ws("-", "dim", F.floor(salt * F.col("blocks") / (1 << 30))))
    shards = placed.select("shard", "vec_id", "v").groupBy("shard").applyInPandas(_pack("shard", shard_rows), "shard long, dim int, ids binary, x binary")
    queries = placed.where("q").select("block", "vec_id", "v").groupBy("block").applyInPandas(_pack("block", query_rows), "block string, dim int, ids binary, x binary")
    queries = queries.join(dims.select("dim", "top", "first", "shards"), "dim").select("top", F.col("ids").alias("qids"), F.col("x").alias("qx"), F.explode(F.sequence(F.col("first").cast("long"), (F.col("first") + F.col("shards") - 1).cast("long"))).alias("shard"))
    met = shards.join(queries, "shard").select("shard", "dim", "top", "ids", "x", "qids", "qx")
    found = met.mapInPandas(_search(k, relax), "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
