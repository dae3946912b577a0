"""Tree ensembles grown level by level: regularised boosting (M3) and balanced random forests (M2).

Features are cut into at most MAX_BINS bins at exact quantiles and stored as bytes next to label, weight, fold and a
hash of the row's key. Rows with the same bins, label, weight and fold are the same to every tree but for their row
samples, so they are combined into one row with their number and their number in each bag (``combine``). One pass over
that table serves every tree that is growing, of all models being trained (folds of a cross-validation, trials of a
search, trees of a forest):

* tasks sum gradient, Hessian and rows per (tree, node, feature, bin) in arrays of bounded size, and one grouped
  aggregate adds them up; MOST_CELLS bounds the sums of a pass, on tasks and on the driver;
* the driver reads the best cut of every open node off these sums. Nodes beyond the bound wait for the next pass.

Boosting is second order with L1 and L2 terms (``reg_alpha``, ``reg_lambda``), row and column sampling. A forest is the
same with gradient -w·y and Hessian w: the gain is then the decrease of the Gini impurity and a leaf is the weighted
share of positives. Row samples come from the key hash, so they do not depend on partitions or retries.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritab.operators.cumulative import exact_quantiles
from veritab.operators.sampling import _hash60
from veritab.plans.scratch import drop_path, scratch_path

MAX_BINS = 64
MOST_CELLS = 1 << 20  # cells (node x feature x bin) summed in one pass; further nodes wait for the next pass
REFRESH = 4  # finished trees of a model that tasks add to the stored margins before the margins are written anew

WORTH_COMBINING = 2  # rows per combined row from which the combined table is used
COMBINED_ROWS = 1 << 18  # rows a task combines at once

# Smallest Hessian sum of a child, smallest gain of a cut.
MIN_CHILD_WEIGHT = 1.0
MIN_GAIN = 1e-8


@dataclass(frozen=True)
class Boosting:
    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.1
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    min_child_weight: float = MIN_CHILD_WEIGHT
    seed: int = 42


@dataclass(frozen=True)
class Forest:
    """``class_weight`` may be "balanced_subsample": classes weigh the same in every tree's own bag. Without a
    ``max_depth`` trees grow until their nodes are pure, so the model grows with the table."""

    n_estimators: int = 100
    max_depth: int | None = None
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    max_features: str | None = "sqrt"
    class_weight: str | None = None
    seed: int = 42


@dataclass
class Tree:
    """Node i sends bins up to ``cut[i]`` of ``feature[i]`` left; feature -1 is a leaf; bin 0 holds missing values."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool) -> tuple[int, int]:
        self.feature[node], self.cut[node], self.missing_left[node] = feature, cut, missing_left
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for _ in range(2):
            for column, start in ((self.feature, -1), (self.cut, 0), (self.missing_left, False), (self.left, 0), (self.right, 0), (self.value, 0.0)):
                column.append(start)
        return self.left[node], self.right[node]

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """Node every row ends in."""
        feature, cut, none = np.array(self.feature), np.array(self.cut), np.array(self.missing_left)
        left, right = np.array(self.left), np.array(self.right)
        at = np.zeros(len(bins), dtype=np.int64)
        rows = np.arange(len(bins))
        while True:
            rows = rows[feature[at[rows]] >= 0]
            if not len(rows):
                return at
            node = at[rows]
            b = bins[rows, feature[node]]
            at[rows] = np.where(np.where(b == 0, none[node], b <= cut[node]), left[node], right[node])

    def values(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaves(bins)]


@dataclass
class Ensemble:
    kind: str  # "boosting" or "forest"
    edges: list[list[float]]
    trees: list[Tree]

    def probability(self, features: np.ndarray) -> np.ndarray:
        return probability_of(self.kind, self.trees, bin_matrix(features, self.edges))


def probability_of(kind: str, trees: Sequence[Tree], bins: np.ndarray) -> np.ndarray:
    total = np.zeros(len(bins))
    for t in trees:
        total += t.values(bins)
    return total / max(1, len(trees)) if kind == "forest" else 1.0 / (1.0 + np.exp(-total))


def bin_matrix(features: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    """Bin 0 for missing values, else 1 + the number of edges below the value."""
    out = np.zeros(features.shape, dtype=np.uint8)
    for f, e in enumerate(edges):
        x = features[:, f]
        out[:, f] = np.where(np.isnan(x), 0, 1 + np.searchsorted(np.asarray(e, dtype=float), x, side="left"))
    return out


def row_draw(hashes: np.ndarray, seed: int, number: int) -> np.ndarray:
    """Uniform draw in [0, 1) of every row for the tree ``number``: a mixer of 64 bits over the row's key hash."""
    with np.errstate(over="ignore"):
        z = hashes.astype(np.uint64) + np.uint64((seed * 1_000_003 + number + 1) % (1 << 64)) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(18)])


def bag_counts(hashes: np.ndarray, seed: int, number: int) -> np.ndarray:
    """How often the bootstrap sample of a tree holds each row: Poisson(1) of its draw."""
    return np.searchsorted(_POISSON, row_draw(hashes, seed, number), side="right")


def _matrix(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), width)


def _columns(b: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [b.column(n).to_numpy(zero_copy_only=False) for n in names]


def bin_edges(df: DataFrame, features: str, max_bins: int = MAX_BINS) -> list[list[float]]:
    """Cuts of every entry of the array column ``features``: its distinct exact quantiles but the largest, at most
    ``max_bins`` - 1 numbers an entry."""
    width = df.select(F.size(features).alias("n")).first()
    width = width["n"] if width else 0
    long = df.select(F.posexplode(features).alias("feature", "value"))
    probs = [i / max_bins for i in range(max_bins + 1)]
    found = {r["feature"]: sorted(set(r["q"]))[:-1] for r in exact_quantiles(long, ["feature"], "value", probs, out="q").collect()}
    return [found.get(f, [])[: max_bins - 1] if len(found.get(f, [])) < max_bins else found[f][1:] for f in range(width)]


def binned_table(df: DataFrame, features: str, label: str, edges, key: Sequence[str] = (), weight: str | None = None, fold: str | None = None, seed: int = 42) -> tuple[DataFrame, str]:
    """(h, y, w, fold, bins) of every row, written once; ``h`` hashes the key columns, or the features where none are
    named (then equal rows share their draws)."""
    h = _hash60(seed, list(key)) if key else F.xxhash64(features, label)
    src = df.select(h.alias("h"), F.col(label).cast("double").alias("y"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"),
                    (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"), F.col(features).alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                x = np.array(b.column("x").values.to_numpy(zero_copy_only=False)[b.column("x").offsets[0].as_py():][: len(b) * len(edges)], dtype=float).reshape(len(b), len(edges))
                raw = bin_matrix(x, edges).tobytes()
                rows = [raw[i : i + len(edges)] for i in range(0, len(raw), len(edges))]
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("h", "y", "w", "fold")], pa.array(rows, pa.binary())], names=["h", "y", "w", "fold", "bins"])

    path = scratch_path(df.sparkSession, "binned")
    schema = "h long, y double, w double, fold int, bins binary"
    # the passes to come read this table again and again: every core gets a part of it
    src.mapInArrow(run, schema).repartition(df.sparkSession.sparkContext.defaultParallelism).write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path), path


def bootstrap_counts(table: DataFrame, n_trees: int, seed: int = 42) -> DataFrame:
    """(tree, y, bag, weight): rows of each class in each tree's bootstrap sample, and the class weight that makes the
    classes weigh the same in it: bag size / (classes · rows of the class)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, float], int] = {}
        for b in batches:
            h, y = _columns(b, "h", "y")
            for t in range(n_trees):
                c = bag_counts(h, seed, t)
                for cls in np.unique(y):
                    total[t, float(cls)] = total.get((t, float(cls)), 0) + int(c[y == cls].sum())
        keys = list(total)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.float64()), pa.array([total[k] for k in keys], pa.int64())], names=["tree", "y", "bag"])

    counts = table.select("h", "y").mapInArrow(run, "tree int, y double, bag long").groupBy("tree", "y").agg(F.sum("bag").alias("bag")).where("bag > 0")
    w = Window.partitionBy("tree")  # a row per class
    return counts.withColumn("weight", F.sum("bag").over(w) / (F.count(F.lit(1)).over(w) * F.col("bag")))


_GROUP = ("y", "w", "fold", "bins")


def _same_rows(columns: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A row of every group of equal rows, and the group of every row."""
    rows = np.concatenate([np.ascontiguousarray(c).view(np.uint8).reshape(len(columns["y"]), -1) for c in columns.values()], axis=1)
    _, first, group = np.unique(np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1]))).ravel(), return_index=True, return_inverse=True)
    return first, group.ravel()


def _bag_sums(width: int, seed: int, n_trees: int):
    """Rows of the binned table, or combined rows, -> combined rows: ``n`` rows, and for every tree of a forest how
    many of them its bag holds, repeated ones counted again (``bags``) or once (``hits``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[dict, np.ndarray]] = []

        def flush() -> tuple[dict, np.ndarray]:
            keys = {c: np.concatenate([k[c] for k, _ in held]) for c in _GROUP}
            first, group = _same_rows(keys)
            total = np.zeros((len(first), 1 + 2 * n_trees), dtype=np.int64)
            at = 0
            for k, own in held:
                rows = group[at : at + len(own)]
                order = np.argsort(rows, kind="stable")
                begin = np.flatnonzero(np.diff(rows[order], prepend=-1))
                total[rows[order][begin]] += np.add.reduceat(own[order], begin, axis=0, dtype=np.int64)
                at += len(own)
            return {c: v[first] for c, v in keys.items()}, total

        def emit(keys, total) -> pa.RecordBatch:
            size = len(total)
            cut = lambda m: pa.array([r.tobytes() for r in np.ascontiguousarray(m)], pa.binary())
            cols = [*[pa.array(keys[c]) for c in ("y", "w", "fold")], cut(keys["bins"]), pa.array(total[:, 0].copy()), cut(total[:, 1 : 1 + n_trees]), cut(total[:, 1 + n_trees :])]
            return pa.RecordBatch.from_arrays(cols, names=[*_GROUP, "n", "bags", "hits"]).slice(0, size)

        for b in batches:
            if not len(b):
                continue
            keys = dict(zip(("y", "w", "fold"), _columns(b, "y", "w", "fold"))) | {"bins": _matrix(b.column("bins"), width)}
            if "h" in b.schema.names:
                h = b.column("h").to_numpy()
                own = np.ones((len(b), 1 + 2 * n_trees), dtype=np.uint8)
                for t in range(n_trees):
                    own[:, 1 + t] = bag_counts(h, seed, t)
                own[:, 1 + n_trees :] = own[:, 1 : 1 + n_trees] > 0
            else:
                own = np.concatenate([b.column("n").to_numpy()[:, None], _totals(b.column("bags"), n_trees), _totals(b.column("hits"), n_trees)], axis=1)
            held.append((keys, own))
            if sum(len(o) for _, o in held) >= COMBINED_ROWS:
                held = [flush()]
                if len(held[0][1]) > COMBINED_ROWS // WORTH_COMBINING:
                    yield emit(*held.pop())
        if held:
            yield emit(*flush())

    return run


def _totals(column, n_trees: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.int64).reshape(len(column), n_trees)


def combine(table: DataFrame, edges, settings: Sequence[Boosting | Forest]) -> tuple[DataFrame, str | None]:
    """The binned table with equal rows combined, and its path; ``table`` itself and None where fewer than
    WORTH_COMBINING rows share one, or where rows must be told apart (row samples of boosting, bags of several seeds).
    Ensembles grown on either are the same up to the order of the sums."""
    forests = [h for h in settings if isinstance(h, Forest)]
    if any(isinstance(h, Boosting) and h.subsample < 1.0 for h in settings) or len({h.seed for h in forests}) > 1:
        return table, None
    spark = table.sparkSession
    n_trees = max([h.n_estimators for h in forests], default=0)
    rows, apart = table.agg(F.count(F.lit(1)), F.approx_count_distinct(F.struct(*_GROUP))).first()
    if rows < WORTH_COMBINING * apart:
        return table, None
    schema = "y double, w double, fold int, bins binary, n long, bags binary, hits binary"
    run = _bag_sums(len(edges), forests[0].seed if forests else 0, n_trees)
    parts = spark.sparkContext.defaultParallelism
    path = scratch_path(spark, "combined")
    # a group's rows meet in one part, which holds a share of the groups
    table.mapInArrow(run, schema).repartition(parts, *_GROUP).mapInArrow(run, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path), path


class _Grower:
    """A tree in the making: its open nodes with their depth, and the features a cut may use."""

    def __init__(self, model: int, number: int, how, fold: int | None, width: int, class_weights=None):
        self.model, self.number, self.how, self.fold, self.weights = model, number, how, fold, class_weights
        self.tree, self.open = Tree(), {0: 0}
        self.boosting = isinstance(how, Boosting)
        rng = random.Random(f"{how.seed}:{number}")
        self.allowed = list(range(width))
        if self.boosting and how.colsample_bytree < 1.0:
            self.allowed = sorted(rng.sample(range(width), max(1, int(how.colsample_bytree * width))))

    def columns(self, node: int, width: int) -> list[int]:
        """Features a cut of this node may use: a forest draws them anew for every node."""
        if self.boosting or not self.how.max_features:
            return self.allowed
        k = max(1, int(math.sqrt(width) if self.how.max_features == "sqrt" else math.log2(width))) if width > 1 else 1
        return random.Random(f"{self.how.seed}:{self.number}:{node}").sample(range(width), k)

    def leaf(self, g: float, h: float) -> float:
        if not self.boosting:
            return -g / h if h > 0 else 0.0
        soft = math.copysign(max(abs(g) - self.how.reg_alpha, 0.0), g)
        return -soft / (h + self.how.reg_lambda) * self.how.learning_rate if h + self.how.reg_lambda > 0 else 0.0

    def worth_opening(self, depth: int, g: float, h: float, n: int) -> bool:
        how = self.how
        if how.max_depth is not None and depth >= how.max_depth:
            return False
        if self.boosting:
            return h >= 2 * how.min_child_weight and n >= 2
        pure = -g <= 1e-12 * h or -g >= h * (1 - 1e-12)
        return not pure and n >= max(how.min_samples_split, 2 * how.min_samples_leaf)

    def take(self, node: int, whole: np.ndarray, best: tuple | None) -> None:
        """Close an open node: by its best cut, or as a leaf where there is none."""
        depth = self.open.pop(node)
        self.tree.value[node] = self.leaf(whole[0], whole[1])
        if best is None:
            return
        _, feature, cut, missing_left, left = best
        sides = self.tree.split(node, feature, cut, missing_left)
        for child, (g, h, n) in zip(sides, (left, whole - np.array(left))):
            self.tree.value[child] = self.leaf(g, h)
            if self.worth_opening(depth + 1, g, h, n):
                self.open[child] = depth + 1


def _row_weights(task: dict, b: pa.RecordBatch, y, w, fold, bags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Weight of every row of the table for a tree, and how many rows it stands for; ``bags`` holds a combined table's
    two counts by row and tree."""
    out = w if task["fold"] is None else np.where(fold != task["fold"], w, 0.0)
    how, combined = task["how"], "n" in b.schema.names
    if isinstance(how, Forest):
        if combined:
            bag, n = (counts[:, task["number"]] for counts in bags)
        else:
            bag, n = bag_counts(b.column("h").to_numpy(), how.seed, task["number"]), np.ones(len(b), dtype=np.int64)
        out = out * bag
        if task["weights"]:
            out = out * np.where(y == 1, task["weights"].get(1.0, 1.0), task["weights"].get(0.0, 1.0))
        return out, n
    n = b.column("n").to_numpy() if combined else np.ones(len(b), dtype=np.int64)
    if how.subsample < 1.0:
        out = np.where(row_draw(b.column("h").to_numpy(), how.seed, task["number"]) < how.subsample, out, 0.0)
    return out * n, n


def _sums(work: list[dict], pending: list[list[Tree]], width: int, slots: int):
    """Rows of the binned table -> (grower, node, f, bin, G, H, N) summed over the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros((len(t["nodes"]), width, slots, 3)) for t in work]
        for b in batches:
            if not len(b):
                continue
            y, w, fold = _columns(b, "y", "w", "fold")
            bins = _matrix(b.column("bins"), width)
            margins = None
            bags = [_totals(b.column(c), -1) for c in ("bags", "hits") if c in b.schema.names]
            for task, total in zip(work, held):
                weight, number = _row_weights(task, b, y, w, fold, bags)
                rows = np.flatnonzero(weight > 0)
                place = np.full(len(task["tree"].feature), -1)
                place[task["nodes"]] = np.arange(len(task["nodes"]))
                at = place[task["tree"].leaves(bins[rows])]
                rows, at = rows[at >= 0], at[at >= 0]
                own, label, number = weight[rows], y[rows], number[rows]
                if isinstance(task["how"], Boosting):
                    if margins is None:
                        margins = np.array(b.column("margins").flatten().to_numpy()).reshape(len(b), -1)
                    m = margins[rows, task["model"]]
                    for tree in pending[task["model"]]:
                        m = m + tree.values(bins[rows])
                    p = 1.0 / (1.0 + np.exp(-m))
                    g, hess = own * (p - label), own * p * (1.0 - p)
                else:
                    g, hess = -own * label, own
                size = len(task["nodes"]) * slots
                for f in range(width):
                    use = task["mask"][at, f]
                    cell = at[use] * slots + bins[rows[use], f]
                    for i, v in enumerate((g[use], hess[use], number[use])):
                        total[:, f, :, i] += np.bincount(cell, v, size).reshape(len(task["nodes"]), slots)
        for i, (task, total) in enumerate(zip(work, held)):
            node, f, bin_ = np.nonzero(total[..., 2])
            cells = total[node, f, bin_]
            cols = [np.full(len(node), i, dtype=np.int32), np.array(task["nodes"], dtype=np.int32)[node], f.astype(np.int32), bin_.astype(np.int32), cells[:, 0].copy(), cells[:, 1].copy(), cells[:, 2].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["grower", "node", "f", "bin", "G", "H", "N"])

    return run


def best_cuts(sums: np.ndarray, allowed: np.ndarray, how: Boosting | Forest) -> list[tuple | None]:
    """Best cut of every node from its (node, feature, bin, [G, H, rows]) sums: (gain, feature, bin, missing left,
    left sums), or None where none is allowed. Ties go to the first feature, then the lowest cut; gains are compared at
    eight decimals, so the order in which tasks were added up cannot matter."""
    boosting = isinstance(how, Boosting)
    alpha, lam, min_h = (how.reg_alpha, how.reg_lambda, how.min_child_weight) if boosting else (0.0, 0.0, 0.0)
    min_n, min_split = (1, 2) if boosting else (how.min_samples_leaf, how.min_samples_split)

    def term(g, h):
        soft = np.maximum(np.abs(g) - alpha, 0.0)
        return np.divide(soft * soft, h + lam, out=np.zeros_like(g), where=h + lam > 0)

    whole = sums.sum(axis=2, keepdims=True)
    upto, missing = np.cumsum(sums, axis=2), sums[:, :, :1]
    left = np.stack([upto - missing, upto], axis=3)  # missing values right, then left
    right = whole[:, :, :, None] - left
    gain = np.round(term(left[..., 0], left[..., 1]) + term(right[..., 0], right[..., 1]) - term(whole[..., 0], whole[..., 1])[..., None], 8)
    fits = (left[..., 2] >= max(1, min_n)) & (right[..., 2] >= max(1, min_n)) & (left[..., 1] >= min_h) & (right[..., 1] >= min_h)
    fits &= (whole[..., 2] >= min_split)[..., None] & (gain > MIN_GAIN) & allowed[:, :, None, None]
    fits[..., 1] &= missing[..., 2] > 0
    flat = np.where(fits, gain, -np.inf).reshape(len(sums), -1)
    out = []
    for node, best in enumerate(flat.argmax(axis=1) if flat.shape[1] else []):
        if flat[node, best] == -np.inf:
            out.append(None)
            continue
        f, bin_, to_left = np.unravel_index(best, gain.shape[1:])
        out.append((float(flat[node, best]), int(f), int(bin_), bool(to_left), tuple(left[node, f, bin_, to_left])))
    return out


def grow(table: DataFrame, edges, models: Sequence[tuple[Boosting | Forest, int | None]], progress=None, bagged: DataFrame | None = None) -> list[Ensemble]:
    """Train every model of ``models`` ((settings, fold left out or None)) on the binned table in common passes; where
    that is a combined one, ``bagged`` is the table it comes from, which balanced forests count their bags on."""
    spark = table.sparkSession
    width, slots = len(edges), max([len(e) for e in edges], default=0) + 2
    finished: list[dict[int, Tree]] = [{} for _ in models]
    pending: list[list[Tree]] = [[] for _ in models]
    growing: list[_Grower] = []
    bags: dict[tuple, dict] = {}
    for i, (how, fold) in enumerate(models):
        if isinstance(how, Boosting):
            if how.n_estimators > 0:
                growing.append(_Grower(i, 0, how, fold, width))
            continue
        if how.class_weight == "balanced_subsample" and (how.seed, how.n_estimators, fold) not in bags:
            source = table if bagged is None else bagged
            used = source if fold is None else source.where(F.col("fold") != fold)
            bag: dict = {}
            for r in bootstrap_counts(used, how.n_estimators, how.seed).collect():  # two rows per tree
                bag.setdefault(r["tree"], {})[r["y"]] = r["weight"]
            bags[how.seed, how.n_estimators, fold] = bag
        bag = bags.get((how.seed, how.n_estimators, fold), {}) if how.class_weight == "balanced_subsample" else {}
        growing += [_Grower(i, t, how, fold, width, bag.get(t)) for t in range(how.n_estimators)]
    state, old = table.withColumn("margins", F.array_repeat(F.lit(0.0), len(models))), None
    if "n" in table.columns:
        state = state.drop(*([] if any(isinstance(how, Forest) for how, _ in models) else ["bags", "hits"]))
    passes = 0
    while growing:
        work, cells = [], 0
        for grower in growing:
            room = (MOST_CELLS - cells) // (width * slots)
            nodes = list(grower.open)[: max(room, 0 if work else 1)]
            if not nodes:
                break
            cells += len(nodes) * width * slots
            mask = np.zeros((len(nodes), width), dtype=bool)
            for j, node in enumerate(nodes):
                mask[j, grower.columns(node, width)] = True
            work.append({"grower": grower, "model": grower.model, "number": grower.number, "how": grower.how, "fold": grower.fold, "tree": grower.tree, "nodes": nodes, "mask": mask, "weights": grower.weights})
        sent = [{k: v for k, v in t.items() if k != "grower"} for t in work]
        cells = state.mapInArrow(_sums(sent, pending, width, slots), "grower int, node int, f int, bin int, G double, H double, N long")
        found = cells.groupBy("grower", "node", "f", "bin").agg(F.sum("G").alias("G"), F.sum("H").alias("H"), F.sum("N").alias("N")).toArrow()  # at most MOST_CELLS rows
        passes += 1
        which, node, f, bin_, G, H, N = (found.column(c).to_numpy() for c in ("grower", "node", "f", "bin", "G", "H", "N"))
        for i, t in enumerate(work):
            at = which == i
            place = {n: j for j, n in enumerate(t["nodes"])}
            sums = np.zeros((len(place), width, slots, 3))
            if at.any():
                sums[[place[n] for n in node[at].tolist()], f[at], bin_[at]] = np.stack([G[at], H[at], N[at]], axis=1)
            cuts = best_cuts(sums, t["mask"], t["grower"].how)
            for n, j in place.items():
                whole = sums[j].sum(axis=1)
                t["grower"].take(n, whole[whole[:, 2].argmax()] if width else np.zeros(3), cuts[j] if cuts else None)
        still = []
        for grower in growing:
            if grower.open:
                still.append(grower)
                continue
            finished[grower.model][grower.number] = grower.tree
            if grower.boosting:
                pending[grower.model].append(grower.tree)
                if grower.number + 1 < grower.how.n_estimators:
                    still.append(_Grower(grower.model, grower.number + 1, grower.how, grower.fold, width))
        growing = still
        if growing and max(map(len, pending)) >= REFRESH:
            state, new = _refresh(state, pending, width)
            pending = [[] for _ in models]
            if old:
                drop_path(spark, old)
            old = new
        if progress:
            progress(passes, len(growing))
    if old:
        drop_path(spark, old)
    return [Ensemble("boosting" if isinstance(how, Boosting) else "forest", [list(e) for e in edges], [t for _, t in sorted(done.items())]) for (how, _), done in zip(models, finished)]


def _refresh(state: DataFrame, pending: list[list[Tree]], width: int) -> tuple[DataFrame, str]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            bins = _matrix(b.column("bins"), width)
            margins = np.array(b.column("margins").flatten().to_numpy()).reshape(len(b), -1)
            for i, trees in enumerate(pending):
                for t in trees:
                    margins[:, i] += t.values(bins)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, margins.size + 1, margins.shape[1]), pa.int32()), pa.array(margins.ravel()))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in others], flat], names=[*others, "margins"])

    others = [c for c in state.columns if c != "margins"]
    path = scratch_path(state.sparkSession, "margins")  # as many files as the table had parts
    schema = state.schema
    state.mapInArrow(run, schema).write.parquet(path)
    return state.sparkSession.read.schema(schema).parquet(path), path


def score_models(table: DataFrame, ensembles: Sequence[Ensemble], names: Sequence[tuple]) -> DataFrame:
    """(trial, fold, side, y, p, n) of every row of the binned table under every model, in one pass; ``names`` gives
    each model's (trial, fold left out or None): rows of that fold are its ``val`` side. ``n`` is the number of rows
    that a combined row stands for, else 1."""
    width = len(ensembles[0].edges)
    kinds, trees = [e.kind for e in ensembles], [e.trees for e in ensembles]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            y, fold = _columns(b, "y", "fold")
            bins = _matrix(b.column("bins"), width)
            n = b.column("n") if "n" in b.schema.names else pa.array(np.ones(len(b), dtype=np.int64))
            for kind, own, (trial, left_out) in zip(kinds, trees, names):
                side = np.where(fold == (-2 if left_out is None else left_out), "val", "train")
                cols = [pa.array(np.full(len(b), trial, dtype=np.int32)), pa.array(np.full(len(b), -1 if left_out is None else left_out, dtype=np.int32)), pa.array(side), pa.array(y.astype(np.int32)), pa.array(probability_of(kind, own, bins)), n]
                yield pa.RecordBatch.from_arrays(cols, names=["trial", "fold", "side", "y", "p", "n"])

    return table.mapInArrow(run, "trial int, fold int, side string, y int, p double, n long")


class TreeClassifier(Estimator):
    """Boosting or forest on a features vector, with the columns of Spark's own classifiers in its output."""

    def __init__(self, how: Boosting | Forest, featuresCol: str = "features", labelCol: str = "label", weightCol: str | None = None, keyCols: Sequence[str] = (), maxBins: int = MAX_BINS):
        super().__init__()
        self.how, self.featuresCol, self.labelCol, self.weightCol, self.keyCols, self.maxBins = how, featuresCol, labelCol, weightCol, tuple(keyCols), maxBins

    def prepare(self, df: DataFrame, fold: str | None = None) -> tuple[DataFrame, str, list[list[float]]]:
        """The binned table of ``df`` (with its path) and the edges."""
        cols = [c for c in dict.fromkeys([*self.keyCols, self.labelCol, self.weightCol, fold]) if c]
        src = df.select(*cols, vector_to_array(self.featuresCol).alias("__x"))
        edges = bin_edges(src, "__x", self.maxBins)
        table, path = binned_table(src, "__x", self.labelCol, edges, self.keyCols, self.weightCol, fold, self.how.seed)
        return table, path, edges

    def _fit(self, df: DataFrame) -> "TreeClassifierModel":
        table, path, edges = self.prepare(df)
        rows, combined = combine(table, edges, [self.how])
        balanced = isinstance(self.how, Forest) and self.how.class_weight == "balanced_subsample"
        ensemble = grow(rows, edges, [(self.how, None)], bagged=table if balanced else None)[0]
        for p in (path, combined):
            if p:
                drop_path(df.sparkSession, p)
        return TreeClassifierModel(ensemble, self.how, self.featuresCol)


class TreeClassifierModel(Model, MLWritable, MLReadable):
    def __init__(self, ensemble: Ensemble, how, featuresCol: str = "features"):
        super().__init__()
        self.ensemble, self.how, self.featuresCol = ensemble, how, featuresCol

    @property
    def numFeatures(self) -> int:
        return len(self.ensemble.edges)

    def _transform(self, df: DataFrame) -> DataFrame:
        ensemble = self.ensemble

        @F.pandas_udf("double")
        def probability(x):
            import pandas as pd

            return pd.Series(ensemble.probability(np.stack(x.to_numpy())) if len(x) else [], dtype="float64")

        out = df.withColumn("__p1", probability(vector_to_array(self.featuresCol)))
        p = F.col("__p1")
        return out.withColumn("probability", array_to_vector(F.array(1 - p, p))).withColumn("rawPrediction", F.col("probability")).withColumn("prediction", (p > 0.5).cast("double")).drop("__p1")

    def settings(self) -> dict:
        return asdict(self.how)

    def write(self) -> MLWriter:
        return _TreeWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TreeReader()


class _TreeWriter(MLWriter):
    def __init__(self, instance: TreeClassifierModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        m = self.instance
        kept = {"kind": m.ensemble.kind, "edges": m.ensemble.edges, "trees": [asdict(t) for t in m.ensemble.trees], "how": asdict(m.how), "featuresCol": m.featuresCol}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={"model": json.dumps(kept)})


class _TreeReader(MLReader):
    def load(self, path: str) -> TreeClassifierModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        kept = json.loads(meta["model"])
        how = (Boosting if kept["kind"] == "boosting" else Forest)(**kept["how"])
        model = TreeClassifierModel(Ensemble(kept["kind"], kept["edges"], [Tree(**t) for t in kept["trees"]]), how, kept["featuresCol"])
        model._resetUid(meta["uid"])
        return model
