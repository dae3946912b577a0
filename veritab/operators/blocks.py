"""Feature vectors in blocks of rows, for fits that read the same table again and again: a block's labels, folds and
features are three byte strings, so a pass costs no conversion of single rows."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.plans.scratch import scratch_path

BLOCK_ROWS = 4096
PARTS_A_CORE = 4
SCHEMA = "rows int, y binary, fold binary, x binary"


def block_table(df: DataFrame, features: str, label: str, fold: str | None = None) -> tuple[DataFrame, str]:
    """The rows of ``df`` in blocks, written once, with their path; fold -1 where no column names it."""
    spark = df.sparkSession
    path = scratch_path(spark, "blocks")
    src = df.select(F.col(label).cast("double").alias("y"), (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"), vector_to_array(features).alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), BLOCK_ROWS):
                b = whole.slice(at, BLOCK_ROWS)
                cols = [b.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold")] + [b.column("x").flatten().to_numpy(zero_copy_only=False)]
                yield pa.RecordBatch.from_arrays([pa.array([len(b)], pa.int32()), *[pa.array([c.tobytes()], pa.binary()) for c in cols]], names=["rows", "y", "fold", "x"])

    # the passes to come read this table again and again: every core gets a part of it
    src.mapInArrow(run, SCHEMA).repartition(PARTS_A_CORE * spark.sparkContext.defaultParallelism).write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path), path


def block_rows(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Labels, folds, and features with a column of ones, of every block."""
    for rows, y, fold, x in zip(*(b.column(c).to_pylist() for c in ("rows", "y", "fold", "x"))):
        x = np.frombuffer(x, dtype=np.float64).reshape(rows, -1)
        yield np.frombuffer(y, dtype=np.float64), np.frombuffer(fold, dtype=np.int32), np.concatenate([x, np.ones((rows, 1))], axis=1)


def first_row(table: DataFrame) -> np.ndarray | None:
    """Features of one row, with a one; None of an empty table."""
    b = table.limit(1).toArrow()
    return next(x[0] for _, _, x in block_rows(b.to_batches()[0])) if len(b) else None


def fold_moments(table: DataFrame) -> dict[int, tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, positives, sums, sums of squares, largest sizes) of the features of every fold's own rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for y, fold, x in block_rows(b):
                for f in np.unique(fold):
                    own = x[fold == f, :-1]
                    cols = [[int(f)], [len(own)], [int((y[fold == f] == 1).sum())], [own.sum(axis=0)], [(own * own).sum(axis=0)], [np.abs(own).max(axis=0)]]
                    types = [pa.int32(), pa.int64(), pa.int64(), *[pa.list_(pa.float64())] * 3]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["fold", "n", "pos", "s", "ss", "most"])

    found = table.mapInArrow(run, "fold int, n long, pos long, s array<double>, ss array<double>, most array<double>")
    parts = found.select("fold", "n", "pos", F.posexplode(F.arrays_zip("s", "ss", "most")).alias("at", "v"))
    parts = parts.groupBy("fold", "at").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"), F.sum("v.s").alias("s"), F.sum("v.ss").alias("ss"), F.max("v.most").alias("most"))
    out: dict = {}
    for r in parts.orderBy("fold", "at").collect():  # a row a fold and feature
        _, _, s, ss, most = out.setdefault(r["fold"], (r["n"], r["pos"], [], [], []))
        s.append(r["s"]), ss.append(r["ss"]), most.append(r["most"])
    return {f: (n, pos, *map(np.array, v)) for f, (n, pos, *v) in out.items()}


def fold_maps(moments: dict, folds, n_numeric: int, factor: float) -> tuple[dict, dict, dict]:
    """For every fold left out (None: no rows): the matrix that maps (features, 1) of the table to those under the
    fold's own standardisation (its first ``n_numeric`` features, stretched by ``factor``; none for None), the rows and
    positives that are left, and the variance of all their standardised entries."""
    maps, sizes, spreads = {}, {}, {}
    for left_out in set(folds):
        own = [m for f, m in moments.items() if f != left_out]
        width = len(next(iter(moments.values()))[2])
        n, positives = sum(m[0] for m in own), sum(m[1] for m in own)
        s, ss = (sum((m[i] for m in own), np.zeros(width)) for i in (2, 3))
        a = np.eye(width + 1)
        if left_out is not None and n > 1:
            for c in range(n_numeric):
                mean, var = s[c] / n, max(ss[c] - s[c] * s[c] / n, 0.0) / (n - 1)
                scale = factor / math.sqrt(var) if var > 1e-14 * ss[c] / n else 0.0
                a[c, c], a[c, -1] = scale, -scale * mean
        scale, shift = np.diag(a)[:-1], a[:-1, -1]
        of_entries, of_squares = (scale * s + n * shift).sum(), (scale * scale * ss + 2 * scale * shift * s + n * shift * shift).sum()
        count = max(n * width, 1)
        maps[left_out], sizes[left_out] = a, (n, positives)
        spreads[left_out] = max(of_squares / count - (of_entries / count) ** 2, 0.0)
    return maps, sizes, spreads
