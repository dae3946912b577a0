"""Repeatable sampling and splitting from key hashes (R1–R4).

A row's draw is ``md5('<seed>|<key…>')``: independent of partitioning, task retries and executor
loss (a recomputed task draws the same rows), needs no shuffle, and can be reproduced in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.functions.columns import hash_below, hash_hex, hash_threshold_hex
from veritab.operators.cumulative import running_totals
from veritab.operators.joins import join_null_safe


BROADCAST_CLASSES = 100_000  # the one-row-per-class table is broadcast up to this measured size


def hash_sample(df: DataFrame, fraction: float, seed: int, key_cols: Sequence[str]) -> DataFrame:
    """About ``fraction`` of the rows, without replacement, chosen by key hash."""
    return df.where(hash_below(seed, key_cols, fraction))


def weighted_choice(seed: int | str, key_cols: Sequence[str], values: Sequence, weights: Sequence[float]) -> Column:
    """One of ``values`` per row with the given probabilities, from the key hash."""
    if abs(sum(weights) - 1.0) > 1e-9:
        raise ValueError("weights must sum to 1")
    h = hash_hex(seed, *key_cols)
    expr = None
    acc = 0.0
    for v, w in zip(values[:-1], weights[:-1]):
        acc += w
        cond = h < F.lit(hash_threshold_hex(acc))
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    last = F.lit(values[-1])
    return last if expr is None else expr.otherwise(last)


def _hash60(seed: int | str, key_cols: Sequence[str]) -> Column:
    parts = [F.lit(str(seed))] + [F.col(k).cast("string") for k in key_cols]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("long")


def stratified_split(
    df: DataFrame,
    label: str,
    key_cols: Sequence[str],
    test_size: float = 0.2,
    seed: int = 42,
    exact: bool = False,
    out: str = "split",
) -> DataFrame:
    """Tag every row ``train`` or ``test`` (disjoint and complete).

    Default: hash split (no shuffle; class shares kept in expectation). ``exact=True``: in each class
    exactly ``round(test_size · n_class)`` rows with the smallest key hashes go to test; the cut-off per
    class comes from distributed running counts, and rows tied on the cut-off hash are ordered by key.
    """
    if not exact:
        return df.withColumn(out, F.when(hash_below(seed, key_cols, test_size), F.lit("test")).otherwise(F.lit("train")))
    h = _hash60(seed, key_cols)
    tagged = df.withColumn("__h", h)
    counts = tagged.groupBy(label, "__h").agg(F.count(F.lit(1)).alias("__n"))
    rt = running_totals(counts, [label], "__h", ["__n"])
    want = F.floor(F.col("total___n") * F.lit(test_size) + F.lit(0.5))
    # The hash where the running count first reaches the wanted size, and how many of its rows to take.
    cut = rt.where((F.col("cum___n") >= want) & (F.col("cum___n") - F.col("__n") < want)).select(
        label, F.col("__h").alias("__hstar"), (want - (F.col("cum___n") - F.col("__n"))).alias("__take")
    )
    cut = cut.checkpoint(eager=True)  # one row per class
    j = join_null_safe(tagged, cut, [label], "left", broadcast_right=cut.count() <= BROADCAST_CLASSES)
    clear = j.where(F.col("__hstar").isNull() | (F.col("__h") != F.col("__hstar"))).withColumn(
        out, F.when(F.col("__h") < F.col("__hstar"), F.lit("test")).otherwise(F.lit("train"))
    )
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in key_cols])
    tie = j.where(F.col("__h") == F.col("__hstar"))
    tie = tie.withColumn("__rn", F.row_number().over(Window.partitionBy(label, "__h").orderBy(key))).withColumn(
        out, F.when(F.col("__rn") <= F.col("__take"), F.lit("test")).otherwise(F.lit("train"))
    ).drop("__rn")
    return clear.unionByName(tie).drop("__h", "__hstar", "__take")


def stratified_folds(
    df: DataFrame, label: str, key_cols: Sequence[str], k: int = 5, seed: int = 42, exact: bool = False, out: str = "fold"
) -> DataFrame:
    """Fold number 0…k−1 per row, balanced within each class.

    Default: hash bucket of the key. ``exact=True``: rows of a class in hash order are dealt round-robin
    (rank mod k), so fold sizes within a class differ by at most one (rows sharing a 60-bit hash share
    a fold).
    """
    h = _hash60(seed, key_cols)
    if not exact:
        return df.withColumn(out, F.pmod(h, F.lit(k)).cast("int"))
    tagged = df.withColumn("__h", h)
    counts = tagged.groupBy(label, "__h").agg(F.count(F.lit(1)).alias("__n"))
    rt = running_totals(counts, [label], "__h", ["__n"]).select(label, "__h", (F.pmod(F.col("cum___n") - 1, F.lit(k))).cast("int").alias(out))
    return join_null_safe(tagged, rt, [label, "__h"]).drop("__h")
