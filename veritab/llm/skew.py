"""Joins and filters that stay bounded when one key holds a large share of all rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_FILTER_BITS = 1 << 26  # 8 MB; a fuller filter only lets more rows through


def join_counted(rows: DataFrame, small: DataFrame, key: str, count: str, spread: list[str], total: int) -> DataFrame:
    """Left join of ``rows`` with ``small``, which has one row per ``key`` and in ``count`` how many of the ``total``
    rows have it. ``count`` itself is not in the result.

    Keys of more than sqrt(total) rows are split over several tasks by a hash of ``spread``; there are at most
    sqrt(total) such keys, so the table of them that is broadcast is small at every size."""
    most = max(1, int(total**0.5))
    small = small.withColumn("__parts", F.greatest(F.lit(1), F.ceil(F.col(count) / most)).cast("int")).drop(count)
    hot = small.where("__parts > 1").select(F.col(key).alias("__hot"), F.col("__parts").alias("__of"))
    salted = rows.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left")
    salted = salted.withColumn("__salt", F.when(F.col("__of").isNull(), 0).otherwise(F.pmod(F.xxhash64(*spread), F.col("__of"))).cast("int")).drop("__hot", "__of")
    copies = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1))).drop("__parts")
    return salted.join(copies, [key, "__salt"], "left").drop("__salt")


def bit_filter(keys: DataFrame, key: str, most_bits: int = MAX_FILTER_BITS) -> np.ndarray:
    """Bitmap of the 64-bit ``key`` values (bit = low bits of the key), at most ``most_bits`` large: the executors
    combine it into words of 64 bits, so what reaches the driver is bounded by the bitmap's size."""
    n = keys.count()
    bits = 1 << 10
    while bits < 16 * n and bits < most_bits:
        bits *= 2
    place = F.col(key).bitwiseAND(F.lit(bits - 1))
    parts = keys.select(F.shiftright(place, 6).cast("int").alias("at"), F.expr(f"shiftleft(1L, cast({key} & 63L as int))").alias("bit"))
    got = parts.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, dtype=np.int64)
    out[got.column("at").to_numpy()] = got.column("bits").to_numpy()
    return out


def in_filter(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys.astype(np.int64) & np.int64(len(bitmap) * 64 - 1)
    return (bitmap[place >> 6] >> (place & 63)) & 1 == 1
