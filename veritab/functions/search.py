"""Sorted-array search as plain column expressions (no UDF).

``count_less_than`` is a branch-free-of-Python binary search: ``k`` chained ``CASE`` steps over an
array padded to ``2^k - 1`` entries with +inf, so the cost per row is ``log2`` of the array length
and the whole thing stays in whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pad_sorted(arr: Column, max_len: int) -> tuple[Column, int]:
    """Pad a sorted double array to ``2^k - 1`` entries with +inf; returns (column, k)."""
    k = max(1, int(max_len).bit_length())
    size = 2**k - 1
    padded = F.concat(
        arr.cast("array<double>"),
        F.array_repeat(F.lit(float("inf")), F.lit(size) - F.size(arr)),
    )
    return padded, k


def count_less_than(df: DataFrame, arr_col: str, value: Column, max_len: int, out: str) -> DataFrame:
    """Add ``out`` = number of entries of the sorted array ``arr_col`` strictly below ``value``.

    ``max_len`` bounds the array length. The array must be padded already (:func:`pad_sorted` on the small
    table it comes from), so that no row copies it.
    """
    k = max(1, int(max_len).bit_length())
    tmp_arr, tmp_v = arr_col, f"__{out}_v"
    df = df.withColumn(tmp_v, value.cast("double")).withColumn(out, F.lit(0))
    step = 2 ** (k - 1)
    while step >= 1:
        nxt = F.col(out) + F.lit(step)
        df = df.withColumn(
            out,
            F.when(F.element_at(F.col(tmp_arr), nxt) < F.col(tmp_v), nxt).otherwise(F.col(out)),
        )
        step //= 2
    return df.drop(tmp_v)
