"""Equi-joins on group keys where NULL matches NULL.

Grouping treats a NULL key as one group; joining a grouped result back on that key with plain
equality would drop (inner) or blank (left) that group. Spark plans ``<=>`` keys as ordinary hash
equi-join keys, so this costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                   broadcast_right: bool = False) -> DataFrame:
    """Join on ``keys`` (present on both sides) with NULL-safe equality; the output keeps the left keys.
    Keys that are non-nullable on both sides take a plain equi-join."""
    keys = list(keys)
    if not any(left.schema[k].nullable or right.schema[k].nullable for k in keys):
        return left.join(F.broadcast(right) if broadcast_right else right, keys, how)
    r = right.select(*[F.col(f"`{c}`").alias(f"_nk_{c}") if c in keys else F.col(f"`{c}`") for c in right.columns])
    if broadcast_right:
        r = F.broadcast(r)
    cond = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_nk_{k}`")) for k in keys]
    return left.join(r, cond, how).drop(*[f"_nk_{k}" for k in keys])
