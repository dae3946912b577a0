"""Scalar column expressions with pandas-compatible null semantics.

Missing means ``NULL`` or, on floating columns, ``NaN``. Every ratio is divide-safe under ANSI
mode, and clipping keeps missing values missing (``greatest(null, 0)`` would turn them into 0).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

_WS = r"^\s+|\s+$"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Remove leading/trailing whitespace incl. tabs and newlines (``trim`` keeps those)."""
    return F.regexp_replace(_c(c), _WS, "")


def clip_lower(c: str | Column, lower: float | int = 0) -> Column:
    """``clip(lower=…)``: values below ``lower`` become ``lower``; NULL and NaN stay as they are."""
    col = _c(c)
    return F.when(col < F.lit(lower), F.lit(lower)).otherwise(col)


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN when the column is floating point."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def known(df: DataFrame, name: str) -> Column:
    """The column with NaN read as NULL (other types unchanged): the one rule for missing values."""
    col = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return F.when(~F.isnan(col), col)
    return col


def with_known(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """``df`` with NaN turned into NULL in the named (default: all) floating-point columns."""
    names = df.columns if names is None else names
    floats = [c for c in dict.fromkeys(names) if isinstance(df.schema[c].dataType, (DoubleType, FloatType))]
    return df.withColumns({c: known(df, c) for c in floats}) if floats else df


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` with 0.0 where the denominator is 0 or either side is missing."""
    q = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return F.coalesce(F.nanvl(q, F.lit(None).cast("double")), F.lit(0.0))


def smoothed_ratio(num: str | Column, den: str | Column, smoothing: float = 1.0) -> Column:
    """Exploratory ratio ``num / (den + smoothing)``."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double") + F.lit(float(smoothing)))


def indicator(c: str | Column, value) -> Column:
    """1 where the column equals ``value``, else 0 (missing compares unequal)."""
    return _c(c).eqNullSafe(F.lit(value)).cast("int")


def right_closed_bands(c: str | Column, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """Label of the right-closed interval ``(e[i], e[i+1]]`` holding the value.

    As with ``pd.cut`` defaults, the lowest edge itself and values above the top edge get NULL.
    """
    if len(edges) < 2:
        raise ValueError("need at least two edges")
    if any(b <= a for a, b in zip(edges, edges[1:])):
        raise ValueError("edges must increase strictly")
    if labels is None:
        labels = [f"({a}, {b}]" for a, b in zip(edges, edges[1:])]
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    col = _c(c)
    expr = None
    for lo, hi, lab in zip(edges, edges[1:], labels):
        cond = (col > F.lit(lo)) & (col <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def hash_hex(seed: int | str, *keys: str | Column) -> Column:
    """First 8 hex digits of ``md5('<seed>|k1|k2…')``: a repeatable, partition-independent draw."""
    parts = [F.lit(str(seed))] + [_c(k).cast("string") for k in keys]
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8)


def hash_threshold_hex(fraction: float) -> str:
    """The 8-hex-digit cut such that about ``fraction`` of draws fall below it."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be within [0, 1]")
    return format(min(int(fraction * 2**32), 2**32 - 1), "08x") if fraction < 1.0 else "g"


def hash_below(seed: int | str, keys: Sequence[str | Column], fraction: float) -> Column:
    """True for about ``fraction`` of rows, chosen by key hash (no shuffle, no driver state)."""
    return hash_hex(seed, *keys) < F.lit(hash_threshold_hex(fraction))


def format_percent(c: str | Column, decimals: int = 1) -> Column:
    """``'12.3%'``-style text of a percentage value."""
    return F.format_string(f"%.{decimals}f%%", _c(c))
