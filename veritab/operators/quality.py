"""Data-quality reports (A1–A4, A21) as long-form DataFrames ``(metric, column, value)``.

Duplicate rows need a group-by over all columns; rows, nulls and negatives are derived from the same
grouped table (weighted by the group count), so the whole report is one scan and one shuffle of
distinct rows (partially aggregated on the map side, so repeated rows cost nothing to move).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from veritab.functions.columns import is_missing, known
from veritab.spec import CREDIT_SPEC

TABLE = "*"


def _row(metric: str, column: str, value, kind: str = "long"):
    return F.struct(F.lit(metric).alias("metric"), F.lit(column).alias("column"), value.cast(kind).alias("value"))


def _missing(df: DataFrame, c: str):
    return is_missing(df, c)


def quality_report(df: DataFrame, negative_check: Sequence[str] | None = None) -> DataFrame:
    """Rows, columns, duplicate rows, nulls per column, negatives per checked column (absent ones skipped).

    Row, null and negative counts are one global aggregate (partial sums per task, a tiny shuffle);
    duplicates come from :func:`duplicate_count` as a scalar subquery, so whole rows never cross a
    shuffle unless their row hash is shared."""
    negative_check = [c for c in (negative_check if negative_check is not None else CREDIT_SPEC.negative_check) if c in df.columns]
    cols = df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(_missing(df, c)).alias(f"null::{c}") for c in cols],
        *[F.count_if(F.col(f"`{c}`") < 0).alias(f"neg::{c}") for c in negative_check],
    )
    stack = [_row("rows", TABLE, F.col("__rows")),
             _row("columns", TABLE, F.lit(len(cols))),
             _row("duplicate_rows", TABLE, duplicate_count(df).select("duplicate_rows").scalar())]
    stack += [_row("null_count", c, F.col(f"`null::{c}`")) for c in cols]
    stack += [_row("negative_count", c, F.col(f"`neg::{c}`")) for c in negative_check]
    return wide.select(F.inline(F.array(*stack))).select("metric", "column", F.col("value").cast("long").alias("value"))


def _duplicates_among(hashed: DataFrame, shared: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``duplicate_rows`` (one row) among the rows of ``hashed`` whose ``keys`` occur in ``shared``."""
    candidates = hashed.join(shared, list(keys), "left_semi")
    grouped = candidates.groupBy(*[F.col(f"`{c}`") for c in hashed.columns]).agg(F.count(F.lit(1)).alias("__n"))
    return grouped.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def _row_hash(df: DataFrame):
    """64-bit hash of a whole row. Floating zeros are normalised first (``-0.0`` groups with ``0.0``)."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        parts.append(F.when(c == 0, F.lit(0).cast(f.dataType)).otherwise(c) if isinstance(f.dataType, (DoubleType, FloatType)) else c)
    return F.xxhash64(*parts)


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows after the first among fully equal rows (NULLs equal each other); one row ``duplicate_rows``.

    Exact, without shuffling whole rows of a mostly unique table: rows are first counted per 64-bit
    row hash (only the hash crosses the shuffle), and only rows whose hash occurs more than once
    (true duplicates plus hash collisions) are grouped by all their columns, which resolves collisions.
    Adaptive execution broadcasts the candidate hashes when they turn out few."""
    hashed = df.select(_row_hash(df).alias("__h"), *[F.col(f"`{c}`") for c in df.columns])
    shared = hashed.groupBy("__h").agg(F.count(F.lit(1)).alias("__k")).where(F.col("__k") > 1).select("__h")
    return _duplicates_among(hashed, shared, ["__h"])


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column plus ``*`` rows for the total and for rows holding any null: ``(column, nulls)``."""
    cols = df.columns
    any_null = None
    for c in cols:
        m = _missing(df, c)
        any_null = m if any_null is None else (any_null | m)
    aggs = [F.count_if(_missing(df, c)).alias(c) for c in cols]
    aggs.append(F.count_if(any_null if any_null is not None else F.lit(False)).alias("__rows_with_null"))
    wide = df.agg(*aggs)
    total = None
    for c in cols:
        total = F.col(f"`{c}`") if total is None else total + F.col(f"`{c}`")
    def entry(name, v):
        return F.struct(F.lit(name).alias("column"), v.cast("long").alias("nulls"))

    stack = [entry(c, F.col(f"`{c}`")) for c in cols]
    stack.append(entry("*total", total if total is not None else F.lit(0)))
    stack.append(entry("*rows_with_null", F.col("__rows_with_null")))
    return wide.select(F.inline(F.array(*stack))).select("column", F.col("nulls").cast("long").alias("nulls"))


def schema_profile(df: DataFrame) -> DataFrame:
    """Column, Spark type and non-null count, in column order (A21)."""
    aggs = [F.count(known(df, c)).alias(c) for c in df.columns]
    wide = df.agg(*aggs)
    stack = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"`{c}`").alias("non_null"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return wide.select(F.inline(F.array(*stack)))


def etl_report(raw: DataFrame, processed: DataFrame, numeric: Sequence[str], target: str) -> DataFrame:
    """ETL facts (A3) in long form ``(metric, column, value double)``.

    Raw and processed shape, negatives per numeric column before and after cleaning (only where > 0),
    total nulls, duplicates and the majority-class share of the target (4 places) of the processed
    table.
    """
    spark = raw.sparkSession
    num_raw = [c for c in numeric if c in raw.columns]
    num_proc = [c for c in numeric if c in processed.columns]
    before = raw.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(c) < 0).alias(c) for c in num_raw])
    before_long = before.select(F.inline(F.array(
        _row("rows_raw", TABLE, F.col("__rows"), "double"),
        *[_row("negative_before", c, F.col(c), "double") for c in num_raw],
    ))).where((F.col("metric") == "rows_raw") | (F.col("value") > 0))
    q = quality_report(processed, num_proc)
    renamed = F.when(F.col("metric") == "rows", "rows_processed").when(F.col("metric") == "columns", "cols_processed") \
        .when(F.col("metric") == "duplicate_rows", "duplicates").when(F.col("metric") == "negative_count", "negative_after")
    facts = q.where(F.col("metric").isin("rows", "duplicate_rows", "columns") | ((F.col("metric") == "negative_count") & (F.col("value") > 0))) \
        .select(renamed.alias("metric"), "column", F.col("value").cast("double").alias("value"))
    nulls = q.where(F.col("metric") == "null_count").agg(F.sum("value").cast("double").alias("value")).select(
        F.lit("nulls_total").alias("metric"), F.lit(TABLE).alias("column"), "value")
    vc = processed.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    bal = vc.agg((F.max("n") / F.sum("n")).alias("v")).select(
        F.lit("target_balance").alias("metric"), F.lit(target).alias("column"), F.bround("v", 4).alias("value"))
    cols_raw = spark.createDataFrame([("cols_raw", TABLE, float(len(raw.columns)))], "metric string, column string, value double")
    return before_long.unionByName(facts).unionByName(nulls).unionByName(bal).unionByName(cols_raw)


RAW_FLAG = "__neg_raw_"


def tag_raw_negatives(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add hidden ``__neg_raw_<col>`` flags (value < 0 before any cleaning) for :func:`etl_report_single_pass`."""
    return df.withColumns({f"{RAW_FLAG}{c}": (F.col(c) < 0).cast("long") for c in cols if c in df.columns})


def etl_report_single_pass(tagged: DataFrame, numeric: Sequence[str], target: str, raw_columns: int) -> DataFrame:
    """The ETL report (as :func:`etl_report`) from one scan and one shuffle.

    ``tagged`` is the processed table (row for row with the raw one) carrying the hidden raw-negative
    flags of :func:`tag_raw_negatives`. Raw counts, nulls, negatives and the target balance are sums
    per target class; duplicates use :func:`duplicate_count`.
    """
    flags = [c for c in tagged.columns if c.startswith(RAW_FLAG)]
    visible = [c for c in tagged.columns if c not in flags]
    num = [c for c in numeric if c in visible]
    # Sums per target class (few groups, combined map-side), then the global report; duplicates come
    # from the row-hash path, so whole rows only cross a shuffle when their hash is shared.
    per_target = tagged.groupBy(F.col(f"`{target}`").alias("__t")).agg(
        F.count(F.lit(1)).alias("rows"),
        sum((F.count_if(_missing(tagged, c)) for c in visible), F.lit(0)).alias("nulls"),
        *[F.count_if(F.col(f"`{c}`") < 0).alias(f"after::{c}") for c in num],
        *[F.sum(f).alias(f"before::{f[len(RAW_FLAG):]}") for f in flags],
    )
    known = F.col("__t").isNotNull()
    sums = [c for c in per_target.columns if c != "__t"]
    dups = duplicate_count(tagged.select(*[F.col(f"`{c}`") for c in visible])).select("duplicate_rows").scalar()
    wide = per_target.agg(
        *[F.sum(f"`{c}`").alias(c) for c in sums],
        F.bround(F.max(F.when(known, F.col("rows"))) / F.sum(F.when(known, F.col("rows"))), 4).alias("balance"),
    ).withColumn("dups", dups)
    entries = [
        _row("rows_raw", TABLE, F.col("rows"), "double"),
        _row("cols_raw", TABLE, F.lit(raw_columns), "double"),
        _row("rows_processed", TABLE, F.col("rows"), "double"),
        _row("cols_processed", TABLE, F.lit(len(visible)), "double"),
        _row("duplicates", TABLE, F.col("dups"), "double"),
        _row("nulls_total", TABLE, F.col("nulls"), "double"),
        _row("target_balance", target, F.col("balance"), "double"),
    ]
    entries += [_row("negative_before", f[len(RAW_FLAG):], F.col(f"`before::{f[len(RAW_FLAG):]}`"), "double") for f in flags]
    entries += [_row("negative_after", c, F.col(f"`after::{c}`"), "double") for c in num]
    return wide.select(F.inline(F.array(*entries))).where(~F.col("metric").startswith("negative_") | (F.col("value") > 0))
