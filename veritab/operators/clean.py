"""Projections and cleaning: drop/strip/select columns, strip values, clip negatives, encode targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veritab.functions.columns import clip_lower, known, strip
from veritab.session import require_checkpoint_dir
from veritab.spec import CREDIT_SPEC, TableSpec


def strip_column_names(df: DataFrame) -> DataFrame:
    """Header names without surrounding whitespace."""
    return df.toDF(*[c.strip() for c in df.columns])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    return df.drop(*cols)


def split_features_target(df: DataFrame, target: str, id_cols: Sequence[str] = ("loan_id",)) -> tuple[list[str], str]:
    """Feature column names (all but target and ids) and the target name; rows stay in one DataFrame."""
    drop = set(id_cols) | {target}
    return [c for c in df.columns if c not in drop], target


def select_model_columns(df: DataFrame, spec: TableSpec = CREDIT_SPEC, with_target: bool = False) -> DataFrame:
    cols = spec.model_columns + ([spec.target] if with_target else [])
    return df.select(*cols)


def strip_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: strip(F.col(c)) for c in cols if c in df.columns})


def negative_counts(df: DataFrame, cols: Sequence[str], lower: float = 0) -> DataFrame:
    """One row ``negatives_<col>`` = values below ``lower`` per column (lazy; evaluated only if used)."""
    cols = [c for c in cols if c in df.columns]
    return df.agg(*[F.count_if(F.col(c) < F.lit(lower)).alias(f"negatives_{c}") for c in cols]) if cols else df.limit(0).select()


def clip_negatives(df: DataFrame, cols: Sequence[str], lower: float = 0) -> tuple[DataFrame, DataFrame]:
    """Clip ``cols`` at ``lower``; also returns the (lazy) counts of values that were below it.

    The counts are a separate aggregate rather than a ``DataFrame.observe`` metric: on Spark 4.1 an
    observation registered on the session makes later ML fits fail to serialise their tasks.
    """
    cols = [c for c in cols if c in df.columns]
    counts = negative_counts(df, cols, lower)
    if not cols:
        return df, counts
    return df.withColumns({c: clip_lower(F.col(c), lower) for c in cols}), counts


def apply_quality_fixes(df: DataFrame, col: str = "residential_assets_value") -> DataFrame:
    """Deterministic fix: clip ``col`` at 0 when present; everything else untouched."""
    return df.withColumn(col, clip_lower(F.col(col), 0)) if col in df.columns else df


def clean_table(df: DataFrame, spec: TableSpec = CREDIT_SPEC) -> tuple[DataFrame, DataFrame]:
    """Strip header names, strip categorical and target values, clip the configured columns."""
    df = strip_column_names(df)
    df = strip_values(df, list(spec.categorical) + [spec.target])
    return clip_negatives(df, spec.clip_negative)


def encode_target_sorted(df: DataFrame, target: str, out: str | None = None):
    """Label-encode by sorted class order (first class → 0), as a fitted ``StringIndexer``.

    Returns the DataFrame and the fitted model (``labels`` lists the classes in code order).
    """
    from pyspark.ml.feature import StringIndexer

    out = out or target
    tmp = f"__{target}_idx"
    model = StringIndexer(inputCol=target, outputCol=tmp, stringOrderType="alphabetAsc", handleInvalid="keep").fit(df)
    enc = model.transform(df).withColumn(tmp, F.when(F.col(target).isNotNull(), F.col(tmp).cast("int")))  # missing stays missing
    if out == target:
        enc = enc.drop(target).withColumnRenamed(tmp, target).select(*df.columns)
    else:
        enc = enc.withColumnRenamed(tmp, out)
    return enc, model


def category_codes(df: DataFrame, col: str, descending: bool = False) -> DataFrame:
    """``(value, code, n)``: every known value of a column, its position in sorted order from 0, and its rows.

    For columns with any number of values: the distinct values are range-partitioned and sorted, a row's position is its
    place in its partition plus the rows of the partitions before, so neither the driver nor one task holds them all."""
    require_checkpoint_dir(df.sparkSession)
    counts = df.select(known(df, col).alias("value")).where("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    order = F.col("value").desc() if descending else F.col("value").asc()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the id holds the partition and the place in it; the checkpoint keeps both
    placed = counts.repartitionByRange(parts, order).sortWithinPartitions(order).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    placed = placed.select("value", "n", F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"))
    rows = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    first = rows.select("_part", (F.sum("_rows").over(W.orderBy("_part")) - F.col("_rows")).alias("_first"))  # a row per partition
    return placed.join(F.broadcast(first), "_part").select("value", (F.col("_first") + F.col("_at")).alias("code"), "n")


def encode_categories(df: DataFrame, col: str, codes: DataFrame, out: str | None = None, unseen: str = "error") -> DataFrame:
    """Replace (or add as ``out``) a column by its code in a dictionary of :func:`category_codes`.

    Missing values stay missing. A value outside the dictionary raises, or is NULL with ``unseen="null"``. The join
    is left to adaptive execution: broadcast by measured size, else sorted with hot values split."""
    if unseen not in ("error", "null"):
        raise ValueError(f"unseen={unseen!r}: 'error' or 'null'")
    out = out or col
    book = codes.select(F.col("value").alias("__value"), F.col("code").alias("__code"))
    rows = df.withColumn("__known", known(df, col)).join(book, F.col("__known") == F.col("__value"), "left")
    code = F.col("__code")
    if unseen == "error":
        code = F.when(F.col("__known").isNotNull() & code.isNull(), F.raise_error(F.concat(F.lit(f"unseen category in {col}: "), F.col("__known").cast("string"))).cast("long")).otherwise(code)
    names = [c for c in df.columns if c != out] + [out] if out not in df.columns else df.columns
    return rows.withColumn(out, code).select(*[F.col(f"`{c}`") for c in names])


def map_target(df: DataFrame, target: str, positive: str = "Approved", negative: str = "Rejected", out: str | None = None) -> DataFrame:
    """positive → 1, negative → 0, anything else → NULL."""
    c = F.col(target)
    code = F.when(c == F.lit(positive), F.lit(1)).when(c == F.lit(negative), F.lit(0))
    return df.withColumn(out or target, code)
