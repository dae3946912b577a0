"""Feature building: financial aggregates and ratios, indicator / band / dummy encodings, scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.functions.columns import clip_lower, indicator, known, right_closed_bands, safe_ratio, smoothed_ratio, with_known
from veritab.operators.cumulative import exact_quantile_column



def add_financial_features(
    df: DataFrame,
    income: str = "income_annum",
    loan: str = "loan_amount",
    clipped_asset: str = "residential_assets_value",
    other_assets: Sequence[str] = ("commercial_assets_value", "luxury_assets_value", "bank_asset_value"),
) -> DataFrame:
    """``total_assets`` (clipped first asset + the others), loan/income and loan/assets ratios
    (0.0 where the denominator is 0 or missing), and ``net_worth_proxy`` = assets − loan."""
    total = clip_lower(F.col(clipped_asset), 0)
    for a in other_assets:
        total = total + F.col(a)
    df = df.withColumn("total_assets", total)
    return df.withColumns(
        {
            "loan_to_income_ratio": safe_ratio(loan, income),
            "loan_to_assets_ratio": safe_ratio(loan, "total_assets"),
            "net_worth_proxy": F.col("total_assets") - F.col(loan),
        }
    )


def add_smoothed_ratios(df: DataFrame, income: str = "income_annum", loan: str = "loan_amount", assets: str = "total_assets", smoothing: float = 1.0) -> DataFrame:
    """Exploratory variants with ``+smoothing`` denominators."""
    return df.withColumns(
        {
            "loan_income_ratio_smoothed": smoothed_ratio(loan, income, smoothing),
            "loan_assets_ratio_smoothed": smoothed_ratio(loan, assets, smoothing),
        }
    )


def flag_above_median(df: DataFrame, col: str, out: str) -> DataFrame:
    """``out`` = 1 where ``col`` exceeds its exact global median, else 0 (median as a scalar subquery)."""
    med = exact_quantile_column(df, col, 0.5)
    return df.withColumn(out, F.coalesce(known(df, col) > med, F.lit(False)).cast("int"))


def add_indicators(df: DataFrame, spec: Mapping[str, tuple[str, object]]) -> DataFrame:
    """``{out: (column, value)}`` → ``out`` = 1 where column == value else 0."""
    return df.withColumns({o: indicator(c, v) for o, (c, v) in spec.items()})


def add_bands(df: DataFrame, col: str, edges: Sequence[float], labels: Sequence[str] | None, out: str) -> DataFrame:
    """Right-closed labelled bands; the lowest edge and values above the top edge are NULL."""
    return df.withColumn(out, right_closed_bands(col, edges, labels))


MAX_CATEGORIES = 10_000  # each becomes a column of its own


def category_values(df: DataFrame, col: str, most: int = MAX_CATEGORIES) -> list[str]:
    """Sorted distinct non-null values of a column; more than ``most`` raise (:func:`clean.category_codes` has no such
    bound)."""
    rows = df.where(F.col(col).isNotNull()).select(col).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{col} has more than {most} values; encode it by category_codes")
    return sorted(r[0] for r in rows)


def one_hot_dummies(df: DataFrame, col: str, categories: Sequence[str] | None = None, drop_first: bool = True, keep: bool = False) -> DataFrame:
    """0/1 columns ``<col>_<category>`` over sorted categories; the first is dropped by default."""
    every = sorted(categories if categories is not None else category_values(df, col))
    cats = every[1:] if drop_first else every
    if categories is not None:  # a value outside the given list is an error, not a row of zeros
        c = F.col(col)
        unseen = c.isNotNull() & ~c.isin(*every)
        df = df.withColumn(col, F.when(unseen, F.raise_error(F.concat(F.lit(f"unseen category in {col}: "), c.cast("string"))).cast(df.schema[col].dataType)).otherwise(c))
    out = df.withColumns({f"{col}_{v}": indicator(col, v) for v in cats})
    return out if keep else out.drop(col)


def standardize(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """``(x − mean) / population std``; zero-variance columns give 0; missing values (NULL, NaN) are left out of
    the statistics and stay NULL. Stats are scalar subqueries of
    one aggregate (merged by the optimizer into a single pass)."""
    df = with_known(df, cols)
    stats = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)], *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)])
    new = {}
    for i, c in enumerate(cols):
        m = stats.select(f"m_{i}").scalar()
        s = stats.select(f"s_{i}").scalar()
        new[f"{c}{suffix}"] = F.when((s == 0) & F.col(c).isNotNull(), F.lit(0.0)).otherwise((F.col(c) - m) / s)
    return df.withColumns(new)
