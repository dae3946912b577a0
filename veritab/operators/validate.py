"""Validation: required-column / null / negative gates and record rules with quarantine (P5–P11)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.functions.columns import is_missing, known, strip


class GateError(ValueError):
    """A validation gate refused the table."""


def negative_rows(df: DataFrame, value_col: str, show: Sequence[str], order_by: str, n: int = 10) -> DataFrame:
    """First ``n`` rows (by ``order_by``) whose ``value_col`` is negative, projected to ``show``."""
    return df.where(F.col(value_col) < 0).select(*show).orderBy(order_by).limit(n)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in required if c not in have]


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    miss = missing_columns(df, required)
    if miss:
        raise GateError(f"missing required columns: {miss}")


def gate_counts(df: DataFrame, required: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """One pass: ``(position, column, nulls, negatives)`` for the required columns (negatives only for
    numeric ones, else NULL)."""
    num = set(numeric)
    aggs = []
    for c in required:
        aggs.append(F.count_if(is_missing(df, c)).alias(f"n::{c}"))
        if c in num:
            aggs.append(F.count_if(F.col(c) < 0).alias(f"g::{c}"))
    wide = df.agg(*aggs)
    arr = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column"),
            F.col(f"`n::{c}`").alias("nulls"),
            (F.col(f"`g::{c}`") if c in num else F.lit(None).cast("long")).alias("negatives"),
        )
        for i, c in enumerate(required)
    ]
    return wide.select(F.inline(F.array(*arr)))


def run_gates(df: DataFrame, required: Sequence[str], numeric: Sequence[str], null_mode: str = "per_column") -> None:
    """Raise on: missing columns; any null (per column or as a grand total); the first numeric column
    (in column order) holding a negative. One aggregate job for all checks."""
    require_columns(df, required)
    rows = sorted(gate_counts(df, required, numeric).collect(), key=lambda r: r["position"])  # len(required) rows
    with_nulls = {r["column"]: r["nulls"] for r in rows if r["nulls"]}
    if with_nulls:
        if null_mode == "total":
            raise GateError(f"table holds {sum(with_nulls.values())} nulls")
        raise GateError(f"null values per column: {with_nulls}")
    for r in rows:
        if r["negatives"]:
            raise GateError(f"negative values in {r['column']}: {r['negatives']}")


@dataclass(frozen=True)
class Rule:
    """A record rule. ``kind``: ``range`` (lo/hi with inclusivity), ``domain`` (stripped value in
    ``allowed``) or ``required``. NULL always violates the ``<column>:required`` rule."""

    name: str
    column: str
    kind: str = "range"
    lo: float | None = None
    hi: float | None = None
    lo_inclusive: bool = True
    hi_inclusive: bool = True
    allowed: tuple[str, ...] = ()

    def violated(self, df: DataFrame):
        c = known(df, self.column)  # NaN is missing, like NULL
        if self.kind == "required":
            return c.isNull()
        if self.kind == "domain":
            return c.isNotNull() & ~strip(c.cast("string")).isin(*self.allowed)
        bad = F.lit(False)
        if self.lo is not None:
            bad = bad | ((c < F.lit(self.lo)) if self.lo_inclusive else (c <= F.lit(self.lo)))
        if self.hi is not None:
            bad = bad | ((c > F.lit(self.hi)) if self.hi_inclusive else (c >= F.lit(self.hi)))
        return c.isNotNull() & bad


# The credit-request rules (ranges and allowed text values).
CREDIT_REQUEST_RULES: tuple[Rule, ...] = (
    Rule("no_of_dependents:0..10", "no_of_dependents", lo=0, hi=10),
    Rule("income_annum:>0", "income_annum", lo=0, lo_inclusive=False),
    Rule("loan_amount:>0", "loan_amount", lo=0, lo_inclusive=False),
    Rule("loan_term:1..30", "loan_term", lo=1, hi=30),
    Rule("cibil_score:300..900", "cibil_score", lo=300, hi=900),
    Rule("residential_assets_value:>=0", "residential_assets_value", lo=0),
    Rule("commercial_assets_value:>=0", "commercial_assets_value", lo=0),
    Rule("luxury_assets_value:>=0", "luxury_assets_value", lo=0),
    Rule("bank_asset_value:>=0", "bank_asset_value", lo=0),
    Rule("education:domain", "education", kind="domain", allowed=("Graduate", "Not Graduate")),
    Rule("self_employed:domain", "self_employed", kind="domain", allowed=("Yes", "No")),
)


def with_required(rules: Sequence[Rule]) -> list[Rule]:
    cols = list(dict.fromkeys(r.column for r in rules))
    return [Rule(f"{c}:required", c, kind="required") for c in cols] + list(rules)


def validate_records(df: DataFrame, rules: Sequence[Rule] = CREDIT_REQUEST_RULES, required: bool = True) -> DataFrame:
    """Add ``violations`` (names of broken rules, in rule order) and ``is_valid``; per row, no shuffle,
    usable on streaming DataFrames as well."""
    rs = with_required(rules) if required else list(rules)
    missing = [r.column for r in rs if r.column not in df.columns]
    if missing:
        raise GateError(f"missing required columns: {sorted(set(missing))}")
    flags = F.array(*[F.when(r.violated(df), F.lit(r.name)) for r in rs])
    v = F.filter(flags, lambda x: x.isNotNull())
    return df.withColumn("violations", v).withColumn("is_valid", F.size("violations") == 0)


def split_valid(df: DataFrame, rules: Sequence[Rule] = CREDIT_REQUEST_RULES) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the rule columns, quarantined rows with their violations)."""
    checked = validate_records(df, rules)
    return checked.where("is_valid").drop("violations", "is_valid"), checked.where(~F.col("is_valid")).drop("is_valid")


def batch_sizes(df: DataFrame, request_col: str, lo: int = 1, hi: int = 100) -> DataFrame:
    """Per request: number of records and whether it lies within [lo, hi]."""
    g = df.groupBy(request_col).agg(F.count(F.lit(1)).alias("n_records"))
    return g.withColumn("batch_ok", F.col("n_records").between(lo, hi))
