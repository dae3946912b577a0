"""Sources and sinks (S1–S4): CSV with an explicit schema, Parquet / CSV table output, JSON reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.errors import AnalysisException

from veritab.operators.clean import strip_column_names

# The credit-application table's columns (types chosen as long for the whole numbers).
CREDIT_SCHEMA = StructType(
    [
        StructField("loan_id", LongType()),
        StructField("no_of_dependents", LongType()),
        StructField("education", StringType()),
        StructField("self_employed", StringType()),
        StructField("income_annum", LongType()),
        StructField("loan_amount", LongType()),
        StructField("loan_term", LongType()),
        StructField("cibil_score", LongType()),
        StructField("residential_assets_value", LongType()),
        StructField("commercial_assets_value", LongType()),
        StructField("luxury_assets_value", LongType()),
        StructField("bank_asset_value", LongType()),
        StructField("loan_status", StringType()),
    ]
)


def read_csv(spark: SparkSession, path: str, schema: StructType | None = CREDIT_SCHEMA, header: bool = True) -> DataFrame:
    """Read a CSV with an explicit schema (no inference pass); a missing path raises ``FileNotFoundError``.

    With a header, columns are taken by their stripped header names, whatever their order; a schema column
    that the header lacks raises ``ValueError``. A value that does not fit its type becomes NULL
    (:func:`cast_failures` counts them). Without a header the schema applies by position. With
    ``schema=None`` the header names are kept and every column is text."""
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None and not header:
        reader = reader.schema(schema)
    try:
        raw = reader.csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(path) from e
        raise
    if schema is None or not header:
        return raw
    text = _by_name(raw, schema)
    return text.select(*[_cast(f).alias(f.name) for f in schema.fields])


def _by_name(raw: DataFrame, schema: StructType) -> DataFrame:
    names = {c.strip(): c for c in raw.columns}
    lacking = [f.name for f in schema.fields if f.name not in names]
    if lacking:
        raise ValueError(f"the CSV header lacks {lacking}")
    return raw.select(*[F.col(f"`{names[f.name]}`").alias(f.name) for f in schema.fields])


def _cast(field: StructField):
    c = F.col(f"`{field.name}`")
    return c if isinstance(field.dataType, StringType) else F.trim(c).try_cast(field.dataType)


def cast_failures(spark: SparkSession, path: str, schema: StructType = CREDIT_SCHEMA) -> DataFrame:
    """``(column, failed)``: non-empty CSV values per typed column that do not fit the schema's type (one scan)."""
    text = _by_name(read_csv(spark, path, None), schema)
    typed = [f for f in schema.fields if not isinstance(f.dataType, StringType)]
    counts = text.agg(*[F.count_if((F.trim(f"`{f.name}`") != "") & _cast(f).isNull()).alias(f.name) for f in typed])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").alias("failed")) for f in typed])))


def read_csv_checked(spark: SparkSession, path: str, schema: StructType = CREDIT_SCHEMA, header: bool = True) -> DataFrame:
    """:func:`read_csv` with two more columns: ``record``, the line where it is malformed, and ``problem``: NULL for a good
    row, ``columns`` where a line has too few or too many fields, else the names of the columns whose value does not fit.

    The schema's columns are those the parser could read; with a header they are taken by name. A blank value is NULL,
    not a problem."""
    names = spark.read.option("header", True).csv(path).columns if header else schema.names
    layout = StructType([StructField(n, StringType()) for n in [*names, "__record"]])
    reader = spark.read.schema(layout).option("header", header).option("mode", "PERMISSIVE")
    # without pruning every line is split whole, whichever columns a query takes
    raw = reader.option("columnNameOfCorruptRecord", "__record").option("columnPruning", False).csv(path)
    marked = raw.withColumn("__line", F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names])))
    text = _by_name(marked, StructType([*schema.fields, StructField("__record", StringType()), StructField("__line", StringType())]))
    wrong = [F.when((F.trim(f"`{f.name}`") != "") & _cast(f).isNull(), F.lit(f.name)) for f in schema.fields if not isinstance(f.dataType, StringType)]
    named = F.concat_ws(",", *wrong) if wrong else F.lit("")
    problem = F.when(F.col("__record").isNotNull(), F.lit("columns")).when(named != "", named)
    record = F.when(problem.isNotNull(), F.coalesce("__record", "__line"))
    return text.select(*[_cast(f).alias(f.name) for f in schema.fields], record.alias("record"), problem.alias("problem"))


def split_csv(spark: SparkSession, path: str, valid_path: str, quarantine_path: str, schema: StructType = CREDIT_SCHEMA, header: bool = True) -> None:
    """Write the good rows of a CSV as Parquet and the malformed ones as ``(record, problem)`` Parquet (a scan each)."""
    rows = read_csv_checked(spark, path, schema, header)
    rows.where("problem IS NULL").drop("record", "problem").write.mode("overwrite").parquet(valid_path)
    rows.where("problem IS NOT NULL").select("record", "problem").write.mode("overwrite").parquet(quarantine_path)


def read_monitoring_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Reference or current table for monitoring: CSV read with header names stripped."""
    df = read_csv(spark, path, schema)
    if schema is None:
        return strip_column_names(df)
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by: list[str] | None = None,
                options: dict[str, str] | None = None) -> None:
    """Write a processed table (Parquet by default; ``fmt='csv'`` writes headed CSV parts)."""
    w = df.write.mode(mode).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_report_json(report: DataFrame, path: str) -> None:
    """Write a (one-row, bounded) report DataFrame as a single JSON document."""
    report.coalesce(1).write.mode("overwrite").json(path)
