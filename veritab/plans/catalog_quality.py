"""Cleaning, quality and validation queries (P, T1–T5, A1–A4, A21) on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritab.operators import clean as C
from veritab.operators import quality as Q
from veritab.operators import validate as V
from veritab.plans.oracle_sql import STRIP
from veritab.plans.registry import register, table
from veritab.spec import TableSpec

# Stand-in roles on `customer`: the segment is the target, the balance the value to clip.
CUSTOMER_SPEC = TableSpec(
    target="c_mktsegment",
    id_cols=("c_custkey",),
    numeric=("c_nationkey", "c_acctbal"),
    categorical=("c_name",),
    clip_negative=("c_acctbal",),
    negative_check=("c_custkey", "c_acctbal"),
)


@register(
    "t1_strip_values_customer",
    f"SELECT c_custkey, {STRIP.format(c='c_name')} AS c_name, {STRIP.format(c='c_mktsegment')} AS c_mktsegment FROM customer",
)
def t1_strip_values_customer(spark, sf):
    return C.strip_values(table(spark, sf, "customer"), ["c_name", "c_mktsegment"]).select("c_custkey", "c_name", "c_mktsegment")


@register(
    "t2_clip_negatives_customer",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer",
)
def t2_clip_negatives_customer(spark, sf):
    df, _ = C.clip_negatives(table(spark, sf, "customer"), ["c_acctbal"])
    return df.select("c_custkey", "c_acctbal")


@register(
    "t3_quality_fix_supplier",
    "SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_acctbal < 0 THEN 0 ELSE s_acctbal END AS s_acctbal FROM supplier",
)
def t3_quality_fix_supplier(spark, sf):
    return C.apply_quality_fixes(table(spark, sf, "supplier"), "s_acctbal")


@register(
    "t4_label_encode_orders",
    "SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS o_orderstatus FROM orders",
)
def t4_label_encode_orders(spark, sf):
    df, _ = C.encode_target_sorted(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus")
    return df


@register(
    "t4_category_codes_lineitem",
    """SELECT value, row_number() OVER (ORDER BY value) - 1 AS code, n
    FROM (SELECT CAST(l_partkey AS VARCHAR) AS value, count(*) AS n FROM lineitem GROUP BY 1)""",
)
def t4_category_codes_lineitem(spark, sf):
    return C.category_codes(table(spark, sf, "lineitem").select(F.col("l_partkey").cast("string").alias("part")), "part")


@register(
    "t16_category_codes_customer",
    "SELECT c_custkey, dense_rank() OVER (ORDER BY c_name DESC) - 1 AS c_name FROM customer",
)
def t16_category_codes_customer(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return C.encode_categories(c, "c_name", C.category_codes(c, "c_name", descending=True))


@register(
    "t5_map_target_orders",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 0 END AS target FROM orders",
)
def t5_map_target_orders(spark, sf):
    return C.map_target(table(spark, sf, "orders"), "o_orderstatus", "F", "O", out="target").select("o_orderkey", "target")


@register(
    "p1_p4_model_columns_customer",
    f"SELECT c_nationkey, c_acctbal, c_name, {STRIP.format(c='c_mktsegment')} AS c_mktsegment FROM customer",
)
def p1_p4_model_columns_customer(spark, sf):
    df = C.strip_column_names(table(spark, sf, "customer"))
    df = C.drop_columns(df, list(CUSTOMER_SPEC.id_cols) + ["not_a_column"])
    feats, target = C.split_features_target(df, CUSTOMER_SPEC.target, CUSTOMER_SPEC.id_cols)
    assert target not in feats
    df = C.strip_values(df, [target])
    return C.select_model_columns(df, CUSTOMER_SPEC, with_target=True)


def _quality_sql(tbl: str, cols: list[tuple[str, str]], neg: list[str]) -> str:
    names = ", ".join(c for c, _ in cols)
    parts = [
        f"SELECT 'rows' AS metric, '*' AS \"column\", count(*) AS value FROM {tbl}",
        f"SELECT 'columns', '*', CAST({len(cols)} AS BIGINT) FROM {tbl} LIMIT 1",
        f"SELECT 'duplicate_rows', '*', (SELECT count(*) FROM {tbl}) - (SELECT count(*) FROM (SELECT DISTINCT {names} FROM {tbl}))",
    ]
    for c, t in cols:
        miss = f"{c} IS NULL OR isnan({c})" if t == "double" else f"{c} IS NULL"
        parts.append(f"SELECT 'null_count', '{c}', CAST(count_if({miss}) AS BIGINT) FROM {tbl}")
    for c in neg:
        parts.append(f"SELECT 'negative_count', '{c}', CAST(count_if({c} < 0) AS BIGINT) FROM {tbl}")
    return " UNION ALL ".join(f"({p})" for p in parts)


CUSTOMER_COLS = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")]


@register("a1_quality_report_customer", _quality_sql("customer", CUSTOMER_COLS, ["c_custkey", "c_acctbal"]))
def a1_quality_report_customer(spark, sf):
    return Q.quality_report(table(spark, sf, "customer"), CUSTOMER_SPEC.negative_check)


@register(
    "a2_duplicates_lineitem",
    "SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicate_rows",
)
def a2_duplicates_lineitem(spark, sf):
    return Q.duplicate_count(table(spark, sf, "lineitem"))


_ETL_PROCESSED = f"(SELECT {STRIP.format(c='c_name')} AS c_name, c_nationkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal, {STRIP.format(c='c_mktsegment')} AS c_mktsegment FROM customer)"
A3_SQL = " UNION ALL ".join(
    [
        "(SELECT 'rows_raw' AS metric, '*' AS \"column\", CAST(count(*) AS DOUBLE) AS value FROM customer)",
        "(SELECT 'cols_raw', '*', 5.0::DOUBLE)",
        "(SELECT 'negative_before', 'c_acctbal', CAST(count_if(c_acctbal < 0) AS DOUBLE) FROM customer HAVING count_if(c_acctbal < 0) > 0)",
        "(SELECT 'negative_before', 'c_nationkey', CAST(count_if(c_nationkey < 0) AS DOUBLE) FROM customer HAVING count_if(c_nationkey < 0) > 0)",
        f"(SELECT 'rows_processed', '*', CAST(count(*) AS DOUBLE) FROM {_ETL_PROCESSED})",
        "(SELECT 'cols_processed', '*', 4.0::DOUBLE)",
        f"(SELECT 'duplicates', '*', CAST((SELECT count(*) FROM {_ETL_PROCESSED}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {_ETL_PROCESSED})) AS DOUBLE))",
        f"(SELECT 'negative_after', 'c_acctbal', CAST(count_if(c_acctbal < 0) AS DOUBLE) FROM {_ETL_PROCESSED} HAVING count_if(c_acctbal < 0) > 0)",
        f"(SELECT 'nulls_total', '*', CAST(count_if(c_name IS NULL) + count_if(c_nationkey IS NULL) + count_if(c_acctbal IS NULL OR isnan(c_acctbal)) + count_if(c_mktsegment IS NULL) AS DOUBLE) FROM {_ETL_PROCESSED})",
        f"(SELECT 'target_balance', 'c_mktsegment', round(max(n) / sum(n), 4) FROM (SELECT c_mktsegment, count(*) AS n FROM {_ETL_PROCESSED} GROUP BY 1))",
    ]
)


@register("a3_etl_report_customer", A3_SQL)
def a3_etl_report_customer(spark, sf):
    raw = table(spark, sf, "customer")
    spec = CUSTOMER_SPEC.with_(categorical=["c_name"])
    tagged = Q.tag_raw_negatives(C.drop_columns(raw, spec.id_cols), spec.numeric)
    processed, _ = C.clean_table(tagged, spec)
    return Q.etl_report_single_pass(processed, spec.numeric, spec.target, len(raw.columns))


ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
A4_SQL = " UNION ALL ".join(
    [f"(SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL{' OR isnan(o_totalprice)' if c == 'o_totalprice' else ''}) AS BIGINT) AS nulls FROM orders)" for c in ORDERS_COLS]
    + [
        "(SELECT '*total', CAST(" + " + ".join(f"count_if({c} IS NULL)" for c in ORDERS_COLS) + " AS BIGINT) FROM orders)",
        "(SELECT '*rows_with_null', CAST(count_if(" + " OR ".join(f"{c} IS NULL" for c in ORDERS_COLS) + ") AS BIGINT) FROM orders)",
    ]
)


@register("a4_null_profile_orders", A4_SQL)
def a4_null_profile_orders(spark, sf):
    return Q.null_profile(table(spark, sf, "orders"))


@register(
    "a21_schema_profile_customer",
    " UNION ALL ".join(
        f"(SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null FROM customer)"
        for i, (c, t) in enumerate(CUSTOMER_COLS)
    ),
)
def a21_schema_profile_customer(spark, sf):
    return Q.schema_profile(table(spark, sf, "customer"))


@register(
    "p5_negative_rows_customer",
    "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal < 0 ORDER BY c_custkey LIMIT 10",
)
def p5_negative_rows_customer(spark, sf):
    return V.negative_rows(table(spark, sf, "customer"), "c_acctbal", ["c_custkey", "c_mktsegment", "c_acctbal"], "c_custkey", 10)


@register(
    "p6_p8_gate_counts_customer",
    " UNION ALL ".join(
        f"(SELECT {i} AS position, '{c}' AS \"column\", CAST(count_if({c} IS NULL{' OR isnan(c_acctbal)' if t == 'double' else ''}) AS BIGINT) AS nulls, "
        + (f"CAST(count_if({c} < 0) AS BIGINT)" if c in ("c_nationkey", "c_acctbal") else "CAST(NULL AS BIGINT)")
        + " AS negatives FROM customer)"
        for i, (c, t) in enumerate(CUSTOMER_COLS)
    ),
)
def p6_p8_gate_counts_customer(spark, sf):
    df = table(spark, sf, "customer")
    V.require_columns(df, [c for c, _ in CUSTOMER_COLS])
    return V.gate_counts(df, [c for c, _ in CUSTOMER_COLS], ["c_nationkey", "c_acctbal"])


ORDER_RULES = (
    V.Rule("o_totalprice:1000..450000", "o_totalprice", lo=1000, hi=450000),
    V.Rule("o_orderpriority:domain", "o_orderpriority", kind="domain", allowed=("1-URGENT", "2-HIGH", "3-MEDIUM")),
    V.Rule("o_orderstatus:domain", "o_orderstatus", kind="domain", allowed=("F", "O")),
)


QUARANTINE_SQL = f"""SELECT o_orderkey, v AS violations FROM (
  SELECT o_orderkey, concat_ws(',',
    CASE WHEN o_totalprice IS NULL THEN 'o_totalprice:required' END,
    CASE WHEN o_orderpriority IS NULL THEN 'o_orderpriority:required' END,
    CASE WHEN o_orderstatus IS NULL THEN 'o_orderstatus:required' END,
    CASE WHEN o_totalprice < 1000 OR o_totalprice > 450000 THEN 'o_totalprice:1000..450000' END,
    CASE WHEN {STRIP.format(c='o_orderpriority')} NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'o_orderpriority:domain' END,
    CASE WHEN {STRIP.format(c='o_orderstatus')} NOT IN ('F', 'O') THEN 'o_orderstatus:domain' END) AS v
  FROM orders) WHERE v <> ''"""


@register("p9_p10_quarantine_orders", QUARANTINE_SQL)
def p9_p10_quarantine_orders(spark, sf):
    _, bad = V.split_valid(table(spark, sf, "orders"), ORDER_RULES)
    return bad.select("o_orderkey", F.array_join("violations", ",").alias("violations"))


@register(
    "p11_batch_sizes_orders",
    "SELECT o_custkey, count(*) AS n_records, count(*) BETWEEN 1 AND 100 AS batch_ok FROM orders GROUP BY o_custkey",
)
def p11_batch_sizes_orders(spark, sf):
    return V.batch_sizes(table(spark, sf, "orders"), "o_custkey", 1, 100)
