"""Feature queries (T6–T15, T20) on the driver's tables.

Stand-in roles on `lineitem`: quantity is the income, extended price the loan amount, and four values
derived from price, discount and tax play the assets (the first one, which can be negative, is clipped).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from veritab.functions.columns import format_percent
from veritab.operators import features as FE
from veritab.operators import profile as P
from veritab.plans.registry import register, table

_ASSETS_SQL = """SELECT l_orderkey, l_linenumber, l_quantity AS income, l_extendedprice AS loan,
  l_extendedprice * (l_discount - 0.05) AS res, l_extendedprice * l_tax AS com,
  l_extendedprice * l_discount AS lux, l_quantity AS bank FROM lineitem"""


def lineitem_assets(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.col("l_quantity").alias("income"),
        F.col("l_extendedprice").alias("loan"),
        (F.col("l_extendedprice") * (F.col("l_discount") - F.lit(0.05))).alias("res"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("com"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("lux"),
        F.col("l_quantity").alias("bank"),
    )


def _featured(spark, sf):
    return FE.add_financial_features(lineitem_assets(spark, sf), "income", "loan", "res", ["com", "lux", "bank"])


@register(
    "t6_t9_financial_features_lineitem",
    f"""WITH a AS ({_ASSETS_SQL}), t AS (SELECT *, (CASE WHEN res < 0 THEN 0 ELSE res END) + com + lux + bank AS total_assets FROM a)
SELECT l_orderkey, l_linenumber, total_assets,
  coalesce(CASE WHEN income <> 0 THEN loan / income END, 0.0) AS loan_to_income_ratio,
  coalesce(CASE WHEN total_assets <> 0 THEN loan / total_assets END, 0.0) AS loan_to_assets_ratio,
  total_assets - loan AS net_worth_proxy FROM t""",
)
def t6_t9_financial_features_lineitem(spark, sf):
    f = _featured(spark, sf)
    # Row-wise arithmetic in the same order as the SQL: identical doubles, no rounding needed.
    return f.select("l_orderkey", "l_linenumber", "total_assets", "loan_to_income_ratio", "loan_to_assets_ratio", "net_worth_proxy")


@register(
    "t10_smoothed_ratios_lineitem",
    f"""WITH a AS ({_ASSETS_SQL}), t AS (SELECT *, (CASE WHEN res < 0 THEN 0 ELSE res END) + com + lux + bank AS total_assets FROM a)
SELECT l_orderkey, l_linenumber, loan / (income + 1.0) AS loan_income_ratio_smoothed,
  loan / (total_assets + 1.0) AS loan_assets_ratio_smoothed FROM t""",
)
def t10_smoothed_ratios_lineitem(spark, sf):
    f = FE.add_smoothed_ratios(_featured(spark, sf), "income", "loan", "total_assets", 1.0)
    return f.select("l_orderkey", "l_linenumber", "loan_income_ratio_smoothed", "loan_assets_ratio_smoothed")


@register(
    "t11_above_median_orders",
    "SELECT o_orderkey, CAST(o_totalprice > (SELECT median(o_totalprice) FROM orders) AS INTEGER) AS high_price FROM orders",
)
def t11_above_median_orders(spark, sf):
    return FE.flag_above_median(table(spark, sf, "orders"), "o_totalprice", "high_price").select("o_orderkey", "high_price")


@register(
    "t12_indicators_orders",
    "SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS is_final, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS is_urgent FROM orders",
)
def t12_indicators_orders(spark, sf):
    o = FE.add_indicators(table(spark, sf, "orders"), {"is_final": ("o_orderstatus", "F"), "is_urgent": ("o_orderpriority", "1-URGENT")})
    return o.select("o_orderkey", "is_final", "is_urgent")


# Right-closed price bands; like the score bands of the source, the lowest edge is excluded.
PRICE_EDGES = [1013.7, 50000.0, 150000.0, 300000.0, 450000.0, 500000.0]
PRICE_LABELS = ["very_low", "low", "medium", "high", "very_high"]
_BAND_SQL = (
    "CASE "
    + " ".join(f"WHEN o_totalprice > {lo} AND o_totalprice <= {hi} THEN '{lab}'" for lo, hi, lab in zip(PRICE_EDGES, PRICE_EDGES[1:], PRICE_LABELS))
    + " END"
)


@register("t13_price_bands_orders", f"SELECT o_orderkey, {_BAND_SQL} AS price_band FROM orders")
def t13_price_bands_orders(spark, sf):
    return FE.add_bands(table(spark, sf, "orders"), "o_totalprice", PRICE_EDGES, PRICE_LABELS, "price_band").select("o_orderkey", "price_band")


@register(
    "a13_band_status_percent_orders",
    f"""WITH b AS (SELECT {_BAND_SQL} AS price_band, o_orderstatus FROM orders),
c AS (SELECT price_band, o_orderstatus, count(*) AS n FROM b WHERE price_band IS NOT NULL GROUP BY ALL)
SELECT price_band, o_orderstatus, round(n * 100.0 / sum(n) OVER (PARTITION BY price_band), 6) AS percent FROM c""",
)
def a13_band_status_percent_orders(spark, sf):
    o = FE.add_bands(table(spark, sf, "orders"), "o_totalprice", PRICE_EDGES, PRICE_LABELS, "price_band")
    r = P.crosstab_row_percent(o, "price_band", "o_orderstatus")
    return r.withColumn("percent", F.round("percent", 6))


@register(
    "t14_standardize_lineitem",
    """SELECT l_orderkey, l_linenumber,
  round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6) AS l_quantity_z,
  round((l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER (), 6) AS l_extendedprice_z,
  round((l_discount - avg(l_discount) OVER ()) / stddev_pop(l_discount) OVER (), 6) AS l_discount_z FROM lineitem""",
)
def t14_standardize_lineitem(spark, sf):
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    z = FE.standardize(table(spark, sf, "lineitem"), cols, suffix="_z")
    return z.select("l_orderkey", "l_linenumber", *[F.round(f"{c}_z", 6).alias(f"{c}_z") for c in cols])


_PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register(
    "t15_dummies_orders",
    "SELECT o_orderkey, "
    + ", ".join(f"CAST(o_orderpriority = '{p}' AS INTEGER) AS \"o_orderpriority_{p}\"" for p in _PRIOS[1:])
    + " FROM orders",
)
def t15_dummies_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return FE.one_hot_dummies(o, "o_orderpriority", drop_first=True)


@register(
    "t20_percent_labels_events",
    "SELECT event_type AS value, count(*) AS count, printf('%.1f%%', count(*) / (SELECT count(event_type) FROM events) * 100) AS percent FROM events WHERE event_type IS NOT NULL GROUP BY 1",
)
def t20_percent_labels_events(spark, sf):
    vc = P.value_counts(table(spark, sf, "events"), "event_type")
    return vc.select("value", "count", format_percent(F.col("share") * 100).alias("percent"))
