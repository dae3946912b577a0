"""The missing-value rule on data that has missing values: orders with NULL and NaN put in by key.

Every 11th price is NULL, every 13th NaN and every 7th status NULL; the SQL side knows only NULL, so a query
agrees only if the operator reads NaN as missing.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from veritab.operators import clean as C
from veritab.operators import drift as D
from veritab.operators import features as FE
from veritab.operators import profile as P
from veritab.operators import quality as Q
from veritab.operators import validate as V
from veritab.plans.registry import register, table

_SQL = """WITH o AS (SELECT o_orderkey, o_custkey, o_orderpriority,
  CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS price,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS status FROM orders)
"""


def holed_orders(spark, sf):
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    price = F.when(k % 11 == 0, F.lit(None)).when(k % 13 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).cast("double")
    return o.select("o_orderkey", "o_custkey", "o_orderpriority", price.alias("price"), F.when(k % 7 != 0, F.col("o_orderstatus")).alias("status"))


def _r6(df, cols):
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in cols})


@register("a5_distinct_counts_missing", _SQL + "SELECT 'price' AS \"column\", count(DISTINCT price) AS n_unique FROM o UNION ALL SELECT 'status', count(DISTINCT status) FROM o")
def a5_distinct_counts_missing(spark, sf):
    return P.distinct_counts(holed_orders(spark, sf), ["price", "status"])


@register("a6_value_counts_missing", _SQL + ", b AS (SELECT round(price, -5) AS value FROM o WHERE price IS NOT NULL) SELECT value, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) + 0.0 AS share FROM b GROUP BY value")
def a6_value_counts_missing(spark, sf):
    return _r6(P.value_counts(holed_orders(spark, sf).select(F.round("price", -5).alias("price")), "price"), ["share"])


@register("a7_majority_share_missing", _SQL + ", c AS (SELECT status, count(*) AS n FROM o WHERE status IS NOT NULL GROUP BY 1) SELECT round(max(n) / sum(n), 4) AS majority_share FROM c")
def a7_majority_share_missing(spark, sf):
    return P.majority_share(holed_orders(spark, sf), "status")


@register("a11_grouped_means_missing", _SQL + "SELECT o_orderpriority, round(avg(price), 4) AS price FROM o GROUP BY 1")
def a11_grouped_means_missing(spark, sf):
    out = P.grouped_means(holed_orders(spark, sf), ["o_orderpriority"], ["price"])
    return out.withColumn("price", F.round("price", 4))


@register("a16_correlation_missing", _SQL + """SELECT a AS column_a, b AS column_b, round(r, 6) + 0.0 AS corr FROM (
  SELECT 'price' AS a, 'price' AS b, corr(price, price) AS r FROM o UNION ALL SELECT 'price', 'o_custkey', corr(price, o_custkey) FROM o
  UNION ALL SELECT 'o_custkey', 'price', corr(price, o_custkey) FROM o UNION ALL SELECT 'o_custkey', 'o_custkey', corr(o_custkey, o_custkey) FROM o)""")
def a16_correlation_missing(spark, sf):
    return _r6(P.correlation_matrix(holed_orders(spark, sf), ["price", "o_custkey"]), ["corr"])


@register("a17_target_correlation_missing", _SQL + "SELECT 'o_custkey' AS \"column\", round(corr(o_custkey, price), 6) + 0.0 AS corr FROM o")
def a17_target_correlation_missing(spark, sf):
    return _r6(P.target_correlation(holed_orders(spark, sf), ["o_custkey", "price"], "price"), ["corr"])


@register("a19_box_outliers_missing", _SQL + """, f AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM o)
SELECT o_orderkey FROM o, f WHERE price < q1 - 0.25 * (q3 - q1) OR price > q3 + 0.25 * (q3 - q1)""")
def a19_box_outliers_missing(spark, sf):
    return P.box_outliers(holed_orders(spark, sf), "price", whisker=0.25).select("o_orderkey")


@register("a21_schema_profile_missing", _SQL + """SELECT * FROM (SELECT 0 AS position, 'price' AS "column", 'double' AS type, count(price) AS non_null FROM o
  UNION ALL SELECT 1, 'status', 'string', count(status) FROM o)""")
def a21_schema_profile_missing(spark, sf):
    return Q.schema_profile(holed_orders(spark, sf).select("price", "status"))


@register("t4_encode_target_missing", _SQL + "SELECT o_orderkey, CASE status WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS status FROM o")
def t4_encode_target_missing(spark, sf):
    enc, _ = C.encode_target_sorted(holed_orders(spark, sf).select("o_orderkey", "status"), "status")
    return enc


@register("t11_above_median_missing", _SQL + "SELECT o_orderkey, CASE WHEN price > (SELECT quantile_cont(price, 0.5) FROM o) THEN 1 ELSE 0 END AS high FROM o")
def t11_above_median_missing(spark, sf):
    return FE.flag_above_median(holed_orders(spark, sf), "price", "high").select("o_orderkey", "high")


@register("t14_standardize_missing", _SQL + "SELECT o_orderkey, round((price - (SELECT avg(price) FROM o)) / (SELECT stddev_pop(price) FROM o), 6) + 0.0 AS price FROM o")
def t14_standardize_missing(spark, sf):
    return _r6(FE.standardize(holed_orders(spark, sf), ["price"]).select("o_orderkey", "price"), ["price"])


@register("p9_record_rules_missing", _SQL + "SELECT o_orderkey, CASE WHEN price IS NULL THEN 'price:required' WHEN price > 300000 THEN 'price:<=300000' ELSE '' END AS violations FROM o")
def p9_record_rules_missing(spark, sf):
    rules = (V.Rule("price:<=300000", "price", hi=300000.0),)
    return V.validate_records(holed_orders(spark, sf), rules).select("o_orderkey", F.array_join("violations", ",").alias("violations"))


@register("d3_tvd_missing", _SQL + """, s AS (SELECT o_orderkey % 2 AS side, coalesce(status, '<NA>') AS k FROM o),
c AS (SELECT k, count_if(side = 0) / (SELECT count(*) FROM s WHERE side = 0) AS r, count_if(side = 1) / (SELECT count(*) FROM s WHERE side = 1) AS c FROM s GROUP BY k)
SELECT 'status' AS feature, round(0.5 * sum(abs(r - c)), 6) + 0.0 AS score FROM c""")
def d3_tvd_missing(spark, sf):
    o = holed_orders(spark, sf)
    return _r6(D.tvd_scores(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1"), ["status"]), ["score"])
