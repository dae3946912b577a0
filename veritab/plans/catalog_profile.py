"""Profiling queries (A5–A19) on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritab.operators import profile as P
from veritab.plans.registry import register, table

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _r6(df, cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@register(
    "a5_distinct_counts_lineitem",
    " UNION ALL ".join(f"(SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique FROM lineitem)" for c in LI_ALL),
)
def a5_distinct_counts_lineitem(spark, sf):
    return P.distinct_counts(table(spark, sf, "lineitem"))


@register(
    "a6_value_counts_events",
    "SELECT event_type AS value, count(*) AS count, round(count(*) / (SELECT count(event_type) FROM events), 6) AS share FROM events WHERE event_type IS NOT NULL GROUP BY 1",
)
def a6_value_counts_events(spark, sf):
    return _r6(P.value_counts(table(spark, sf, "events"), "event_type"), ["share"])


@register(
    "a7_majority_share_orders",
    "SELECT round(max(n) / sum(n), 4) AS majority_share FROM (SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 1)",
)
def a7_majority_share_orders(spark, sf):
    return P.majority_share(table(spark, sf, "orders"), "o_orderstatus")


def _describe_sql(tbl, cols, by=None, where="1=1"):
    g = f"{by}, " if by else ""
    parts = []
    for c in cols:
        parts.append(
            f"""(SELECT {g}'{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
  round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM {tbl} WHERE {c} IS NOT NULL AND {where} {'GROUP BY ' + by if by else ''})"""
        )
    return " UNION ALL ".join(parts)


@register("a8_describe_lineitem", _describe_sql("lineitem", LI_NUM))
def a8_describe_lineitem(spark, sf):
    d = P.describe(table(spark, sf, "lineitem"), LI_NUM)
    return _r6(d, ["mean", "std", "min", "p25", "p50", "p75", "max"])


@register(
    "a8_describe_text_orders",
    " UNION ALL ".join(
        f"""(SELECT '{c}' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS unique, arg_min(v, (-n, v)) AS top, max(n) AS freq
  FROM (SELECT {c} AS v, count(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY 1))"""
        for c in ["o_orderstatus", "o_orderpriority"]
    ),
)
def a8_describe_text_orders(spark, sf):
    return P.describe_categorical(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@register(
    "a9_moments_lineitem",
    " UNION ALL ".join(
        f"(SELECT '{c}' AS \"column\", count({c}) AS n, round(skewness({c}), 6) AS skewness, round(kurtosis({c}), 6) AS kurtosis FROM lineitem)"
        for c in ["l_quantity", "l_extendedprice", "l_discount"]
    ),
)
def a9_moments_lineitem(spark, sf):
    return _r6(P.moments(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]), ["skewness", "kurtosis"])


@register("a10_grouped_describe_orders", _describe_sql("orders", ["o_totalprice"], by="o_orderstatus"))
def a10_grouped_describe_orders(spark, sf):
    d = P.describe(table(spark, sf, "orders"), ["o_totalprice"], by=["o_orderstatus"])
    return _r6(d, ["mean", "std", "min", "p25", "p50", "p75", "max"])


@register(
    "a11_grouped_means_lineitem",
    "SELECT l_returnflag, " + ", ".join(f"round(avg({c}), 6) AS {c}" for c in LI_NUM) + " FROM lineitem GROUP BY l_returnflag",
)
def a11_grouped_means_lineitem(spark, sf):
    return _r6(P.grouped_means(table(spark, sf, "lineitem"), ["l_returnflag"], LI_NUM), LI_NUM)


@register(
    "a12_crosstab_lineitem",
    "SELECT l_returnflag, CAST(count_if(l_linestatus = 'F') AS BIGINT) AS \"F\", CAST(count_if(l_linestatus = 'O') AS BIGINT) AS \"O\" FROM lineitem GROUP BY l_returnflag",
)
def a12_crosstab_lineitem(spark, sf):
    return P.crosstab(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


_A13_SQL = """WITH c AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)
SELECT o_orderpriority, o_orderstatus, round(n * 100.0 / sum(n) OVER (PARTITION BY o_orderpriority), 6) AS percent FROM c"""


@register("a13_row_percent_orders", _A13_SQL)
def a13_row_percent_orders(spark, sf):
    return _r6(P.crosstab_row_percent(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus"), ["percent"])


@register("a14_melt_row_percent_orders", _A13_SQL)
def a14_melt_row_percent_orders(spark, sf):
    wide = P.crosstab_row_percent_wide(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus")
    return _r6(P.melt(wide, ["o_orderpriority"], "o_orderstatus", "percent"), ["percent"])


def _chi2_sql(a, b, tbl, src=None):
    src = src or tbl
    return f"""WITH c AS (SELECT {a} AS a, {b} AS b, count(*) AS o FROM {src} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL),
r AS (SELECT a, sum(o) AS rt FROM c GROUP BY a), k AS (SELECT b, sum(o) AS ct FROM c GROUP BY b),
n AS (SELECT sum(o) AS n FROM c),
allc AS (SELECT r.a, k.b, r.rt * k.ct / n.n AS e FROM r, k, n),
cells AS (SELECT allc.e, coalesce(c.o, 0) AS o FROM allc LEFT JOIN c ON allc.a = c.a AND allc.b = c.b),
d AS (SELECT (SELECT count(*) FROM r) - 1 AS dr, (SELECT count(*) FROM k) - 1 AS dc),
s AS (SELECT sum(CASE WHEN (SELECT dr * dc FROM d) = 1 THEN pow(greatest(abs(o - e) - 0.5, 0), 2) / e ELSE pow(o - e, 2) / e END) AS stat,
             (SELECT dr * dc FROM d) AS dof FROM cells)"""


@register(
    "a15_chi2_orders",
    _chi2_sql("o_orderpriority", "o_orderstatus", "orders")
    + """
SELECT round(stat, 6) AS statistic, CAST(dof AS BIGINT) AS dof,
  round(exp(-stat / 2) * (SELECT sum(pow(stat / 2, i) / factorial(CAST(i AS INTEGER))) FROM range(0, CAST(dof / 2 AS BIGINT)) t(i)), 6) AS p_value,
  exp(-stat / 2) * (SELECT sum(pow(stat / 2, i) / factorial(CAST(i AS INTEGER))) FROM range(0, CAST(dof / 2 AS BIGINT)) t(i)) < 0.05 AS significant
FROM s""",
)
def a15_chi2_orders(spark, sf):
    r = P.chi2_independence(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus")
    return _r6(r, ["statistic", "p_value"])


@register(
    "a15_chi2_yates_lineitem",
    _chi2_sql("l_linestatus", "big_discount", "lineitem", "(SELECT l_linestatus, l_discount > 0.05 AS big_discount FROM lineitem)")
    + "\nSELECT round(stat, 6) AS statistic, CAST(dof AS BIGINT) AS dof FROM s",
)
def a15_chi2_yates_lineitem(spark, sf):
    li = table(spark, sf, "lineitem").select("l_linestatus", (F.col("l_discount") > 0.05).alias("big_discount"))
    r = P.chi2_independence(li, "l_linestatus", "big_discount")
    return _r6(r.select("statistic", "dof"), ["statistic"])


@register(
    "a16_correlation_lineitem",
    " UNION ALL ".join(
        f"(SELECT '{x}' AS column_a, '{y}' AS column_b, round(corr({x}, {y}), 6) AS corr FROM lineitem)" for x in LI_NUM for y in LI_NUM
    ),
)
def a16_correlation_lineitem(spark, sf):
    return _r6(P.correlation_matrix(table(spark, sf, "lineitem"), LI_NUM), ["corr"])


LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *LI_NUM]


@register(
    "a16_correlation_wide_lineitem",
    " UNION ALL ".join(
        f"(SELECT '{x}' AS column_a, '{y}' AS column_b, round(corr({x}, {y}), 6) AS corr FROM lineitem)" for x in LI_ALL for y in LI_ALL
    ),
)
def a16_correlation_wide_lineitem(spark, sf):
    return _r6(P.correlation_matrix_wide(table(spark, sf, "lineitem"), LI_ALL, tile=3), ["corr"])


@register(
    "a17_target_correlation_lineitem",
    " UNION ALL ".join(
        f"(SELECT '{c}' AS \"column\", round(corr({c}, CAST(l_returnflag = 'R' AS DOUBLE)), 6) AS corr FROM lineitem)" for c in LI_NUM
    ),
)
def a17_target_correlation_lineitem(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("is_returned", (F.col("l_returnflag") == "R").cast("int"))
    return _r6(P.target_correlation(li, LI_NUM + ["is_returned"], "is_returned"), ["corr"])


def _hist_sql(col, tbl, bins, by=None):
    g = f"{by}, " if by else ""
    body = f"""WITH s AS (SELECT min({col}) AS lo, max({col}) AS hi FROM {tbl} WHERE {col} IS NOT NULL),
b AS (SELECT {g}CAST(CASE WHEN s.hi = s.lo THEN 1 ELSE least(floor(({col} - s.lo) * ({bins}.0 / (s.hi - s.lo))) + 1, {bins}) END AS INTEGER) AS bin
      FROM {tbl}, s WHERE {col} IS NOT NULL),
c AS (SELECT {g}bin, count(*) AS n FROM b GROUP BY ALL)"""
    if by:
        return body + f"""
SELECT k.{by}, CAST(g.bin AS INTEGER) AS bin, round(s.lo + (g.bin - 1) * ((s.hi - s.lo) / {bins}), 6) AS lower,
  round(CASE WHEN g.bin = {bins} THEN s.hi ELSE s.lo + g.bin * ((s.hi - s.lo) / {bins}) END, 6) AS upper, coalesce(c.n, 0) AS count
FROM (SELECT DISTINCT {by} FROM c) k CROSS JOIN range(1, {bins} + 1) g(bin) CROSS JOIN s LEFT JOIN c ON c.bin = g.bin AND c.{by} = k.{by}"""
    return body + f"""
SELECT CAST(g.bin AS INTEGER) AS bin, round(s.lo + (g.bin - 1) * ((s.hi - s.lo) / {bins}), 6) AS lower,
  round(CASE WHEN g.bin = {bins} THEN s.hi ELSE s.lo + g.bin * ((s.hi - s.lo) / {bins}) END, 6) AS upper, coalesce(c.n, 0) AS count
FROM range(1, {bins} + 1) g(bin) CROSS JOIN s LEFT JOIN c ON c.bin = g.bin"""


@register("a18_histogram_orders", _hist_sql("o_totalprice", "orders", 30))
def a18_histogram_orders(spark, sf):
    return _r6(P.histogram(table(spark, sf, "orders"), "o_totalprice", 30), ["lower", "upper"])


@register("a18_histogram_by_status_orders", _hist_sql("o_totalprice", "orders", 40, by="o_orderstatus"))
def a18_histogram_by_status_orders(spark, sf):
    return _r6(P.histogram(table(spark, sf, "orders"), "o_totalprice", 40, by=["o_orderstatus"]), ["lower", "upper"])


@register(
    "a19_box_stats_orders",
    """WITH q AS (SELECT o_orderstatus, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS med,
  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1)
SELECT o.o_orderstatus, round(first(q1), 6) AS q1, round(first(med), 6) AS median, round(first(q3), 6) AS q3, round(first(q3 - q1), 6) AS iqr,
  round(min(CASE WHEN o_totalprice >= q1 - 1.5 * (q3 - q1) THEN o_totalprice END), 6) AS whisker_low,
  round(max(CASE WHEN o_totalprice <= q3 + 1.5 * (q3 - q1) THEN o_totalprice END), 6) AS whisker_high,
  CAST(count_if(o_totalprice < q1 - 1.5 * (q3 - q1) OR o_totalprice > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS n_outliers, count(*) AS n
FROM orders o JOIN q ON o.o_orderstatus = q.o_orderstatus WHERE o_totalprice IS NOT NULL GROUP BY o.o_orderstatus""",
)
def a19_box_stats_orders(spark, sf):
    b = P.box_stats(table(spark, sf, "orders"), "o_totalprice", by=["o_orderstatus"])
    return _r6(b, ["q1", "median", "q3", "iqr", "whisker_low", "whisker_high"])


@register(
    "a19_box_outliers_lineitem",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem, q
WHERE l_extendedprice < q1 - 1.5 * (q3 - q1) OR l_extendedprice > q3 + 1.5 * (q3 - q1)""",
)
def a19_box_outliers_lineitem(spark, sf):
    out = P.box_outliers(table(spark, sf, "lineitem"), "l_extendedprice")
    return out.select("l_orderkey", "l_linenumber", "l_extendedprice")
