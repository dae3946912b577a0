"""Drift queries (D-1 … D-8) on the driver's tables.

Stand-ins: orders before 1998-07-01 is the reference, later orders the current data; a drifted
copy of orders (D-7) exercises flags; months of orders are consecutive monitoring runs.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from veritab.operators import drift as D
from veritab.plans.oracle_sql import psi_by_run_sql, psi_sql, tvd_by_run_sql, tvd_sql
from veritab.plans.registry import register, table

SPLIT = "1998-07-01"
NUM = ["o_totalprice"]
CAT = ["o_orderpriority", "o_orderstatus"]


def orders_split(spark, sf):
    o = table(spark, sf, "orders")
    cut = F.lit(SPLIT).cast("timestamp_ntz")
    return o.where(F.col("o_orderdate") < cut), o.where(F.col("o_orderdate") >= cut)


def _ref(col):
    return f"SELECT {col} AS v FROM orders WHERE o_orderdate < TIMESTAMP '{SPLIT}'"


def _cur(col):
    return f"SELECT {col} AS v FROM orders WHERE o_orderdate >= TIMESTAMP '{SPLIT}'"


DRIFT_ORDERS_SQL = " UNION ALL ".join(
    [psi_sql(c, _ref(c), _cur(c)) for c in NUM] + [tvd_sql(c, _ref(c), _cur(c)) for c in CAT]
)


@register("d4_feature_drift_orders", DRIFT_ORDERS_SQL)
def d4_feature_drift_orders(spark, sf):
    ref, cur = orders_split(spark, sf)
    report, _ = D.drift_report(ref, cur, NUM, CAT)
    return report


_NONE = "AND o_orderkey < 0"
_EMPTY_SQL = " UNION ALL ".join(
    ["SELECT 'o_totalprice' AS feature, 'PSI' AS method, 0.0::DOUBLE AS score, 0.2::DOUBLE AS threshold, false AS drift_detected"]
    + [tvd_sql(c, _ref(c), f"{_cur(c)} {_NONE}") for c in CAT]
)


@register("d4_empty_current_orders", _EMPTY_SQL)
def d4_empty_current_orders(spark, sf):
    """A current table without rows: PSI 0 and TVD half the reference's shares, so drift is reported."""
    ref, cur = orders_split(spark, sf)
    report, _ = D.drift_report(ref, cur.where("o_orderkey < 0"), NUM, CAT)
    return report


@register("d4_empty_current_summary_orders", "SELECT 'drift_detectado' AS status, 3::BIGINT AS total_features_evaluated, 2::BIGINT AS features_with_drift, 0.6667::DOUBLE AS drift_ratio FROM (SELECT count(*) FROM orders)")
def d4_empty_current_summary_orders(spark, sf):
    return D.drift_summary(d4_empty_current_orders(spark, sf)).drop("missing_columns")


@register(
    "d4_drift_summary_orders",
    f"""WITH rep AS ({DRIFT_ORDERS_SQL})
SELECT CASE WHEN count_if(drift_detected) > 0 THEN 'drift_detectado' ELSE 'estable' END AS status,
  count(*) AS total_features_evaluated, CAST(count_if(drift_detected) AS BIGINT) AS features_with_drift,
  round(count_if(drift_detected) / count(*), 4) AS drift_ratio, 'o_discount_rate' AS missing_columns FROM rep""",
)
def d4_drift_summary_orders(spark, sf):
    ref, cur = orders_split(spark, sf)
    # One requested column is absent from both tables: it is listed, not scored.
    report, missing = D.drift_report(ref, cur, NUM + ["o_discount_rate"], CAT)
    s = D.drift_summary(report, missing)
    return s.withColumn("missing_columns", F.array_join("missing_columns", ","))


@register(
    "d1_class_shares_orders",
    """WITH r AS (SELECT o_orderstatus AS value, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-07-01' GROUP BY 1),
c AS (SELECT o_orderstatus AS value, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-01' GROUP BY 1)
SELECT 'o_orderstatus' AS feature, coalesce(r.value, c.value) AS value,
  round(coalesce(r.n / (SELECT sum(n) FROM r), 0), 6) AS reference_share, round(coalesce(c.n / (SELECT sum(n) FROM c), 0), 6) AS current_share
FROM r FULL JOIN c ON r.value = c.value""",
)
def d1_class_shares_orders(spark, sf):
    ref, cur = orders_split(spark, sf)
    s = D.category_shares(ref, cur, ["o_orderstatus"])
    return s.withColumns({c: F.round(c, 6) for c in ["reference_share", "current_share"]})


@register(
    "d5_prediction_drift_orders",
    "SELECT CASE WHEN drift_detected THEN 'drift_detectado' ELSE 'estable' END AS status, method, 'o_orderstatus' AS target_col, score, threshold, drift_detected FROM "
    + tvd_sql("o_orderstatus", _ref("o_orderstatus"), _cur("o_orderstatus"), threshold=0.1),
)
def d5_prediction_drift_orders(spark, sf):
    ref, cur = orders_split(spark, sf)
    return D.prediction_drift(ref, cur, "o_orderstatus").select("status", "method", "target_col", "score", "threshold", "drift_detected")


SIM_SQL = """SELECT o_orderkey, o_totalprice * 1.2 AS o_totalprice, '1-URGENT' AS o_orderpriority,
  CASE WHEN substr(md5(concat_ws('|', '42:target', CAST(o_orderkey AS VARCHAR))), 1, 8) < '66666666' THEN 'F' ELSE 'O' END AS o_orderstatus
FROM orders WHERE substr(md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR))), 1, 8) < '4ccccccc'"""


def simulated_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    return D.simulate_drifted_copy(
        o, ["o_orderkey"], amount_col="o_totalprice", score_col=None, flag_col="o_orderpriority",
        target_col="o_orderstatus", flag_value="1-URGENT", target_values=("F", "O"), target_weights=(0.4, 0.6),
    )


@register("d7_simulated_current_orders", SIM_SQL)
def d7_simulated_current_orders(spark, sf):
    return simulated_orders(spark, sf)


@register(
    "d4_drift_vs_simulated_orders",
    " UNION ALL ".join(
        [psi_sql("o_totalprice", "SELECT o_totalprice AS v FROM orders", f"SELECT o_totalprice AS v FROM ({SIM_SQL})")]
        + [tvd_sql(c, f"SELECT {c} AS v FROM orders", f"SELECT {c} AS v FROM ({SIM_SQL})") for c in CAT]
    ),
)
def d4_drift_vs_simulated_orders(spark, sf):
    report, _ = D.drift_report(table(spark, sf, "orders"), simulated_orders(spark, sf), NUM, CAT)
    return report


_EV_SPLIT = "2024-01-16"


@register(
    "d4_feature_drift_events",
    " UNION ALL ".join(
        [
            psi_sql("value", f"SELECT value AS v FROM events WHERE ts < TIMESTAMP '{_EV_SPLIT}'", f"SELECT value AS v FROM events WHERE ts >= TIMESTAMP '{_EV_SPLIT}'"),
            tvd_sql("event_type", f"SELECT event_type AS v FROM events WHERE ts < TIMESTAMP '{_EV_SPLIT}'", f"SELECT event_type AS v FROM events WHERE ts >= TIMESTAMP '{_EV_SPLIT}'"),
        ]
    ),
)
def d4_feature_drift_events(spark, sf):
    ev = table(spark, sf, "events")
    cut = F.lit(_EV_SPLIT).cast("timestamp_ntz")
    report, _ = D.drift_report(ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut), ["value"], ["event_type"])
    return report


# Monitoring runs: every month from 1996 on against the 1995 orders.
_HIST_REF = "SELECT {c} AS v FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'"
_HIST_CUR = "SELECT strftime(o_orderdate, '%Y-%m') AS run, {c} AS v FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'"
MONTHLY_SQL = " UNION ALL ".join(
    [psi_by_run_sql(c, _HIST_REF.format(c=c), _HIST_CUR.format(c=c), "month") for c in NUM]
    + [tvd_by_run_sql(c, _HIST_REF.format(c=c), _HIST_CUR.format(c=c), "month") for c in CAT]
)


def monthly_drift(spark, sf):
    o = table(spark, sf, "orders")
    cut = F.lit("1996-01-01").cast("timestamp_ntz")
    ref = o.where(F.col("o_orderdate") < cut)
    cur = o.where(F.col("o_orderdate") >= cut).withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    report, _ = D.drift_report(ref, cur, NUM, CAT, by=["month"])
    return report


@register("d8_monthly_drift_history_orders", MONTHLY_SQL)
def d8_monthly_drift_history_orders(spark, sf):
    return monthly_drift(spark, sf)


@register(
    "d8_drift_decisions_orders",
    f"""WITH rep AS ({MONTHLY_SQL}),
crit AS (SELECT month, drift_detected AND coalesce(lag(drift_detected) OVER (ORDER BY month), false) AS both_runs
         FROM rep WHERE feature = 'o_orderstatus'),
summ AS (SELECT month, count(*) AS features_evaluated, CAST(count_if(drift_detected) AS BIGINT) AS features_with_drift,
                round(count_if(drift_detected) / count(*), 4) AS drift_ratio, count_if(drift_detected) / count(*) AS unrounded FROM rep GROUP BY month)
SELECT s.month, features_evaluated, features_with_drift, drift_ratio, unrounded > 0.3 AS incident,
  coalesce(c.both_runs, false) AS retrain,
  CASE WHEN unrounded > 0.3 THEN 'incident' WHEN coalesce(c.both_runs, false) THEN 'retrain'
       WHEN features_with_drift = 0 THEN 'keep' ELSE 'monitor' END AS decision
FROM summ s LEFT JOIN crit c ON s.month = c.month""",
)
def d8_drift_decisions_orders(spark, sf):
    return D.drift_decisions(monthly_drift(spark, sf), ["month"], ["o_orderstatus"])


LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_CAT = ["l_returnflag", "l_linestatus"]


def lineitem_split(spark, sf):
    li = table(spark, sf, "lineitem")
    cut = F.lit(SPLIT).cast("timestamp_ntz")
    return li.where(F.col("l_shipdate") < cut), li.where(F.col("l_shipdate") >= cut)


def _li(col, op):
    return f"SELECT {col} AS v FROM lineitem WHERE l_shipdate {op} TIMESTAMP '{SPLIT}'"


@register("d2_psi_lineitem", " UNION ALL ".join(psi_sql(c, _li(c, "<"), _li(c, ">=")) for c in LI_NUM))
def d2_psi_lineitem(spark, sf):
    """PSI alone, four numeric columns (quantity has 50 values, so its deciles collapse to fewer edges)."""
    ref, cur = lineitem_split(spark, sf)
    return D._decorate(D.psi_scores(ref, cur, LI_NUM), "PSI", D.NUMERIC_DRIFT_THRESHOLD, [])


@register("d3_tvd_lineitem", " UNION ALL ".join(tvd_sql(c, _li(c, "<"), _li(c, ">=")) for c in LI_CAT))
def d3_tvd_lineitem(spark, sf):
    ref, cur = lineitem_split(spark, sf)
    return D._decorate(D.tvd_scores(ref, cur, LI_CAT), "TVD", D.CATEGORICAL_DRIFT_THRESHOLD, [])
