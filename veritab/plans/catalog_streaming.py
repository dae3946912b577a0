"""Structured Streaming queries on the driver's tables.

The current slice of `events` (from the drift split on) is written as Parquet parts to a fresh folder
under the shared checkpoint folder and read back with ``readStream``; the streaming job keeps
per-window category counts as watermarked state and scores every window that closed against the
reference shares (events before the split) inside ``foreachBatch``. The registered DataFrame is the
sink's content once the stream has drained (``availableNow``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from veritab.operators import drift as D
from veritab.plans.catalog_drift import _EV_SPLIT
from veritab.plans.catalog_quality import ORDER_RULES, QUARANTINE_SQL
from veritab.plans.oracle_sql import STRIP
from veritab.plans.registry import register, table
from veritab.plans.scratch import scratch_path
from veritab.streaming import monitor

WINDOW, WATERMARK = "1 day", "1 hour"

_CLEAN = f"coalesce({STRIP.format(c='event_type')}, '<NA>')"
_WINDOW_TVD_SQL = f"""WITH ref AS (SELECT {_CLEAN} AS k, count(*) AS n FROM events WHERE ts < TIMESTAMP '{_EV_SPLIT}' GROUP BY 1),
r AS (SELECT k, n / sum(n) OVER () AS r FROM ref),
cur AS (SELECT date_trunc('day', ts) AS ws, {_CLEAN} AS k, count(*) AS n FROM events WHERE ts >= TIMESTAMP '{_EV_SPLIT}' GROUP BY ALL),
c AS (SELECT ws, k, n / sum(n) OVER (PARTITION BY ws) AS c FROM cur),
grid AS (SELECT w.ws, r.k FROM (SELECT DISTINCT ws FROM c) w CROSS JOIN r UNION SELECT ws, k FROM c),
j AS (SELECT g.ws, coalesce(r.r, 0) AS r, coalesce(c.c, 0) AS c FROM grid g LEFT JOIN r ON g.k = r.k LEFT JOIN c ON g.ws = c.ws AND g.k = c.k),
t AS (SELECT ws, 0.5 * sum(abs(r - c)) AS score FROM j GROUP BY ws),
wm AS (SELECT max(ts) - INTERVAL 1 HOUR AS w FROM events WHERE ts >= TIMESTAMP '{_EV_SPLIT}')
SELECT ws AS window_start, ws + INTERVAL 1 DAY AS window_end, 'event_type' AS feature, round(score, 6) + 0.0 AS score,
  score >= 0.15 AS drift_detected
FROM t WHERE ws + INTERVAL 1 DAY <= (SELECT w FROM wm)"""


@register("st_window_tvd_events", _WINDOW_TVD_SQL)
def st_window_tvd_events(spark, sf):
    """Per closed daily event-time window, TVD of `event_type` shares against the reference period.

    Daily windows follow the session time zone (UTC in the sessions built here and by default on this
    host), which is also how the wall-clock `ts` values are read."""
    ev = table(spark, sf, "events")
    cut = F.lit(_EV_SPLIT).cast("timestamp_ntz")
    source = scratch_path(spark, "events-stream-src")
    ev.where(F.col("ts") >= cut).select("ts", "event_type").write.parquet(source)
    ref_shares = D.reference_shares(ev.where(F.col("ts") < cut), ["event_type"])
    # Watermarks need a zone-aware timestamp; the session runs in UTC, so the wall-clock values are kept.
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source).withColumn("ts", F.col("ts").cast("timestamp"))
    out = scratch_path(spark, "events-window-tvd")
    q = monitor.write_window_drift(stream, "ts", ["event_type"], ref_shares, out,
                                   scratch_path(spark, "events-window-tvd-ckpt"), WINDOW, WATERMARK)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"streaming query failed: {q.exception()}")
    res = spark.read.schema("window_start timestamp, window_end timestamp, feature string, score double, drift_detected boolean").parquet(out).drop("batch_id")
    return res.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@register("st_quarantine_orders", QUARANTINE_SQL)
def st_quarantine_orders(spark, sf):
    """Record rules on a stream of orders: valid rows and quarantined rows
    with their violations go to two sinks; the quarantine sink is read back."""
    cols = ["o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus"]
    source = scratch_path(spark, "orders-stream-src")
    table(spark, sf, "orders").select(*cols).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    valid, quarantine = scratch_path(spark, "orders-valid"), scratch_path(spark, "orders-quarantine")
    q = monitor.write_valid_and_quarantine(stream, ORDER_RULES, valid, quarantine, scratch_path(spark, "orders-stream-ckpt"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"streaming query failed: {q.exception()}")
    bad = spark.read.schema(f"{', '.join(f'{c} {t}' for c, t in _ORDER_TYPES)}, violations array<string>, batch_id long").parquet(quarantine)
    return bad.select("o_orderkey", F.array_join("violations", ",").alias("violations"))


_ORDER_TYPES = [("o_orderkey", "bigint"), ("o_totalprice", "double"), ("o_orderpriority", "string"), ("o_orderstatus", "string")]
