"""Structured Streaming: the per-row operators (validation, scoring) on streams, a quarantine sink,
and category shares per event-time window (watermarked state) compared with a reference by TVD."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.operators import validate as V
from veritab.operators.drift import MISSING_CATEGORY
from veritab.functions.columns import strip
from veritab.session import require_checkpoint_dir


def validated_stream(stream: DataFrame, rules: Sequence[V.Rule] = V.CREDIT_REQUEST_RULES) -> DataFrame:
    """Stateless: every record with ``violations`` and ``is_valid``."""
    return V.validate_records(stream, rules)


def write_valid_and_quarantine(stream: DataFrame, rules: Sequence[V.Rule], valid_path: str, quarantine_path: str,
                               checkpoint: str, trigger_once: bool = True):
    """Split each micro-batch into valid rows and quarantined rows (with violations) written to two
    Parquet folders, one ``batch_id=`` partition per batch; the checkpoint makes the query resume where it
    stopped and a replayed batch replaces its own partition."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        # each batch owns one partition folder, so a replayed batch overwrites itself; the rules are per row
        # and cheap, so the two writes each read the batch instead of holding it in executor memory
        checked = V.validate_records(batch, rules)
        checked.where("is_valid").drop("violations", "is_valid").write.mode("overwrite").parquet(f"{valid_path}/batch_id={batch_id}")
        checked.where(~F.col("is_valid")).drop("is_valid").write.mode("overwrite").parquet(f"{quarantine_path}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()


def windowed_category_counts(stream: DataFrame, ts_col: str, cols: Sequence[str], window: str, watermark: str) -> DataFrame:
    """Counts per (event-time window, feature, category) with a watermark so state is dropped once a
    window can no longer change (append mode emits each window once)."""
    prep = [F.coalesce(strip(F.col(c).cast("string")), F.lit(MISSING_CATEGORY)).alias(c) for c in cols]
    long = stream.select(F.col(ts_col), *prep).unpivot([ts_col], list(cols), "feature", "value")
    return (
        long.withWatermark(ts_col, watermark)
        .groupBy(F.window(ts_col, window).alias("window"), "feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def window_tvd(window_counts: DataFrame, reference_shares: DataFrame, threshold: float = 0.15) -> DataFrame:
    """TVD of each closed window's category shares against reference shares ``(feature, value, r)``.

    Works on a micro-batch of :func:`windowed_category_counts` output (inside ``foreachBatch``)."""
    tot = window_counts.groupBy("window", "feature").agg(F.sum("n").alias("_t"))
    c = window_counts.join(tot, ["window", "feature"]).select("window", "feature", "value", (F.col("n") / F.col("_t")).alias("_c"))
    r_sum = reference_shares.groupBy("feature").agg(F.sum("r").alias("_rsum"))
    corr = (
        c.join(reference_shares, ["feature", "value"], "left")
        .select("window", "feature", (F.abs(F.coalesce(F.col("r"), F.lit(0.0)) - F.col("_c")) - F.coalesce(F.col("r"), F.lit(0.0))).alias("_d"))
        .groupBy("window", "feature").agg(F.sum("_d").alias("_corr"))
    )
    score = F.lit(0.5) * (F.coalesce(F.col("_rsum"), F.lit(0.0)) + F.col("_corr"))
    return corr.join(r_sum, "feature", "left").select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "feature",
        (F.round(score, 6) + F.lit(0.0)).alias("score"), (score >= F.lit(threshold)).alias("drift_detected"),
    )


def write_window_drift(stream: DataFrame, ts_col: str, cols: Sequence[str], reference_shares: DataFrame, out_path: str,
                       checkpoint: str, window: str = "1 day", watermark: str = "1 hour", threshold: float = 0.15,
                       trigger_once: bool = True):
    """Per closed event-time window, the TVD of each categorical column against the reference shares,
    appended to ``out_path``. Window state is kept by the streaming aggregation and dropped after the
    watermark passes; each micro-batch holds only the windows that closed in it."""
    counts = windowed_category_counts(stream, ts_col, cols, window, watermark)
    require_checkpoint_dir(reference_shares.sparkSession)
    # Small (features × categories) but derived from the whole reference table: written once to the
    # shared folder so that micro-batches do not rescan the reference.
    reference_shares = reference_shares.checkpoint(eager=True)

    def sink(batch: DataFrame, batch_id: int) -> None:
        window_tvd(batch, reference_shares, threshold).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    w = counts.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
