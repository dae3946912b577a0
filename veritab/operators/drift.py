"""Population-stability (PSI) and total-variation (TVD) drift between a reference and a current table.

All features are scored in one job: columns are unpivoted to long form ``(feature, value)`` and every
count is a grouped aggregate. A current table may carry run keys (``by``), e.g. a month, so that the
drift of many runs against one reference is computed at once. Alignment of the two distributions on
the union of their bins / categories needs no full outer join and no runs × bins product:

* PSI  = Σ_ref f(r, 0) + Σ_cur [f(r, c) − f(r, 0)],  f(r, c) = (c − r)·ln((c + ε)/(r + ε))
* TVD  = ½ (Σ_ref r + Σ_cur [|r − c| − r])

with ``r = 0`` for a bin / category the reference lacks, so each run only joins its own bins to the
reference shares on ``(feature, bin)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.functions.columns import clip_lower, hash_hex, hash_threshold_hex, known, strip
from veritab.operators.cumulative import exact_quantiles
from veritab.operators.joins import join_null_safe
from veritab.operators.sampling import weighted_choice
from veritab.session import require_checkpoint_dir
from veritab.spec import CREDIT_SPEC, TableSpec

# Thresholds, smoothing constant and report labels of the drift rules.
NUMERIC_DRIFT_THRESHOLD = 0.20
CATEGORICAL_DRIFT_THRESHOLD = 0.15
PREDICTION_DRIFT_THRESHOLD = 0.10
EPSILON = 1e-6
MISSING_CATEGORY = "<NA>"
STATUS_DRIFT = "drift_detectado"
STATUS_STABLE = "estable"
STATUS_UNAVAILABLE = "no_disponible"

REPORT_SCHEMA = "feature string, method string, score double, threshold double, drift_detected boolean"


def _present(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> tuple[list[str], list[str]]:
    ok = [c for c in cols if c in ref.columns and c in cur.columns]
    return ok, [c for c in cols if c not in ok]


def _long(df: DataFrame, cols: Sequence[str], by: Sequence[str], value: Column | None, kind: str) -> DataFrame:
    """Unpivot ``cols`` to ``by…, feature, value`` (double for numeric, cleaned text for categorical)."""
    if kind == "numeric":
        prep = [F.col(c).cast("double").alias(c) for c in cols]
    else:
        prep = [F.coalesce(strip(known(df, c).cast("string")), F.lit(MISSING_CATEGORY)).alias(c) for c in cols]
    wide = df.select(*[F.col(b) for b in by], *prep)
    return wide.unpivot(list(by), list(cols), "feature", "value")


def _edges(reference: DataFrame, cols: Sequence[str], bins: int, quantile_method: str) -> dict[str, list[float]]:
    """De-duplicated reference quantile edges per numeric column with a value: at most bins+1 numbers a column."""
    probs = [i / bins for i in range(bins + 1)]
    ref = _long(reference, cols, [], None, "numeric").where(F.col("value").isNotNull() & ~F.isnan("value"))
    if quantile_method == "exact":
        q = exact_quantiles(ref, ["feature"], "value", probs, out="_q")
    elif quantile_method == "approx":
        q = ref.groupBy("feature").agg(F.percentile_approx("value", probs, 100000).alias("_q"))
    else:
        raise ValueError("quantile_method must be 'exact' or 'approx'")
    return {r["feature"]: sorted(set(r["_q"])) for r in q.select("feature", "_q").collect()}


def _bin_key(x: str, edges: Sequence[float]) -> str:
    """SQL text of the PSI bin of a value (right-closed, the first closed on both sides); NULL when missing, out of
    range, or with fewer than three edges."""
    if len(edges) < 3:
        return "CAST(NULL AS STRING)"
    number = [f"double('{e!r}')" for e in edges]
    above = " + ".join(f"if({x} > {e}, 1, 0)" for e in number[1:])
    return f"if({x} >= {number[0]} AND {x} <= {number[-1]}, CAST(1 + {above} AS STRING), NULL)"


def _side_long(df: DataFrame, edges: dict[str, list[float]], num: Sequence[str], cat: Sequence[str], by: Sequence[str], side: str, by_types) -> DataFrame:
    """One long form per side for numeric and categorical columns together: ``_side, by…, feature, kind, key, nx``
    (``nx``: 1 for a known number); the reference side has NULL run keys."""
    wide = df.select(
        *[F.col(b) if side == "cur" else F.lit(None).cast(by_types[b]).alias(b) for b in by],
        *[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"_num{i}") for i, c in enumerate(num)],
        *[F.coalesce(strip(known(df, c).cast("string")), F.lit(MISSING_CATEGORY)).alias(f"_cat{i}") for i, c in enumerate(cat)],
    )
    structs = [F.struct(F.lit(c).alias("feature"), F.expr("'num' AS kind"), F.expr(f"{_bin_key(f'_num{i}', edges.get(c, []))} AS key"), F.expr(f"int(_num{i} IS NOT NULL) AS nx")) for i, c in enumerate(num)]
    structs += [F.struct(F.lit(c).alias("feature"), F.expr("'cat' AS kind"), F.expr(f"_cat{i} AS key"), F.expr("0 AS nx")) for i, c in enumerate(cat)]
    return wide.select(F.lit(side).alias("_side"), *by, F.inline(F.array(*structs)))


def _side_counts(reference: DataFrame, current: DataFrame, num, cat, by, bins: int, quantile_method: str):
    """The only aggregation over the input rows: counts per ``(_side, by…, feature, kind, key)`` where
    key is the PSI bin (as text; NULL when missing or out of range) or the category. Every score
    below derives from this one shuffle. Also returns the features with enough edges to score."""
    by_types = {b: current.schema[b].dataType for b in by}
    edges = _edges(reference, num, bins, quantile_method) if num else {}
    long = _side_long(reference, edges, num, cat, by, "ref", by_types).unionByName(_side_long(current, edges, num, cat, by, "cur", by_types))
    counts = long.groupBy("_side", *by, "feature", "kind", "key").agg(F.count(F.lit(1)).alias("_rows"), F.sum("nx").alias("_nx"))
    return counts, [c for c in num if len(edges.get(c, [])) >= 3]


def _scores_from_counts(counts: DataFrame, edged: Sequence[str], by: Sequence[str], num: Sequence[str], cat: Sequence[str]) -> DataFrame:
    """PSI (numeric) and TVD (categorical) per ``(by…, feature, kind)`` from the shared counts, in one chain for both
    kinds: totals, a look at the reference's share of each key, and one sum of terms.

    A share is rows of a key over the side's keyed rows (PSI: in-range values; TVD: every row, missing
    being the ``<NA>`` category). A reference row contributes its own term (f(r, 0), or r), a row of a run the
    correction for its key. Every requested feature is scored for every run of the current table; without run keys
    also when the current table is empty (PSI 0, TVD half the reference's shares).
    """
    k = ["feature", "kind"]
    is_ref, is_num, keyed = F.col("_side") == "ref", F.col("kind") == "num", F.col("key").isNotNull()
    totals = counts.groupBy("_side", *by, *k).agg(F.sum(F.when(keyed, F.col("_rows"))).alias("_in"), F.sum("_nx").alias("_all"))
    rows = join_null_safe(counts.where(keyed), totals.drop("_all"), ["_side", *by, *k])
    share = F.try_divide(F.col("_rows"), F.col("_in"))
    # a key has one reference row and at most one per run
    same_key = Window.partitionBy(*k, "key")
    rows = rows.select("_side", *by, *k, share.alias("_s"), F.coalesce(F.max(F.when(is_ref, share)).over(same_key), F.lit(0.0)).alias("_r"))
    # own term of a reference row; correction of a run's row
    psi = lambda r, c: f"(({c} - {r}) * ln(({c} + {EPSILON!r}D) / ({r} + {EPSILON!r}D)))"
    cur_s = "coalesce(_s, 0D)"
    term = f"CASE WHEN _side = 'ref' AND kind = 'num' THEN {psi('_r', '0D')} WHEN _side = 'ref' THEN _r WHEN kind = 'num' THEN {psi('_r', cur_s)} - {psi('_r', '0D')} ELSE abs(_r - {cur_s}) - _r END"
    terms = rows.groupBy("_side", *by, *k).agg(F.expr(f"sum({term})").alias("_t"))
    both = join_null_safe(totals, terms, ["_side", *by, *k], "left")
    ref_t, ref_all = F.when(is_ref, F.col("_t")), F.when(is_ref, F.col("_all"))
    cur_t, cur_all = F.when(~is_ref, F.col("_t")), F.when(~is_ref, F.col("_all"))
    if by:  # the runs that have any row of a feature have all of them: the unpivot lists every feature per row
        runs = Window.partitionBy(*k)  # a row per run and one of the reference
        out = both.select("_side", *by, *k, F.max(ref_t).over(runs).alias("_sref"), F.max(ref_all).over(runs).alias("_rall"), cur_t.alias("_corr"), cur_all.alias("_call")).where(~is_ref)
    else:
        out = both.groupBy(*k).agg(F.max(ref_t).alias("_sref"), F.max(ref_all).alias("_rall"), F.max(cur_t).alias("_corr"), F.max(cur_all).alias("_call"))
        asked = counts.sparkSession.createDataFrame([(f, "num") for f in num] + [(f, "cat") for f in cat], "feature string, kind string")
        out = asked.join(out, k, "left")
    scored = F.col("feature").isin(list(edged))
    score = F.expr("if(kind = 'num', if(_scored AND coalesce(_call, 0) > 0 AND coalesce(_rall, 0) > 0, 1D, 0D), 0.5D) * (coalesce(_sref, 0D) + coalesce(_corr, 0D))")
    out = out.withColumn("_scored", scored)
    return out.select(*by, "feature", "kind", score.alias("score"))


def _scores_by_kind(reference: DataFrame, current: DataFrame, num: Sequence[str], cat: Sequence[str], by: Sequence[str],
                    bins: int, quantile_method: str) -> DataFrame:
    """``(by…, feature, kind, score)`` for every requested column (see :func:`drift_scores`)."""
    by = list(by)
    counts, edged = _side_counts(reference, current, list(num), list(cat), by, bins, quantile_method)
    require_checkpoint_dir(reference.sparkSession)
    # The counts (sides × runs × features × bins/categories) are small; every score branch filters
    # them by side, and those filters would otherwise be pushed below the aggregation, giving each
    # branch its own scan of the inputs. Written once, the inputs are scanned once.
    counts = counts.checkpoint(eager=True)
    return _scores_from_counts(counts, edged, by, list(num), list(cat))


def drift_scores(reference: DataFrame, current: DataFrame, num: Sequence[str], cat: Sequence[str], by: Sequence[str] = (),
                 bins: int = 10, quantile_method: str = "exact") -> tuple[DataFrame | None, DataFrame | None]:
    """(PSI scores, TVD scores) per ``(by…, feature)`` from one shared aggregation of both tables.

    PSI: reference deciles (de-duplicated) are the bin edges; bins are right-closed with the first
    closed on both sides; current values outside the reference range are dropped before shares are
    taken; fewer than three edges or an empty side give 0. TVD: ½Σ|r − c| over the union of
    categories (stripped, missing → ``<NA>``)."""
    scores = _scores_by_kind(reference, current, num, cat, by, bins, quantile_method)
    psi = scores.where(F.col("kind") == "num").drop("kind") if num else None
    tvd = scores.where(F.col("kind") == "cat").drop("kind") if cat else None
    return psi, tvd


def psi_scores(reference: DataFrame, current: DataFrame, cols: Sequence[str], by: Sequence[str] = (), bins: int = 10,
               quantile_method: str = "exact") -> DataFrame:
    """PSI per ``(by…, feature)`` (see :func:`drift_scores`)."""
    if not cols:
        raise ValueError("no numeric columns to score")
    return drift_scores(reference, current, cols, [], by, bins, quantile_method)[0]


def tvd_scores(reference: DataFrame, current: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Total variation distance per ``(by…, feature)`` (see :func:`drift_scores`)."""
    if not cols:
        raise ValueError("no categorical columns to score")
    return drift_scores(reference, current, [], cols, by)[1]


def reference_shares(reference: DataFrame, cols: Sequence[str], out: str = "r") -> DataFrame:
    """Share of each category (stripped, missing → ``<NA>``) per column: ``(feature, value, <out>)``."""
    ref = _long(reference, cols, [], None, "categorical").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("_n"))
    ref_tot = ref.groupBy("feature").agg(F.sum("_n").alias("_t"))
    return ref.join(ref_tot, "feature").select("feature", "value", (F.col("_n") / F.col("_t")).alias(out))


def category_counts(reference: DataFrame, current: DataFrame, cols: Sequence[str], by: Sequence[str] = ()):
    """Shares per category on each side: ``(feature, value, _r)`` and ``(by…, feature, value, _c)``."""
    by = list(by)
    r = reference_shares(reference, cols, "_r")
    cur = _long(current, cols, by, None, "categorical").groupBy(*by, "feature", "value").agg(
        F.count(F.lit(1)).alias("_n")
    )
    cur_tot = cur.groupBy(*by, "feature").agg(F.sum("_n").alias("_t"))
    c = join_null_safe(cur, cur_tot, by + ["feature"]).select(*by, "feature", "value", (F.col("_n") / F.col("_t")).alias("_c"))
    return r, c


def category_shares(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Both distributions over the union of categories: ``feature, value, reference_share, current_share``.

    Missing shares are 0; a side whose counts are all zero keeps zero shares.
    """
    r, c = category_counts(reference, current, cols)
    return r.join(c, ["feature", "value"], "full").select(
        "feature",
        "value",
        F.coalesce(F.col("_r"), F.lit(0.0)).alias("reference_share"),
        F.coalesce(F.col("_c"), F.lit(0.0)).alias("current_share"),
    )


def _decorate(scores: DataFrame, method: str, threshold: float, by: Sequence[str]) -> DataFrame:
    # Scores are rounded half-to-even (as Python's round); the flag uses the unrounded score.
    return scores.select(
        *by,
        "feature",
        F.lit(method).alias("method"),
        (F.bround("score", 6) + F.lit(0.0)).alias("score"),
        F.lit(threshold).alias("threshold"),
        (F.col("score") >= F.lit(threshold)).alias("drift_detected"),
    )


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    numeric_cols: Sequence[str] | None = None,
    categorical_cols: Sequence[str] | None = None,
    spec: TableSpec = CREDIT_SPEC,
    by: Sequence[str] = (),
    bins: int = 10,
    quantile_method: str = "exact",
    numeric_threshold: float = NUMERIC_DRIFT_THRESHOLD,
    categorical_threshold: float = CATEGORICAL_DRIFT_THRESHOLD,
) -> tuple[DataFrame, list[str]]:
    """Per-feature drift rows ``(by…, feature, method, score, threshold, drift_detected)``.

    Empty or missing column lists fall back to the spec. Scores are rounded to 6 places; the flag uses
    the unrounded score. Also returns the sorted, unique list of columns absent on either side.
    """
    by = list(by)
    numeric_cols = list(numeric_cols or spec.numeric)
    categorical_cols = list(categorical_cols or spec.categorical)
    num, miss_n = _present(reference, current, numeric_cols)
    cat, miss_c = _present(reference, current, categorical_cols)
    missing = sorted(set(miss_n + miss_c))
    if not (num or cat):
        return reference.sparkSession.createDataFrame([], REPORT_SCHEMA), missing
    scores = _scores_by_kind(reference, current, num, cat, by, bins, quantile_method)
    is_num = F.col("kind") == "num"
    threshold = F.when(is_num, F.lit(float(numeric_threshold))).otherwise(F.lit(float(categorical_threshold)))
    # One pass over the scored rows for both methods; the flag uses the unrounded score.
    out = scores.select(
        *by,
        "feature",
        F.when(is_num, F.lit("PSI")).otherwise(F.lit("TVD")).alias("method"),
        (F.bround("score", 6) + F.lit(0.0)).alias("score"),
        threshold.alias("threshold"),
        (F.col("score") >= threshold).alias("drift_detected"),
    )
    return out, missing


def drift_summary(report: DataFrame, missing_columns: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """Status, counts and drift ratio (4 places; 0.0 when nothing was evaluated), one row per run."""
    by = list(by)
    agg = report.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_features_evaluated"),
        F.count_if(F.col("drift_detected")).alias("features_with_drift"),
    )
    # Without run keys this is a global aggregate: an empty report still yields one row.
    return agg.select(
        *by,
        F.when(F.col("features_with_drift") > 0, F.lit(STATUS_DRIFT)).otherwise(F.lit(STATUS_STABLE)).alias("status"),
        "total_features_evaluated",
        "features_with_drift",
        F.coalesce(
            F.bround(F.try_divide(F.col("features_with_drift"), F.col("total_features_evaluated")), 4), F.lit(0.0)
        ).alias("drift_ratio"),
        F.array(*[F.lit(c) for c in sorted(set(missing_columns))]).cast("array<string>").alias("missing_columns"),
    )


def prediction_drift(
    reference: DataFrame,
    current: DataFrame,
    target_col: str = CREDIT_SPEC.target,
    threshold: float = PREDICTION_DRIFT_THRESHOLD,
) -> DataFrame:
    """TVD of the target (or prediction) distribution; one row.

    Target absent from the reference → ``no_disponible`` with NULL score; absent from the current
    table → ``no_disponible`` with the reference distribution.
    """
    spark = reference.sparkSession
    schema = (
        "status string, method string, target_col string, score double, threshold double, "
        "drift_detected boolean, reason string, reference_distribution map<string,double>, "
        "current_distribution map<string,double>"
    )
    if target_col not in reference.columns:
        return spark.createDataFrame(
            [(STATUS_UNAVAILABLE, None, target_col, None, threshold, None,
              f"column '{target_col}' not found in the reference table", None, None)],
            schema,
        )
    r = reference_shares(reference, [target_col], "_r")
    ref_map = r.agg(F.map_from_entries(F.collect_list(F.struct("value", "_r"))).alias("reference_distribution"))
    if target_col not in current.columns:
        return ref_map.select(
            F.lit(STATUS_UNAVAILABLE).alias("status"),
            F.lit(None).cast("string").alias("method"),
            F.lit(target_col).alias("target_col"),
            F.lit(None).cast("double").alias("score"),
            F.lit(threshold).alias("threshold"),
            F.lit(None).cast("boolean").alias("drift_detected"),
            F.lit(f"column '{target_col}' not found in the current table; supply model predictions").alias("reason"),
            "reference_distribution",
            F.lit(None).cast("map<string,double>").alias("current_distribution"),
        )
    shares = category_shares(reference, current, [target_col])
    return shares.agg(
        F.sum(F.abs(F.col("reference_share") - F.col("current_share"))).alias("_s"),
        # Bounded by the number of classes of the target.
        F.map_from_entries(F.collect_list(F.struct("value", "reference_share"))).alias("reference_distribution"),
        F.map_from_entries(F.collect_list(F.struct("value", "current_share"))).alias("current_distribution"),
    ).select(
        F.when(F.col("_s") * 0.5 >= threshold, F.lit(STATUS_DRIFT)).otherwise(F.lit(STATUS_STABLE)).alias("status"),
        F.lit("TVD").alias("method"),
        F.lit(target_col).alias("target_col"),
        (F.bround(F.col("_s") * 0.5, 6) + F.lit(0.0)).alias("score"),
        F.lit(threshold).alias("threshold"),
        (F.col("_s") * 0.5 >= threshold).alias("drift_detected"),
        F.lit(None).cast("string").alias("reason"),
        "reference_distribution",
        "current_distribution",
    )


def simulate_drifted_copy(
    reference: DataFrame,
    key_cols: Sequence[str],
    amount_col: str | None = "loan_amount",
    score_col: str | None = "cibil_score",
    flag_col: str | None = "self_employed",
    target_col: str | None = CREDIT_SPEC.target,
    fraction: float = 0.30,
    seed: int = 42,
    amount_factor: float = 1.20,
    score_shift: float = -25,
    score_floor: float = 300,
    flag_value: str = "Yes",
    target_values: Sequence[str] = ("Approved", "Rejected"),
    target_weights: Sequence[float] = (0.40, 0.60),
) -> DataFrame:
    """A drifted sample of a table to exercise the monitors: every step only if its column exists.

    Sample ``fraction`` of rows by key hash; amount × factor; score shifted and floored; flag set to one
    value; target redrawn with the given weights (hash of key with another salt).
    """
    out = reference.where(hash_hex(seed, *key_cols) < F.lit(hash_threshold_hex(fraction)))
    cols = set(reference.columns)
    if amount_col and amount_col in cols:
        out = out.withColumn(amount_col, F.col(amount_col) * F.lit(amount_factor))
    if score_col and score_col in cols:
        out = out.withColumn(score_col, clip_lower(F.col(score_col) + F.lit(score_shift), score_floor))
    if flag_col and flag_col in cols:
        out = out.withColumn(flag_col, F.lit(flag_value))
    if target_col and target_col in cols:
        out = out.withColumn(target_col, weighted_choice(f"{seed}:target", key_cols, target_values, target_weights))
    return out


def drift_decisions(
    report: DataFrame,
    run_cols: Sequence[str],
    critical_features: Sequence[str],
    incident_ratio: float = 0.30,
) -> DataFrame:
    """Decision rules over a run history of drift rows (D-8).

    Per run: drift ratio > ``incident_ratio`` → ``incident``; a critical feature drifted in this and
    the previous run → ``retrain``; no drifted feature → ``keep``; otherwise ``monitor``. The previous
    run comes from ``lag`` over each feature's runs (one window partition per feature, as long as the
    history).
    """
    run_cols = list(run_cols)
    summ = report.groupBy(*run_cols).agg(
        F.count(F.lit(1)).alias("features_evaluated"),
        F.count_if(F.col("drift_detected")).alias("features_with_drift"),
    )
    w = Window.partitionBy("feature").orderBy(*run_cols)
    crit = (
        report.where(F.col("feature").isin(*critical_features))
        .withColumn("_prev", F.lag("drift_detected").over(w))
        .groupBy(*run_cols)
        .agg(F.max(F.col("drift_detected") & F.coalesce(F.col("_prev"), F.lit(False))).alias("retrain"))
    )
    out = summ.join(crit, run_cols, "left").withColumn("retrain", F.coalesce(F.col("retrain"), F.lit(False)))
    ratio = F.col("features_with_drift") / F.col("features_evaluated")  # the rules test the unrounded ratio
    return out.select(
        *run_cols,
        "features_evaluated",
        "features_with_drift",
        F.bround(ratio, 4).alias("drift_ratio"),
        (ratio > F.lit(incident_ratio)).alias("incident"),
        "retrain",
        F.when(ratio > F.lit(incident_ratio), "incident")
        .when(F.col("retrain"), "retrain")
        .when(F.col("features_with_drift") == 0, "keep")
        .otherwise("monitor")
        .alias("decision"),
    )
