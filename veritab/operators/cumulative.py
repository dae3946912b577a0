"""Distributed running totals and exact quantiles.

A running total over a global order is usually written as an unpartitioned window, which moves every
row into one task. Here the order range of each group is cut into ``B`` buckets at approximate
quantiles of the ordering column; bucket totals (``groups × B`` rows, tiny) give each bucket its
offset, and the final window runs per ``(group, bucket)``. ``B`` follows the measured size of the
largest group. The bucket boundaries are checkpointed once so every later evaluation assigns rows to
the same bucket; the results are exact because buckets only split the order, they never approximate it.

Exact quantiles are found by selection: a KLL sketch per group brackets every wanted rank, a second pass counts
what lies below and between the brackets and keeps only the values inside them, and running counts pick the two
order statistics around the rank (built-in exact ``percentile`` keeps a value→count map per group in one buffer).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.functions.search import count_less_than, pad_sorted
from veritab.operators.joins import join_null_safe
from veritab.session import require_checkpoint_dir

_BOUNDS_ACCURACY = 10000
# A group measured at or below this many (pre-aggregated) rows is ordered inside one task, a few tens
# of MB; larger groups are split into buckets of about half this size.
SINGLE_TASK_ROWS = 1_000_000
_BROADCAST_GROUPS = 100_000  # tables with one row per hot group are broadcast up to this measured number


def buckets_for(rows: int, limit: int) -> int:
    """Buckets for a group of ``rows`` rows: about half the single-task limit each, as many as the sketch can cut."""
    return max(2, min(_BOUNDS_ACCURACY, -(-2 * int(rows) // max(1, limit))))


def _bucket_bounds(df: DataFrame, by: Sequence[str], order: str, buckets: int) -> DataFrame:
    """``by…, _bounds``: approximate ``1/B`` quantiles of ``order`` per group, padded for the search.

    Written once to the shared folder, so every later read assigns a row to the same bucket; the table stays
    a table, whatever the number of groups."""
    probs = [i / buckets for i in range(1, buckets)]
    q = F.array_sort(F.percentile_approx(F.col(order).cast("double"), probs, _BOUNDS_ACCURACY))
    padded, _ = pad_sorted(F.col("_q"), buckets - 1)
    bounds = df.where(F.col(order).isNotNull()).groupBy(*by).agg(q.alias("_q")).select(*by, padded.alias("_bounds"))
    return bounds.checkpoint(eager=True)


def _window_running(src: DataFrame, by: list[str], order: str, values: list[str], prefix: str, total_prefix: str) -> DataFrame:
    """Running and total sums with each group as one window partition (groups measured small)."""
    wg = Window.partitionBy(*by) if by else Window.partitionBy()
    w = wg.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return src.select(
        *src.columns,
        *[F.sum(v).over(w).alias(f"{prefix}{v}") for v in values],
        *[F.sum(v).over(wg).alias(f"{total_prefix}{v}") for v in values],
    )


def _bucketed_running(src: DataFrame, by: list[str], order: str, values: list[str], b: int, n_groups: int,
                      prefix: str, total_prefix: str) -> DataFrame:
    """Running sums with each group cut into ``b`` buckets at approximate quantiles of ``order``."""
    b = max(2, b)
    bounds = _bucket_bounds(src, by, order, b)
    if by:
        tagged = join_null_safe(src, bounds, by, broadcast_right=n_groups <= _BROADCAST_GROUPS)
    else:
        tagged = src.withColumn("_bounds", bounds.select("_bounds").scalar())
    tagged = count_less_than(tagged, "_bounds", F.col(order), b - 1, "_bucket").drop("_bounds")

    keys = by + ["_bucket"]
    per_bucket = tagged.groupBy(*keys).agg(*[F.sum(v).alias(f"_b_{v}") for v in values])
    # One row per (group, bucket): these windows order at most B rows per group.
    wb = Window.partitionBy(*by).orderBy("_bucket") if by else Window.orderBy("_bucket")
    wg = Window.partitionBy(*by) if by else Window.partitionBy()
    offsets = per_bucket.select(
        *keys,
        *[
            F.coalesce(F.sum(f"_b_{v}").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_o_{v}")
            for v in values
        ],
        *[F.sum(f"_b_{v}").over(wg).alias(f"{total_prefix}{v}") for v in values],
    )
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = join_null_safe(tagged, offsets, keys)
    return out.select(
        *[c for c in tagged.columns if c != "_bucket"],
        *[(F.col(f"_o_{v}") + F.sum(v).over(w)).alias(f"{prefix}{v}") for v in values],
        *[F.col(f"{total_prefix}{v}") for v in values],
    )


def split_by_size(df: DataFrame, by: Sequence[str], limit: int) -> tuple[int, int, DataFrame | None, DataFrame | None]:
    """Measure groups against ``limit`` rows: ``(groups above it, rows of the largest, small-group rows, large-group rows)``.

    Only two numbers reach the driver, so any number of groups is fine. Without oversized groups both
    frames are None. Otherwise the rows are split by a semi / anti join on the oversized keys (null-safe);
    those keys are broadcast while their measured number is small, else joined by a shuffle."""
    by = list(by)
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    r = sizes.where(F.col("_rows") > limit).agg(F.count(F.lit(1)).alias("n"), F.max("_rows").alias("most")).first()
    n_big = r["n"]
    if n_big == 0:
        return 0, 0, None, None
    if not by:
        return n_big, r["most"], None, df
    big = sizes.where(F.col("_rows") > limit).select(*[F.col(k).alias(f"_bk_{k}") for k in by])
    big = F.broadcast(big) if n_big <= _BROADCAST_GROUPS else big
    cond = [F.col(k).eqNullSafe(F.col(f"_bk_{k}")) for k in by]
    return n_big, r["most"], df.join(big, cond, "left_anti"), df.join(big, cond, "left_semi")


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    values: Sequence[str],
    buckets: int | None = None,
    prefix: str = "cum_",
    total_prefix: str = "total_",
    single_task_rows: int | None = None,
    materialize: bool = True,
) -> DataFrame:
    """Add ``cum_<v>`` (inclusive running sum of ``v`` in ``order`` within ``by``) and ``total_<v>``.

    Rows must be unique per ``(by, order)`` (pre-aggregate ties first); rows with a NULL order are
    dropped. ``order`` must be numeric. Groups measured to hold at most ``single_task_rows`` rows
    (default :data:`SINGLE_TASK_ROWS`) are each one window partition, however many groups there are;
    larger groups (a hot key) are cut into buckets so that no task receives more than about ``1/B``
    of a group. ``buckets`` forces the bucketed path for every group.
    """
    by = list(by)
    values = list(values)
    spark = df.sparkSession
    src = df.where(F.col(order).isNotNull())
    require_checkpoint_dir(spark)
    if materialize:
        # The input (usually pre-aggregated, far smaller than the raw table) is read by the size check
        # and again by the final plan: write it once to the shared checkpoint folder instead of
        # re-running the upstream scan and shuffle; this also cuts the lineage for task retries.
        src = src.checkpoint(eager=True)
    if buckets is not None:
        n_groups = src.select(*by).distinct().count() if by else 1
        return _bucketed_running(src, by, order, values, buckets, n_groups, prefix, total_prefix)
    limit = SINGLE_TASK_ROWS if single_task_rows is None else single_task_rows
    n_big, most, small, large = split_by_size(src, by, limit)
    if n_big == 0:
        return _window_running(src, by, order, values, prefix, total_prefix)
    out = _bucketed_running(large, by, order, values, buckets_for(most, limit), n_big, prefix, total_prefix)
    if small is not None:
        out = _window_running(small, by, order, values, prefix, total_prefix).unionByName(out)
    return out


def value_counts_table(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """``by…, _v, _n``: occurrences of each non-null value (as double) per group, combined map-side."""
    v = F.col(value).cast("double")
    return df.where(v.isNotNull() & ~F.isnan(v)).groupBy(*by, v.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))


def exact_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probs: Sequence[float],
    buckets: int | None = None,
    out: str = "quantiles",
) -> DataFrame:
    """Per group, the linearly interpolated quantiles of ``value`` (NULLs ignored).

    Same definition as numpy's default / SQL ``percentile_cont``: position ``h = (n-1)·p``,
    result ``x[floor h] + (x[ceil h] - x[floor h])·(h - floor h)``. Returns ``by`` + an array
    column ``out`` aligned with ``probs``.

    Quantiles are found by selection (:func:`bracketed_counts`): sketches bracket every wanted rank, and only the
    values inside the brackets are counted one by one. More groups than BRACKET_BYTES of brackets, or
    a forced number of ``buckets``, count every distinct value instead; the result is the same.
    """
    by, probs = list(by), [float(p) for p in probs]
    if buckets is None:
        found = bracketed_counts(df, by, value, probs)
        if found is not None:
            return _select_ranks(df, found, by, value, probs, out)
    return quantiles_from_counts(value_counts_table(df, by, value), by, probs, buckets, out)


# A KLL sketch of this size misses a rank by more than 2.296 / k**0.9021 (about 0.24 %) once in a hundred times;
# brackets are twice as wide, and a rank outside its bracket is noticed and counted again.
SKETCH_SIZE = 2000
_RANK_ERROR = 2 * 2.296 / SKETCH_SIZE**0.9021
BRACKET_BYTES = 8 << 20  # brackets and quantiles of all groups pass through the driver up to this measured size


def bracketed_counts(df: DataFrame, by: list[str], value: str, probs: list[float]) -> tuple[DataFrame, int] | None:
    """``by…, _v, _n, _whole``: like :func:`value_counts_table`, but all values between two brackets are one row
    (``_whole`` false) with some value of that gap, and the rows the largest group has at most.

    One sketch per group gives every wanted rank a bracket of values; the second pass counts values inside the
    brackets one by one. No distinct value outside them is shuffled. None when there are too many groups for their
    brackets to pass through the driver, or so many ranks that their brackets would hold most values."""
    require_checkpoint_dir(df.sparkSession)
    if 2 * len(probs) * abs(_RANK_ERROR) > 0.5:  # brackets around so many ranks hold most values
        return None
    v = F.col(value).cast("double")
    rows = df.select(*by, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    sketch = rows.groupBy(*by).agg(F.kll_sketch_agg_double("_v", SKETCH_SIZE).alias("_s"))
    n = F.kll_sketch_get_n_double("_s")
    inner = sorted({p for p in probs if 0.0 < p < 1.0})
    ends = [p for p in (0.0, 1.0) if p in probs]
    k = len(inner) + len(ends)

    def side(sign: float):
        ranks = [*ends, *[min(1.0, max(0.0, p + sign * _RANK_ERROR)) for p in inner]]
        far = F.kll_sketch_get_quantile_double("_s", F.lit(0.0 if sign < 0 else 1.0))
        # a sketch holds up to this many values as they are; there the bracket is the whole group
        return F.when(n <= SKETCH_SIZE, F.array_repeat(far, k)).otherwise(F.array_sort(F.kll_sketch_get_quantile_double("_s", F.array(*[F.lit(r) for r in ranks]))))

    bounds = sketch.where(n > 0).select(*by, n.alias("_n"), side(-1.0).alias("_lo"), side(1.0).alias("_hi"))
    most_groups = BRACKET_BYTES // (16 * k + 64)
    held = bounds.limit(most_groups + 1).collect()
    if len(held) > most_groups:
        return None
    largest = max((r["_n"] for r in held), default=0)
    fixed = df.sparkSession.createDataFrame([tuple(r) for r in held], bounds.schema)
    if by:
        tagged = join_null_safe(rows, fixed.select(*by, "_lo", "_hi"), by, broadcast_right=True)
    elif held:
        tagged = rows.withColumns({c: F.array(*[F.lit(x) for x in held[0][c]]) for c in ("_lo", "_hi")})
    else:
        tagged = rows.withColumns({c: F.lit(None).cast("array<double>") for c in ("_lo", "_hi")})
    # as SQL text: one expression however many quantiles are asked for
    inside = F.expr(" OR ".join(f"(_lo[{i}] <= _v AND _v <= _hi[{i}])" for i in range(k)))
    passed = F.expr(" + ".join(f"if(_hi[{i}] < _v, 1, 0)" for i in range(k)))
    marked = tagged.select(*by, "_v", inside.alias("_whole"), passed.alias("_gap"))
    single = F.when(F.col("_whole"), F.col("_v"))
    counted = marked.groupBy(*by, "_whole", "_gap", single.alias("_one")).agg(F.count(F.lit(1)).alias("_n"), F.max("_v").alias("_v"))
    # distinct values can be fewer, never more; a gap is one row
    most = max(SKETCH_SIZE, int(largest * min(1.0, 3 * k * abs(_RANK_ERROR)))) + k + 1
    return counted.select(*by, "_v", "_n", "_whole"), most


def _select_ranks(df: DataFrame, found: tuple[DataFrame, int], by: list[str], value: str, probs: list[float], out: str) -> DataFrame:
    counts, most = found
    if most <= SINGLE_TASK_ROWS:
        rt = _window_running(counts, by, "_v", ["_n"], "cum_", "total_")
    else:  # brackets of a hot group too large for one task are cut into buckets
        rt = running_totals(counts, by, "_v", ["_n"])
    rank = {f"{side}{i}": f"{side}((total__n - 1) * {p!r}D)" for i, p in enumerate(probs) for side in ("floor", "ceil")}
    covers = {name: f"({r} >= cum__n - _n AND {r} < cum__n)" for name, r in rank.items()}
    found_at = [F.expr(f"max(if({c}, _v, null))").alias(name) for name, c in covers.items()]
    missed = F.expr(f"max(NOT _whole AND ({' OR '.join(covers.values())}))").alias("_missed")
    picked = rt.groupBy(*by).agg(F.max("total__n").alias("_total"), missed, *found_at)
    if not by:
        picked = picked.where("_total IS NOT NULL")  # no value at all: no row, as for a group
    at = [f"((_total - 1) * {p!r}D)" for p in probs]
    values = ", ".join(f"floor{i} + (ceil{i} - floor{i}) * ({h} - floor({h}))" for i, h in enumerate(at))
    picked = picked.select(*by, F.expr(f"array({values})").alias(out), F.expr("NOT _missed").alias("_ok"))
    held = picked.collect()  # a row per group, as many as there were brackets
    spark = df.sparkSession
    done = spark.createDataFrame([tuple(r)[:-1] for r in held if r["_ok"]], picked.drop("_ok").schema)
    missed = [tuple(r[c] for c in by) for r in held if not r["_ok"]]
    if not missed:
        return done
    again = join_null_safe(df, spark.createDataFrame(missed, picked.select(*by).schema), by, "left_semi", broadcast_right=True) if by else df
    return done.unionByName(quantiles_from_counts(value_counts_table(again, by, value), by, probs, None, out))


def quantiles_from_counts(
    counts: DataFrame,
    by: Sequence[str],
    probs: Sequence[float],
    buckets: int | None = None,
    out: str = "quantiles",
    materialize: bool = True,
) -> DataFrame:
    """:func:`exact_quantiles` from a :func:`value_counts_table` (``materialize=False`` when the
    counts are already checkpointed).

    The two order statistics around each wanted rank are read off running counts, and one formula
    interpolates between them, so the value does not depend on the group's size, on ``buckets`` or on how
    :func:`running_totals` splits the group."""
    return _quantiles_by_running_counts(counts, list(by), [float(p) for p in probs], buckets, out, materialize)


def _quantiles_by_running_counts(counts: DataFrame, by: list[str], probs: list[float], buckets: int | None, out: str,
                                 materialize: bool) -> DataFrame:
    """Quantiles read off running counts of distinct values (groups cut into buckets)."""
    rt = running_totals(counts, by, "_v", ["_n"], buckets=buckets, materialize=materialize)
    # Each distinct value covers ranks [cum - n, cum); find which wanted ranks it covers.
    n_all = F.col("total__n")
    wanted = F.transform(
        F.array(*[F.lit(p) for p in probs]),
        lambda p: F.struct(
            p.alias("p"),
            F.floor((n_all - 1) * p).alias("lo"),
            F.ceil((n_all - 1) * p).alias("hi"),
        ),
    )
    lo_start = F.col("cum__n") - F.col("_n")
    hits = rt.select(
        *by,
        "_v",
        F.explode(
            F.filter(
                wanted,
                lambda s: ((s["lo"] >= lo_start) & (s["lo"] < F.col("cum__n")))
                | ((s["hi"] >= lo_start) & (s["hi"] < F.col("cum__n"))),
            )
        ).alias("_s"),
        lo_start.alias("_start"),
        F.col("cum__n").alias("_end"),
        n_all.alias("_total"),
    )
    picked = hits.groupBy(*by, F.col("_s.p").alias("_p")).agg(
        F.max(F.when((F.col("_s.lo") >= F.col("_start")) & (F.col("_s.lo") < F.col("_end")), F.col("_v"))).alias("_lo"),
        F.max(F.when((F.col("_s.hi") >= F.col("_start")) & (F.col("_s.hi") < F.col("_end")), F.col("_v"))).alias("_hi"),
        F.first("_total").alias("_total"),
    )
    h = (F.col("_total") - 1) * F.col("_p")
    frac = h - F.floor(h)
    interp = picked.select(*by, "_p", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * frac).alias("_q"))
    # Bounded: len(probs) entries per group.
    agg = interp.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_p", "_q"))).alias("_pq"))
    return agg.select(*by, F.transform("_pq", lambda s: s["_q"]).alias(out))


def exact_quantile_column(df: DataFrame, value: str, p: float, buckets: int | None = None) -> Column:
    """The exact ``p``-quantile of ``value`` over the whole DataFrame as a scalar-subquery column."""
    q = exact_quantiles(df, [], value, [p], buckets, out="_qs")
    return q.select(F.element_at("_qs", 1)).scalar()


def row_ranks(df: DataFrame, by: Sequence[str], order: str, buckets: int | None = None, out: str = "rank") -> DataFrame:
    """1-based position of each row in ``order`` within ``by`` (``order`` unique per group), plus ``group_size``."""
    with_one = df.withColumn("_one", F.lit(1).cast("long"))
    rt = running_totals(with_one, by, order, ["_one"], buckets=buckets)
    return rt.withColumnRenamed("cum__one", out).withColumnRenamed("total__one", "group_size").drop("_one")
