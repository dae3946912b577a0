"""Profiling (A5–A19): distinct counts, value frequencies, describe, moments, grouped statistics,
contingency tables and χ², correlations, histograms and box statistics.

Multi-column statistics run as one aggregate (or one long-form aggregate after ``unpivot``), exact
quantiles use the distributed running-count method, and only bounded results (per column, per bin, per
cell) are ever grouped into one place.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.functions.columns import known, with_known
from veritab.functions.stats import chi2_sf, sample_excess_kurtosis, sample_skewness
from veritab.operators.cumulative import exact_quantiles
from veritab.operators.joins import join_null_safe
from veritab.session import require_checkpoint_dir

BROADCAST_GROUPS = 100_000  # a table with one row per group is broadcast up to this measured number of rows


def _per_group(table: DataFrame) -> tuple[DataFrame, bool]:
    """A one-row-per-group table written once, and whether it was measured small enough to broadcast."""
    table = table.checkpoint(eager=True)
    return table, table.count() <= BROADCAST_GROUPS


def _stack(wide: DataFrame, pairs: Sequence[tuple[str, str]], key: str, value: str, keep: Sequence[str] = ()) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(k).alias(key), F.col(f"`{c}`").alias(value)) for k, c in pairs])
    return wide.select(*keep, F.inline(arr))


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-missing values per column: ``(column, n_unique)``; ``approx`` uses HyperLogLog++ in one pass.

    Exact counts read each column by itself (a pruned scan) and de-duplicate it map-side, so no row is
    expanded into one copy per column."""
    cols = list(cols or df.columns)
    df = with_known(df, cols)
    if approx:
        wide = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(c) for c in cols])
        return _stack(wide, [(c, c) for c in cols], "column", "n_unique")
    one = [df.select(F.col(f"`{c}`").alias("v")).where("v IS NOT NULL").distinct().agg(F.count(F.lit(1)).alias("n_unique")).select(F.lit(c).alias("column"), "n_unique") for c in cols]
    return reduce(DataFrame.unionByName, one)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``(value, count, share)``, most frequent first (ties by value), NULLs excluded; share = count / non-null rows."""
    vc = df.select(known(df, col).alias("value")).where("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("count"))
    total = vc.select(F.sum("count")).scalar()  # from the aggregated counts, not another scan of the table
    return vc.withColumn("share", F.col("count") / total).orderBy(F.desc("count"), "value")


def majority_share(df: DataFrame, col: str, places: int = 4) -> DataFrame:
    """Top normalised frequency of ``col`` (one row ``majority_share``)."""
    vc = df.select(known(df, col).alias("v")).where("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    return vc.agg(F.bround(F.max("n") / F.sum("n"), places).alias("majority_share"))


def _long_numeric(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    wide = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    return wide.unpivot(list(by), list(cols), "column", "value")


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """count, mean, sample std, min, exact linear-interpolated quantiles, max per (by…, column).

    Moments are one aggregate over the raw values (plain double summation, as pandas and SQL engines
    do; a sum over distinct-value products rounds differently at exact ties). Quantiles are found by selection
    (:func:`exact_quantiles`), so a column's values are not shuffled.
    """
    by = list(by)
    g = by + ["column"]
    long = _long_numeric(df, cols, by).where(F.col("value").isNotNull() & ~F.isnan("value"))
    first = long.groupBy(*g).agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    q = exact_quantiles(long, g, "value", quantiles, out="_q")
    names = [f"p{int(round(p * 100))}" for p in quantiles]
    q = q.select(*g, *[F.element_at("_q", i + 1).alias(nm) for i, nm in enumerate(names)])
    out = join_null_safe(first, q, g, "left")
    return out.select(*by, "column", "count", "mean", "std", "min", *names, "max")


def describe_categorical(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, unique, top (most frequent; ties → smallest value), freq per text column."""
    by = list(by)
    wide = df.select(*by, *[F.col(c).cast("string").alias(c) for c in cols])
    long = wide.unpivot(by, list(cols), "column", "value").where(F.col("value").isNotNull())
    vc = long.groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    return vc.groupBy(*by, "column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def moments(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Bias-corrected skewness and excess kurtosis (pandas ``skew``/``kurt``) per (by…, column)."""
    by = list(by)
    long = _long_numeric(df, cols, by).where(F.col("value").isNotNull() & ~F.isnan("value"))
    agg = long.groupBy(*by, "column").agg(
        F.count("value").alias("n"), F.skewness("value").alias("g1"), F.kurtosis("value").alias("g2")
    )
    return agg.select(
        *by, "column", "n",
        # a constant column has no spread: both are 0
        sample_skewness(F.coalesce(F.nanvl("g1", F.lit(0.0)), F.lit(0.0)), F.col("n")).alias("skewness"),
        F.when(F.isnan("g2") | F.col("g2").isNull(), F.when(F.col("n") >= 4, F.lit(0.0))).otherwise(sample_excess_kurtosis(F.col("g2"), F.col("n"))).alias("kurtosis"),
    )


def grouped_means(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Mean of each column per group, missing values (NULL, NaN) left out."""
    return with_known(df, cols).groupBy(*by).agg(*[F.avg(c).alias(c) for c in cols])


def crosstab_long(df: DataFrame, a: str, b: str) -> DataFrame:
    """Observed cells ``(a, b, count)``; NULLs on either side excluded."""
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))


def crosstab(df: DataFrame, a: str, b: str, values: Sequence | None = None) -> DataFrame:
    """Wide contingency table: one row per ``a`` value, one count column per ``b`` value (0 when absent)."""
    clean = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    piv = clean.groupBy(a).pivot(b, list(values) if values is not None else None).count()
    return piv.fillna(0, subset=[c for c in piv.columns if c != a])


def crosstab_row_percent(df: DataFrame, a: str, b: str) -> DataFrame:
    """Row-normalised contingency ×100 in long form ``(a, b, percent)`` (the melted table)."""
    cells = crosstab_long(df, a, b)
    rows = cells.groupBy(a).agg(F.sum("count").alias("_rt"))
    return cells.join(rows, a).select(a, b, (F.col("count") * 100.0 / F.col("_rt")).alias("percent"))


def crosstab_row_percent_wide(df: DataFrame, a: str, b: str, values: Sequence | None = None) -> DataFrame:
    """Row-normalised contingency ×100, wide; absent cells are 0."""
    long = crosstab_row_percent(df, a, b)
    piv = long.groupBy(a).pivot(b, list(values) if values is not None else None).agg(F.first("percent"))
    return piv.fillna(0.0, subset=[c for c in piv.columns if c != a])


def melt(df: DataFrame, ids: Sequence[str], var_name: str, value_name: str) -> DataFrame:
    """Wide → long over every non-id column (``DataFrame.unpivot``)."""
    vals = [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), vals, var_name, value_name)


def chi2_independence(df: DataFrame, a: str, b: str, alpha: float = 0.05, yates: bool = True) -> DataFrame:
    """χ² test of independence on the contingency of ``a`` × ``b``: statistic, dof, p-value, significant.

    Uses Σ o²/e − N over observed cells (unobserved cells need no materialisation). With one degree
    of freedom the Yates continuity correction is applied over all four cells.

    The observed cells (one row per pair of values present) are the only aggregate over the input; they
    are written once to the shared checkpoint folder, so the totals, margins and the statistic below
    read that small table instead of each re-running the scan.
    """
    cells = crosstab_long(df, a, b)
    require_checkpoint_dir(df.sparkSession)
    cells = cells.checkpoint(eager=True)
    rows = cells.groupBy(a).agg(F.sum("count").alias("_rt"))
    cols = cells.groupBy(b).agg(F.sum("count").alias("_ct"))
    n = cells.select(F.sum("count")).scalar()
    n_rows = rows.select(F.count(F.lit(1))).scalar()
    n_cols = cols.select(F.count(F.lit(1))).scalar()
    dof = (n_rows - 1) * (n_cols - 1)
    e = F.col("_rt") * F.col("_ct") / n
    joined = cells.join(rows, a).join(cols, b).select(F.col("count").cast("double").alias("o"), e.alias("e"), "_rt", "_ct", F.col(a).alias("_a"), F.col(b).alias("_b"))
    plain = joined.agg(F.sum(F.col("o") * F.col("o") / F.col("e")).alias("_s"))
    stat_plain = F.col("_s") - n
    if yates:
        # 2×2 case: build the four expected cells from the (two) row and column totals. The lists are
        # only used when dof = 1 (two rows, two columns), so a few entries always suffice.
        rt = rows.limit(3).agg(F.array_sort(F.collect_list(F.struct(F.col(a).alias("k"), F.col("_rt").alias("t")))).alias("R"))
        ct = cols.limit(3).agg(F.array_sort(F.collect_list(F.struct(F.col(b).alias("k"), F.col("_ct").alias("t")))).alias("C"))
        key = lambda x, y: F.concat_ws("\u0001", x.cast("string"), y.cast("string"))
        obs = cells.limit(5).agg(F.map_from_entries(F.collect_list(F.struct(key(F.col(a), F.col(b)), F.col("count")))).alias("O"))
        R = rt.select("R").scalar()
        C = ct.select("C").scalar()
        O = obs.select("O").scalar()
        terms = []
        for i in (1, 2):
            for j in (1, 2):
                o = F.coalesce(F.element_at(O, key(F.element_at(R, i)["k"], F.element_at(C, j)["k"])), F.lit(0)).cast("double")
                ee = F.element_at(R, i)["t"] * F.element_at(C, j)["t"] / n
                d = F.greatest(F.abs(o - ee) - F.lit(0.5), F.lit(0.0))
                terms.append(d * d / ee)
        yates_stat = terms[0] + terms[1] + terms[2] + terms[3]
        stat = F.when(F.lit(dof) == 1, yates_stat).otherwise(stat_plain)
    else:
        stat = stat_plain
    res = plain.select(stat.alias("statistic"), F.lit(dof).cast("long").alias("dof"))
    return res.withColumn("p_value", chi2_sf(F.col("statistic"), F.col("dof"))).withColumn(
        "significant", F.col("p_value") < F.lit(alpha)
    )


def _corr(x: str, y: str) -> Column:
    """Pearson correlation over the rows where both are known; NULL where a side is constant there."""
    x, y = F.col(x).cast("double"), F.col(y).cast("double")
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), spread)


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair (pairwise-complete rows), long form ``(column_a, column_b, corr)``; a pair
    with a constant side has NULL. For more than a few dozen columns take :func:`correlation_matrix_wide`."""
    df = with_known(df, cols)
    pairs = [(x, y) for i, x in enumerate(cols) for y in cols[i:]]
    wide = df.agg(*[_corr(x, y).alias(f"{x}|{y}") for x, y in pairs])
    arr = []
    for x, y in pairs:
        v = F.col(f"`{x}|{y}`")
        arr.append(F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), v.alias("corr")))
        if x != y:
            arr.append(F.struct(F.lit(y).alias("column_a"), F.lit(x).alias("column_b"), v.alias("corr")))
    return wide.select(F.inline(F.array(*arr)))


GRAM_TILE = 256  # columns of a block
GRAM_PAIRS = 1 << 20  # column pairs whose six sums a task holds at once (48 bytes a pair)


GRAM_SUMS = "a int, i int, b int, sums array<double>"


def _gram(tiles: list[tuple[int, int, list[int], list[int]]], shift: list[float]):
    """One task's sums of every pair of the tiles: a row per (tile a, column of a, tile b) with six blocks of values
    over the columns of b: pairs seen, sums of x and y, of their squares, and of x * y."""
    import numpy as np
    import pyarrow as pa

    at = np.array(shift)

    def run(batches):
        held: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1) - at
            seen = ~np.isnan(x)
            big = np.isinf(x)
            value, mark = np.where(seen & ~big, x, 0.0), seen.astype(float)
            square, odd = value * value, big.astype(float) if big.any() else None
            for a, b, left, right in tiles:
                va, ma, sa, vb, mb, sb = value[:, left], mark[:, left], square[:, left], value[:, right], mark[:, right], square[:, right]
                new = np.stack([ma.T @ mb, va.T @ mb, ma.T @ vb, sa.T @ mb, ma.T @ sb, va.T @ vb])
                if odd is not None:  # an infinite value leaves every pair it takes part in without a correlation
                    new[5][(odd[:, left].T @ mb + ma.T @ odd[:, right]) > 0] = np.nan
                held[a, b] = held[a, b] + new if (a, b) in held else new
        for (a, b), sums in held.items():
            n = sums.shape[1]
            rows = pa.array(list(sums.transpose(1, 0, 2).reshape(n, -1)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([a] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array([b] * n, pa.int32()), rows], names=["a", "i", "b", "sums"])

    return run


def _add_sums(batches):
    """Sums of the rows of a task by (a, i, b): its share of the pairs, however many tasks sent rows."""
    import numpy as np
    import pyarrow as pa

    held: dict = {}
    for batch in batches:
        sums = batch.column("sums")
        for r, key in enumerate(zip(*[batch.column(k).to_pylist() for k in ("a", "i", "b")])):
            new = sums[r].values.to_numpy()
            held[key] = held[key] + new if key in held else new
    for (a, i, b), total in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([a], pa.int32()), pa.array([i], pa.int32()), pa.array([b], pa.int32()), pa.array([total], pa.list_(pa.float64()))], names=["a", "i", "b", "sums"])


def correlation_matrix_wide(df: DataFrame, cols: Sequence[str], tile: int = GRAM_TILE, pairs_at_once: int = GRAM_PAIRS) -> DataFrame:
    """:func:`correlation_matrix` for hundreds or thousands of columns: ``(column_a, column_b, corr)`` of every
    ordered pair over the rows where both are known.

    The columns are cut into tiles; a task adds up blocked products of values and presence masks, and the tasks' sums
    are added up by pair. One scan serves ``pairs_at_once`` pairs and reads only their columns. Values are shifted by an
    early value of their column, so that large means cost no digits. NULL where a pair has under two rows or a constant
    side; NaN where an infinite value takes part."""
    cols = list(cols)
    wide = with_known(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys(cols)]), cols)
    wide = wide.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    finite = [F.when(~F.isnan(f"c{i}") & (F.abs(f"c{i}") < float("inf")), F.col(f"c{i}")) for i in range(len(cols))]
    early = wide.limit(1000).agg(*[F.first(c, ignorenulls=True).alias(f"c{i}") for i, c in enumerate(finite)]).first()  # one row; only shifts
    shift = [v or 0.0 for v in early]
    tiles = [range(i, min(i + tile, len(cols))) for i in range(0, len(cols), tile)]
    todo = [(a, b) for a in range(len(tiles)) for b in range(a, len(tiles))]
    parts, names = [], F.array(*[F.lit(c) for c in cols])
    per_pass = max(1, pairs_at_once // (tile * tile))
    for k in range(0, len(todo), per_pass):
        some = todo[k : k + per_pass]
        used = sorted({c for pair in some for t in pair for c in tiles[t]})
        at = {c: j for j, c in enumerate(used)}
        work = [(a, b, [at[c] for c in tiles[a]], [at[c] for c in tiles[b]]) for a, b in some]
        sums = wide.select(*[f"c{c}" for c in used]).mapInArrow(_gram(work, [shift[c] for c in used]), GRAM_SUMS)
        parts.append(sums.repartition("a", "i").mapInArrow(_add_sums, GRAM_SUMS))
    width = (F.size("sums") / 6).cast("int")
    rows = reduce(DataFrame.unionByName, parts).withColumn("w", width)
    pick = [F.slice("sums", F.lit(1) + F.lit(j) * F.col("w"), F.col("w")).alias(f"s{j}") for j in range(6)]
    cell = rows.select("a", "i", "b", F.posexplode(F.arrays_zip(*pick)).alias("j", "s")).select((F.col("a") * tile + F.col("i")).alias("x"), (F.col("b") * tile + F.col("j")).alias("y"), "s.*")
    cell = cell.where("x <= y")
    n = F.col("s0")
    xx, yy = F.col("s3") - F.col("s1") * F.try_divide("s1", n), F.col("s4") - F.col("s2") * F.try_divide("s2", n)
    xy = F.col("s5") - F.col("s1") * F.try_divide("s2", n)
    flat = (xx <= F.col("s3") * 1e-13) | (yy <= F.col("s4") * 1e-13)
    r = F.when(F.isnan("s5"), F.col("s5")).when((n < 2) | flat, F.lit(None)).when(F.col("x") == F.col("y"), F.lit(1.0)).otherwise(xy / F.sqrt(xx) / F.sqrt(yy))
    cell = cell.select("x", "y", r.cast("double").alias("corr"))
    both = F.when(F.col("x") == F.col("y"), F.array(F.struct("x", "y"))).otherwise(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"))))
    out = cell.select("corr", F.inline(both))
    return out.select(F.element_at(names, F.col("x") + 1).alias("column_a"), F.element_at(names, F.col("y") + 1).alias("column_b"), "corr")


def target_correlation(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Correlation of each column with the target (target itself excluded), strongest first."""
    df = with_known(df, [*cols, target])
    feats = [c for c in cols if c != target]
    wide = df.agg(*[_corr(c, target).alias(c) for c in feats])
    return _stack(wide, [(c, c) for c in feats], "column", "corr").orderBy(F.abs("corr").desc_nulls_last(), "column")


def histogram(df: DataFrame, col: str, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram over [min, max] (the max falls in the last bin); all bins are listed.

    Output ``(by…, bin, lower, upper, count)``; with ``by`` the bins are shared by all groups.
    """
    by = list(by)
    vals = df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double")))
    stats = vals.agg(F.min(F.col(col).cast("double")).alias("lo"), F.max(F.col(col).cast("double")).alias("hi"))
    lo = stats.select("lo").scalar()
    hi = stats.select("hi").scalar()
    span = hi - lo
    idx = F.when(span == 0, F.lit(1)).otherwise(
        F.least(F.floor((F.col(col).cast("double") - lo) * (F.lit(float(bins)) / span)) + 1, F.lit(bins))
    )
    counts = vals.groupBy(*by, idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    if by:  # every bin of every group that has a value: `bins` rows per group
        grid = counts.select(*by).distinct().select(*by, F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
        out = join_null_safe(grid, counts, [*by, "bin"], "left")
    else:
        grid = stats.select(F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))  # bounded: `bins` rows
        out = grid.join(counts, "bin", "left")
    return out.select(
        *by, "bin",
        (lo + (F.col("bin") - 1) * (span / bins)).alias("lower"),
        F.when(F.col("bin") == bins, hi).otherwise(lo + F.col("bin") * (span / bins)).alias("upper"),
        F.coalesce(F.col("count"), F.lit(0)).alias("count"),
    )


def box_stats(df: DataFrame, col: str, by: Sequence[str] = (), whisker: float = 1.5) -> DataFrame:
    """Quartiles, IQR, whiskers (furthest data within 1.5·IQR of the box) and outlier counts."""
    by = list(by)
    vals = df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double"))).select(*by, F.col(col).cast("double").alias("_x"))
    if by:
        q, small = _per_group(exact_quantiles(vals, by, "_x", [0.25, 0.5, 0.75], out="_q"))
        j = join_null_safe(vals, q, by, broadcast_right=small)
    else:
        qc = exact_quantiles(vals, [], "_x", [0.25, 0.5, 0.75], out="_q").select("_q").scalar()
        j = vals.withColumn("_q", qc)
    q1, med, q3 = F.element_at("_q", 1), F.element_at("_q", 2), F.element_at("_q", 3)
    iqr = q3 - q1
    low_f, high_f = q1 - whisker * iqr, q3 + whisker * iqr
    return j.groupBy(*by).agg(
        F.first(q1).alias("q1"),
        F.first(med).alias("median"),
        F.first(q3).alias("q3"),
        F.first(iqr).alias("iqr"),
        F.min(F.when(F.col("_x") >= low_f, F.col("_x"))).alias("whisker_low"),
        F.max(F.when(F.col("_x") <= high_f, F.col("_x"))).alias("whisker_high"),
        F.count_if((F.col("_x") < low_f) | (F.col("_x") > high_f)).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"),
    )


def box_outliers(df: DataFrame, col: str, by: Sequence[str] = (), whisker: float = 1.5) -> DataFrame:
    """The rows lying outside the 1.5·IQR fences of their group."""
    by = list(by)
    x = known(df, col).cast("double")
    if by:
        q, small = _per_group(exact_quantiles(df.select(*by, x.alias("_x")), by, "_x", [0.25, 0.75], out="_q"))
        j = join_null_safe(df, q, by, broadcast_right=small)
    else:
        qc = exact_quantiles(df.select(x.alias("_x")), [], "_x", [0.25, 0.75], out="_q").select("_q").scalar()
        j = df.withColumn("_q", qc)
    q1, q3 = F.element_at("_q", 1), F.element_at("_q", 2)
    iqr = q3 - q1
    return j.where((x < q1 - whisker * iqr) | (x > q3 + whisker * iqr)).drop("_q")
