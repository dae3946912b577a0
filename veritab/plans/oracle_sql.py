"""DuckDB SQL text builders for the oracle side of the catalogue (shared fragments)."""

from __future__ import annotations

STRIP = "regexp_replace(CAST({c} AS VARCHAR), '^\\s+|\\s+$', '', 'g')"


def probs_list(bins: int) -> str:
    return "[" + ", ".join(repr(i / bins) for i in range(bins + 1)) + "]"


def psi_sql(feature: str, ref_sql: str, cur_sql: str, bins: int = 10, threshold: float = 0.2) -> str:
    """PSI of one numeric column; ``ref_sql``/``cur_sql`` select a column ``v``."""
    p = probs_list(bins)
    return f"""(WITH ref AS (SELECT CAST(v AS DOUBLE) v FROM ({ref_sql}) WHERE v IS NOT NULL AND NOT isnan(CAST(v AS DOUBLE))),
cur AS (SELECT CAST(v AS DOUBLE) v FROM ({cur_sql}) WHERE v IS NOT NULL AND NOT isnan(CAST(v AS DOUBLE))),
e AS (SELECT list_sort(list_distinct(quantile_cont(v, {p}))) AS e FROM ref),
rb AS (SELECT greatest(1, len(list_filter(e.e, lambda x: x < v))) AS bin, count(*) AS n FROM ref, e
       WHERE v >= e.e[1] AND v <= e.e[len(e.e)] GROUP BY 1),
cb AS (SELECT greatest(1, len(list_filter(e.e, lambda x: x < v))) AS bin, count(*) AS n FROM cur, e
       WHERE v >= e.e[1] AND v <= e.e[len(e.e)] GROUP BY 1),
j AS (SELECT coalesce(rb.n, 0) AS rn, coalesce(cb.n, 0) AS cn FROM rb FULL JOIN cb ON rb.bin = cb.bin),
s AS (SELECT coalesce(rn / nullif(sum(rn) OVER (), 0), 0) AS r, coalesce(cn / nullif(sum(cn) OVER (), 0), 0) AS c FROM j),
t AS (SELECT CASE WHEN (SELECT len(e) FROM e) < 3 OR (SELECT count(*) FROM cur) = 0 THEN 0.0
                 ELSE sum((c - r) * ln((c + 1e-6) / (r + 1e-6))) END AS score FROM s)
SELECT '{feature}' AS feature, 'PSI' AS method, round(score, 6) + 0.0 AS score, CAST({threshold} AS DOUBLE) AS threshold,
       score >= {threshold} AS drift_detected FROM t)"""


def tvd_sql(feature: str, ref_sql: str, cur_sql: str, threshold: float = 0.15, method: str = "TVD") -> str:
    """TVD of one categorical column; ``ref_sql``/``cur_sql`` select a column ``v``."""
    clean = "coalesce(" + STRIP.format(c="v") + ", '<NA>')"
    return f"""(WITH r AS (SELECT {clean} AS k, count(*) AS n FROM ({ref_sql}) GROUP BY 1),
c AS (SELECT {clean} AS k, count(*) AS n FROM ({cur_sql}) GROUP BY 1),
j AS (SELECT coalesce(r.n, 0) AS rn, coalesce(c.n, 0) AS cn FROM r FULL JOIN c ON r.k = c.k),
s AS (SELECT coalesce(rn / nullif(sum(rn) OVER (), 0), 0) AS rs, coalesce(cn / nullif(sum(cn) OVER (), 0), 0) AS cs FROM j),
t AS (SELECT 0.5 * sum(abs(rs - cs)) AS score FROM s)
SELECT '{feature}' AS feature, '{method}' AS method, round(score, 6) + 0.0 AS score, CAST({threshold} AS DOUBLE) AS threshold,
       score >= {threshold} AS drift_detected FROM t)"""


def psi_by_run_sql(feature: str, ref_sql: str, cur_sql: str, run: str, bins: int = 10, threshold: float = 0.2) -> str:
    """PSI per run; ``cur_sql`` selects ``run, v``."""
    p = probs_list(bins)
    return f"""(WITH ref AS (SELECT CAST(v AS DOUBLE) v FROM ({ref_sql}) WHERE v IS NOT NULL AND NOT isnan(CAST(v AS DOUBLE))),
cur AS (SELECT run, CAST(v AS DOUBLE) v FROM ({cur_sql}) WHERE v IS NOT NULL AND NOT isnan(CAST(v AS DOUBLE))),
e AS (SELECT list_sort(list_distinct(quantile_cont(v, {p}))) AS e FROM ref),
rb AS (SELECT greatest(1, len(list_filter(e.e, lambda x: x < v))) AS bin, count(*) AS n FROM ref, e
       WHERE v >= e.e[1] AND v <= e.e[len(e.e)] GROUP BY 1),
cb AS (SELECT run, greatest(1, len(list_filter(e.e, lambda x: x < v))) AS bin, count(*) AS n FROM cur, e
       WHERE v >= e.e[1] AND v <= e.e[len(e.e)] GROUP BY ALL),
runs AS (SELECT DISTINCT run FROM cur),
grid AS (SELECT runs.run, rb.bin FROM runs CROSS JOIN rb UNION SELECT run, bin FROM cb),
j AS (SELECT g.run, coalesce(rb.n, 0) AS rn, coalesce(cb.n, 0) AS cn FROM grid g
      LEFT JOIN rb ON g.bin = rb.bin LEFT JOIN cb ON g.run = cb.run AND g.bin = cb.bin),
s AS (SELECT run, coalesce(rn / nullif(sum(rn) OVER (PARTITION BY run), 0), 0) AS r,
             coalesce(cn / nullif(sum(cn) OVER (PARTITION BY run), 0), 0) AS c FROM j),
t AS (SELECT run, CASE WHEN (SELECT len(e) FROM e) < 3 THEN 0.0 ELSE sum((c - r) * ln((c + 1e-6) / (r + 1e-6))) END AS score
      FROM s GROUP BY run)
SELECT run AS {run}, '{feature}' AS feature, 'PSI' AS method, round(score, 6) + 0.0 AS score, CAST({threshold} AS DOUBLE) AS threshold,
       score >= {threshold} AS drift_detected FROM t)"""


def tvd_by_run_sql(feature: str, ref_sql: str, cur_sql: str, run: str, threshold: float = 0.15) -> str:
    """TVD per run; ``cur_sql`` selects ``run, v``."""
    clean = "coalesce(" + STRIP.format(c="v") + ", '<NA>')"
    return f"""(WITH r AS (SELECT {clean} AS k, count(*) AS n FROM ({ref_sql}) GROUP BY 1),
c AS (SELECT run, {clean} AS k, count(*) AS n FROM ({cur_sql}) GROUP BY ALL),
runs AS (SELECT DISTINCT run FROM c),
grid AS (SELECT runs.run, r.k FROM runs CROSS JOIN r UNION SELECT run, k FROM c),
j AS (SELECT g.run, coalesce(r.n, 0) AS rn, coalesce(c.n, 0) AS cn FROM grid g
      LEFT JOIN r ON g.k = r.k LEFT JOIN c ON g.run = c.run AND g.k = c.k),
s AS (SELECT run, coalesce(rn / nullif(sum(rn) OVER (PARTITION BY run), 0), 0) AS rs,
             coalesce(cn / nullif(sum(cn) OVER (PARTITION BY run), 0), 0) AS cs FROM j),
t AS (SELECT run, 0.5 * sum(abs(rs - cs)) AS score FROM s GROUP BY run)
SELECT run AS {run}, '{feature}' AS feature, 'TVD' AS method, round(score, 6) + 0.0 AS score, CAST({threshold} AS DOUBLE) AS threshold,
       score >= {threshold} AS drift_detected FROM t)"""


def boosted_sql(rows: str, features: list[str], rounds: int, depth: int, rate: float, lam: float = 1.0, alpha: float = 0.0, bins: int = 64) -> str:
    """CTEs of a boosted ensemble fitted in SQL on ``rows`` (a query with ``id``, ``y`` and the features' columns): the
    last one, ``scored``, has (id, p). Cuts at distinct quantiles, second-order gains with L1 and L2 terms, children of
    Hessian 1 at least."""
    d = len(features)
    probs = "[" + ", ".join(repr(i / bins) for i in range(bins + 1)) + "]"
    soft = lambda g: f"(sign({g}) * greatest(abs({g}) - {alpha}, 0))"
    term = lambda g, h: f"({soft(g)} * {soft(g)} / ({h} + {lam}))"
    cells = "[" + ", ".join(f"b{i}" for i in range(d)) + "]"
    cut = lambda i: f"list_sort(list_distinct(quantile_cont(x{i}, {probs})))"
    ctes = [
        "o AS (SELECT id, y, " + ", ".join(f"CAST({f} AS DOUBLE) AS x{i}" for i, f in enumerate(features)) + f" FROM ({rows}))",
        "q AS (SELECT " + ", ".join(f"{cut(i)} AS q{i}" for i in range(d)) + " FROM o)",
        "e AS (SELECT " + ", ".join(f"CASE WHEN len(q{i}) > {bins} THEN q{i}[2:len(q{i}) - 1] ELSE q{i}[1:len(q{i}) - 1] END AS e{i}" for i in range(d)) + " FROM q)",
        "m0 AS (SELECT id, y, " + ", ".join(f"1 + len(list_filter(e{i}, lambda v: v < x{i})) AS b{i}" for i in range(d)) + ", CAST(0 AS DOUBLE) AS m FROM o, e)",
    ]
    for r in range(rounds):
        ctes.append(f"n{r}_0 AS (SELECT *, 0 AS node, p - y AS g, p * (1 - p) AS h FROM (SELECT *, 1 / (1 + exp(-m)) AS p FROM m{r}))")
        for level in range(depth):
            gain = f"round({term('gl', 'hl')} + {term('(ga - gl)', '(ha - hl)')} - {term('ga', 'ha')}, 8)"
            ctes += [
                f"c{r}_{level} AS (SELECT node, f, bin, sum(g) AS gs, sum(h) AS hs, count(*) AS ns FROM (SELECT node, g, h, unnest({cells}) AS bin, unnest(range(0, {d})) AS f FROM n{r}_{level}) GROUP BY ALL)",
                f"w{r}_{level} AS (SELECT node, f, bin, sum(gs) OVER u AS gl, sum(hs) OVER u AS hl, sum(ns) OVER u AS nl, sum(gs) OVER t AS ga, sum(hs) OVER t AS ha, sum(ns) OVER t AS na FROM c{r}_{level} "
                "WINDOW t AS (PARTITION BY node, f), u AS (PARTITION BY node, f ORDER BY bin ROWS UNBOUNDED PRECEDING))",
                f"s{r}_{level} AS (SELECT node, f, bin FROM w{r}_{level} WHERE nl < na AND hl >= 1 AND ha - hl >= 1 AND {gain} > 1e-8 QUALIFY row_number() OVER (PARTITION BY node ORDER BY {gain} DESC, f, bin) = 1)",
                f"n{r}_{level + 1} AS (SELECT n.* REPLACE (CASE WHEN s.f IS NULL THEN n.node ELSE 2 * n.node + 1 + CAST({cells}[s.f + 1] > s.bin AS INTEGER) END AS node) FROM n{r}_{level} n LEFT JOIN s{r}_{level} s ON n.node = s.node)",
            ]
        ctes += [
            f"l{r} AS (SELECT node, -{rate} * {soft('sum(g)')} / (sum(h) + {lam}) AS v FROM n{r}_{depth} GROUP BY node)",
            f"m{r + 1} AS (SELECT n.* EXCLUDE (node, g, h, p) REPLACE (n.m + l.v AS m) FROM n{r}_{depth} n JOIN l{r} l ON n.node = l.node)",
        ]
    ctes.append(f"scored AS (SELECT id, 1 / (1 + exp(-m)) AS p FROM m{rounds})")
    return "WITH " + ",\n".join(ctes)


def logistic_sql(rows: str, steps: int = 9) -> str:
    """Ridge logistic regression of ``y`` on the standardised ``x1``, ``x2`` of ``rows`` by Newton steps: (term, weight).
    The penalty is 1 / (2 n) of the squared weights, the intercept is free."""
    ctes = [
        f"o AS ({rows})",
        "s AS (SELECT y, (x1 - avg(x1) OVER ()) / stddev_pop(x1) OVER () AS x1, (x2 - avg(x2) OVER ()) / stddev_pop(x2) OVER () AS x2, 1.0 / count(*) OVER () AS lam FROM o)",
        "w0 AS (SELECT 0::DOUBLE AS a, 0::DOUBLE AS b, 0::DOUBLE AS c)",
    ]
    for i in range(steps):
        ctes += [
            f"h{i} AS (SELECT a, b, c, avg(p - y) AS g0, avg((p - y) * x1) + max(lam) * b AS g1, avg((p - y) * x2) + max(lam) * c AS g2, avg(q) AS h00, avg(q * x1) AS h01, avg(q * x2) AS h02, "
            f"avg(q * x1 * x1) + max(lam) AS h11, avg(q * x1 * x2) AS h12, avg(q * x2 * x2) + max(lam) AS h22 FROM (SELECT *, p * (1 - p) AS q FROM (SELECT *, 1 / (1 + exp(-(a + b * x1 + c * x2))) AS p FROM s, w{i})) GROUP BY a, b, c)",
            f"d{i} AS (SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS det FROM h{i})",
            f"w{i + 1} AS (SELECT a - (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / det AS a, "
            f"b - (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / det AS b, "
            f"c - (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / det AS c FROM d{i})",
        ]
    last = f"w{steps}"
    return "WITH " + ",\n".join(ctes) + f"\nSELECT term, round(w, 4) AS weight FROM (SELECT unnest(['intercept', 'o_totalprice', 'order_day']) AS term, unnest([a, b, c]) AS w FROM {last})"
