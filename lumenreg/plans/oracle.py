"""Independent ANSI-SQL formulations (DuckDB dialect) of the registered queries.

They recompute each result from the raw ``lineitem`` and ``part`` tables with
plain SQL — no MLlib, no shared code path with the Spark side:

* ridge regression: per-(group, regParam) normal equations built from
  ``covar_pop`` moments and solved by Gauss–Jordan elimination in a recursive
  CTE over a list-of-lists matrix;
* regression trees: unpivot -> group by (node, feature, value) -> running
  sums -> variance-reduction gain at every candidate threshold -> best split
  per node (first feature and lowest threshold win ties, as in MLlib), level
  by level; candidate thresholds are midpoints to the next value of the
  tree's whole training set, as MLlib computes them once per fit;
* splits and folds from the same md5 key hash the Spark side uses.
"""

from __future__ import annotations

from lumenreg import config as C
from lumenreg.functions.numeric import sig_round_sql

FEATS = list(C.FEATURE_COLS)
P = len(FEATS)

SALES_CTE = """sales AS (
  SELECT CAST(p.p_size AS DOUBLE) AS Pack,
         CAST(l.l_linenumber AS DOUBLE) AS BottleVolumeInMl,
         p.p_retailprice AS StateBottleCost,
         p.p_retailprice * (1 + l.l_tax) AS StateBottleRetail,
         l.l_quantity AS BottlesSold,
         l.l_quantity * (p.p_retailprice * (1 + l.l_tax)) AS SaleInDollars,
         l.l_quantity * (1 - l.l_discount) AS VolumeSoldInLitres,
         ('0x' || substr(md5(concat_ws('|', l.l_orderkey, l.l_linenumber, l.l_partkey,
                                       l.l_suppkey)), 1, 8))::BIGINT AS h
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

FEAT_CTE = f"""feat AS (
  SELECT {', '.join(FEATS)}, SaleInDollars AS label, h,
         h % 10 AS digit, h // 10 AS hq
  FROM sales)"""


def _with(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes)


def feature_value_sql(fi: str, qualifier: str = "") -> str:
    """Value of feature number ``fi`` (1-based) of the current row."""
    q = f"{qualifier}." if qualifier else ""
    whens = " ".join(f"WHEN {i + 1} THEN {q}{c}" for i, c in enumerate(FEATS))
    return f"(CASE {fi} {whens} END)"


def linear_pred_sql(coef: str = "coef", intercept: str = "intercept") -> str:
    terms = " + ".join(f"{coef}[{i + 1}] * {c}" for i, c in enumerate(FEATS))
    return f"({intercept} + {terms})"


# --------------------------------------------------------------------------
# ridge regression by Gauss-Jordan in a recursive CTE
# --------------------------------------------------------------------------

def ridge_ctes(prefix: str, rows: str, lams: str) -> list[str]:
    """CTEs ending in ``{prefix}_fit(key, lam, coef, intercept)``.

    ``rows(key, <features>, label)``: training rows per key;
    ``lams(lam)``: regParam values. Population moments, standardised
    normal equations with penalty lam / sd(label), as MLlib's normal solver.
    """
    cols = FEATS + ["label"]
    mu = "[" + ", ".join(f"avg({c})" for c in cols) + "]"
    cov = "[" + ", ".join(
        "[" + ", ".join(f"covar_pop({a}, {b})" for b in cols) + "]" for a in cols) + "]"
    d = P + 1
    st = f"""{prefix}_st AS (
  SELECT key, {mu} AS mu, {cov} AS cov FROM {rows} GROUP BY key)"""
    sc = f"""{prefix}_sc AS (
  SELECT s.key, CAST(g.lam AS DOUBLE) AS lam, s.mu, s.cov,
         list_transform(range(1, {d + 1}), lambda i: sqrt(s.cov[i][i])) AS sd
  FROM {prefix}_st s CROSS JOIN {lams} g)"""
    aug = f"""{prefix}_aug AS (
  SELECT key, lam, mu, sd,
         list_transform(range(1, {P + 1}), lambda i: list_transform(range(1, {d + 1}), lambda j:
           CASE WHEN j <= {P}
                THEN cov[i][j] / (sd[i] * sd[j]) + CASE WHEN i = j THEN lam / sd[{d}] ELSE 0.0 END
                ELSE cov[i][{d}] / (sd[i] * sd[{d}]) END)) AS m
  FROM {prefix}_sc)"""
    ge = f"""{prefix}_ge(key, lam, mu, sd, k, m) AS (
  SELECT key, lam, mu, sd, 1, m FROM {prefix}_aug
  UNION ALL
  SELECT key, lam, mu, sd, k + 1,
         list_transform(range(1, {P + 1}), lambda i: list_transform(range(1, {d + 1}), lambda j:
           CASE WHEN i = k THEN m[k][j] / m[k][k]
                ELSE m[i][j] - m[i][k] * m[k][j] / m[k][k] END))
  FROM {prefix}_ge WHERE k <= {P})"""
    coef = f"""{prefix}_coef AS (
  SELECT key, lam, mu,
         list_transform(range(1, {P + 1}), lambda i: m[i][{d}] * sd[{d}] / sd[i]) AS coef
  FROM {prefix}_ge WHERE k = {P + 1})"""
    fit = f"""{prefix}_fit AS (
  SELECT key, lam, coef,
         mu[{d}] - list_sum(list_transform(range(1, {P + 1}), lambda i: coef[i] * mu[i])) AS intercept
  FROM {prefix}_coef)"""
    return [st, sc, aug, ge, coef, fit]


# --------------------------------------------------------------------------
# depth-1 regression tree (variance reduction over all midpoints)
# --------------------------------------------------------------------------

def stump_ctes(prefix: str, rows: str) -> list[str]:
    """CTEs ending in ``{prefix}_best(key, fi, thr, lval, rval, gain)``.

    ``rows(key, <features>, y)``. Feature ``fi`` is 1-based; rows with
    value <= thr go left.
    """
    long = " UNION ALL ".join(
        f"SELECT key, {i + 1} AS fi, {c} AS v, y FROM {rows}" for i, c in enumerate(FEATS))
    return [
        f"{prefix}_long AS ({long})",
        f"""{prefix}_agg AS (
  SELECT key, fi, v, count(*) AS c, sum(y) AS s, sum(y * y) AS ss
  FROM {prefix}_long GROUP BY key, fi, v)""",
        f"""{prefix}_cum AS (
  SELECT key, fi, v,
         sum(c) OVER (PARTITION BY key, fi ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lc,
         sum(s) OVER (PARTITION BY key, fi ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ls,
         sum(ss) OVER (PARTITION BY key, fi ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lss,
         lead(v) OVER (PARTITION BY key, fi ORDER BY v) AS nv
  FROM {prefix}_agg)""",
        f"""{prefix}_tot AS (
  SELECT key, count(*) AS n, sum(y) AS s, sum(y * y) AS ss FROM {rows} GROUP BY key)""",
        f"""{prefix}_gain AS (
  SELECT c.key, c.fi, (c.v + c.nv) / 2 AS thr,
         c.ls / c.lc AS lval, (t.s - c.ls) / (t.n - c.lc) AS rval,
         (t.ss / t.n - (t.s / t.n) * (t.s / t.n))
           - (c.lc / t.n) * (c.lss / c.lc - (c.ls / c.lc) * (c.ls / c.lc))
           - ((t.n - c.lc) / t.n) * ((t.ss - c.lss) / (t.n - c.lc)
                                     - ((t.s - c.ls) / (t.n - c.lc)) * ((t.s - c.ls) / (t.n - c.lc))) AS gain
  FROM {prefix}_cum c JOIN {prefix}_tot t ON c.key = t.key
  WHERE c.nv IS NOT NULL)""",
        f"""{prefix}_best AS (
  SELECT key, fi, thr, lval, rval, gain FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY gain DESC, fi, thr) AS rn
    FROM {prefix}_gain) WHERE rn = 1)""",
    ]


def tree_ctes(prefix: str, train: str, test: str, depth: int, *,
              limits: str | None = None, carry: list[str] | None = None) -> list[str]:
    """CTEs ending in ``{prefix}_scored(key, label, pred)``: regression trees.

    ``train(key, <features>, y)`` holds the training rows of every tree
    (``key`` = fold or 0), ``test(key, <features>, label)`` the rows each tree
    scores. Level by level, every open node takes its best variance-reduction
    split (first feature, then lowest threshold, win ties) if the gain is
    positive; thresholds are midpoints between a value and the *next value of
    the whole training set of that tree* (candidates are global, so among
    equal partitions the lowest threshold wins; between adjacent doubles
    the lower one is the threshold). Gains that agree to nine digits are
    taken as equal, as sums in another order can't tell them apart. Nodes use heap numbering.
    Predictions are the mean training label of the leaf a row reaches.

    ``limits(key, max_depth, min_gain)`` optionally gives each tree its own
    depth limit and minimum gain (a split needs gain > 0 and >= min_gain);
    ``carry`` lists extra test columns passed through to the output.
    """
    carry = list(carry or [])
    tcarry = "".join(f", t.{c}" for c in carry)
    ccarry = "".join(f", {c}" for c in carry)
    fv = feature_value_sql
    feats = ", ".join(FEATS)
    long = " UNION ALL ".join(
        f"SELECT key, {i + 1} AS fi, {c} AS v FROM {train}" for i, c in enumerate(FEATS))
    ctes = [
        f"""{prefix}_gv AS (
  SELECT key, fi, v, lead(v) OVER (PARTITION BY key, fi ORDER BY v) AS gnv
  FROM (SELECT DISTINCT key, fi, v FROM ({long})))""",
        f"{prefix}_r0 AS (SELECT key, 1 AS node, 0 AS done, {feats}, y FROM {train})",
        f"{prefix}_t0 AS (SELECT key, 1 AS node, {feats}, label{ccarry} FROM {test})",
    ]
    for lv in range(depth):
        rows, nxt, s = f"{prefix}_r{lv}", f"{prefix}_r{lv + 1}", f"{prefix}_s{lv}"
        ctes.append(f"""{s}_in AS (
  SELECT key * 1024 + node AS key, key AS gkey, {feats}, y FROM {rows} WHERE done = 0)""")
        longn = " UNION ALL ".join(
            f"SELECT key, gkey, {i + 1} AS fi, {c} AS v, y FROM {s}_in" for i, c in enumerate(FEATS))
        ctes += [
            f"""{s}_agg AS (
  SELECT key, gkey, fi, v, count(*) AS c, sum(y) AS s, sum(y * y) AS ss
  FROM ({longn}) GROUP BY key, gkey, fi, v)""",
            f"""{s}_cum AS (
  SELECT key, gkey, fi, v,
         sum(c) OVER (PARTITION BY key, fi ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lc,
         sum(s) OVER (PARTITION BY key, fi ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ls,
         sum(ss) OVER (PARTITION BY key, fi ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lss,
         lead(v) OVER (PARTITION BY key, fi ORDER BY v) AS nv
  FROM {s}_agg)""",
            f"""{s}_tot AS (
  SELECT key, count(*) AS n, sum(y) AS s, sum(y * y) AS ss FROM {s}_in GROUP BY key)""",
            f"""{s}_gain AS (
  SELECT c.key, c.gkey, c.fi, CASE WHEN (c.v + g.gnv) / 2 < g.gnv THEN (c.v + g.gnv) / 2 ELSE c.v END AS thr,
         (t.ss / t.n - (t.s / t.n) * (t.s / t.n))
           - (c.lc / t.n) * (c.lss / c.lc - (c.ls / c.lc) * (c.ls / c.lc))
           - ((t.n - c.lc) / t.n) * ((t.ss - c.lss) / (t.n - c.lc)
                                     - ((t.s - c.ls) / (t.n - c.lc)) * ((t.s - c.ls) / (t.n - c.lc))) AS gain
  FROM {s}_cum c JOIN {s}_tot t ON c.key = t.key
       JOIN {prefix}_gv g ON g.key = c.gkey AND g.fi = c.fi AND g.v = c.v
  WHERE c.nv IS NOT NULL)""",
            f"""{s}_best AS (
  SELECT b.gkey AS fk, b.key % 1024 AS node, b.fi, b.thr FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY round(gain / top, 9) DESC, fi, thr) AS rn
    FROM (SELECT *, max(gain) OVER (PARTITION BY key) AS top FROM {s}_gain WHERE gain > 0)) b{f' JOIN {limits} lim ON lim.key = b.gkey' if limits else ''}
  WHERE b.rn = 1 AND b.gain > 0{f' AND b.gain >= lim.min_gain AND {lv} < lim.max_depth' if limits else ''})""",
            f"""{nxt} AS (
  SELECT r.key,
         CASE WHEN b.node IS NULL THEN r.node
              WHEN {fv('b.fi', 'r')} <= b.thr THEN 2 * r.node
              ELSE 2 * r.node + 1 END AS node,
         CASE WHEN r.done = 1 OR b.node IS NULL THEN 1 ELSE 0 END AS done,
         {', '.join('r.' + c for c in FEATS)}, r.y
  FROM {rows} r LEFT JOIN {s}_best b ON r.done = 0 AND r.key = b.fk AND r.node = b.node)""",
            f"""{prefix}_t{lv + 1} AS (
  SELECT t.key,
         CASE WHEN b.node IS NULL THEN t.node
              WHEN {fv('b.fi', 't')} <= b.thr THEN 2 * t.node
              ELSE 2 * t.node + 1 END AS node,
         {', '.join('t.' + c for c in FEATS)}, t.label{tcarry}
  FROM {prefix}_t{lv} t LEFT JOIN {s}_best b ON t.key = b.fk AND t.node = b.node)""",
        ]
    ctes += [
        f"""{prefix}_leaf AS (
  SELECT key, node, avg(y) AS mean FROM {prefix}_r{depth} GROUP BY key, node)""",
        f"""{prefix}_scored AS (
  SELECT t.key, {', '.join('t.' + c for c in FEATS)}, t.label{tcarry}, l.mean AS pred
  FROM {prefix}_t{depth} t JOIN {prefix}_leaf l ON t.key = l.key AND t.node = l.node)""",
    ]
    return ctes


def stump_leaf_sql(best: str, side: str = "leaf") -> str:
    """CASE giving the leaf value of the current row under split ``best``."""
    return (f"(CASE WHEN {feature_value_sql(best + '.fi')} <= {best}.thr "
            f"THEN {best}.lval ELSE {best}.rval END)")


def sr(expr: str, digits: int = 6) -> str:
    return sig_round_sql(expr, digits)
