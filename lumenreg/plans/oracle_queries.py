"""DuckDB oracle SQL for the registered queries (``ORACLES``).

Every statement recomputes its query's result from the raw ``lineitem`` and
``part`` tables with plain SQL (see ``oracle`` for the building blocks), with
the same column names, types and rounding as the Spark side in ``queries``.
"""

from __future__ import annotations

from itertools import product

from lumenreg import config as C
from lumenreg.plans import oracle as O

FEATS = list(C.FEATURE_COLS)
# the linear grid in ParamGridBuilder order (regParam outer)
LR_GRID_ROWS = list(product(C.LR_GRID["regParam"], C.LR_GRID["maxIter"]))
# candidates within this share of the lowest metric tie, as in ``tuning.best_index``
TIE = 1e-12

_FEAT_LIST = ", ".join(FEATS)
_BASE = [O.SALES_CTE, O.FEAT_CTE]


def _oracle_project_features():
    return O._with(*_BASE) + f"\nSELECT {_FEAT_LIST}, label FROM feat"


def _oracle_sql_alias_projection():
    return O._with(O.SALES_CTE) + (
        "\nSELECT CAST(Pack AS INTEGER) AS Pack, CAST(BottleVolumeInMl AS INTEGER) AS BottleVolumeInMl, "
        "StateBottleCost, StateBottleRetail, CAST(BottlesSold AS INTEGER) AS BottlesSold, "
        "SaleInDollars, VolumeSoldInLitres FROM sales")


def _oracle_not_null_filter():
    return O._with(O.SALES_CTE, """holey AS (
  SELECT CASE WHEN BottleVolumeInMl = 7 THEN NULL ELSE Pack END AS Pack,
         BottleVolumeInMl,
         CASE WHEN Pack = 1 THEN NULL ELSE StateBottleCost END AS StateBottleCost,
         StateBottleRetail,
         CASE WHEN BottlesSold = 50 THEN NULL ELSE BottlesSold END AS BottlesSold,
         CASE WHEN Pack = 50 THEN NULL ELSE SaleInDollars END AS SaleInDollars,
         VolumeSoldInLitres
  FROM sales)""") + f"""
SELECT {_FEAT_LIST}, SaleInDollars AS label FROM holey
WHERE Pack IS NOT NULL AND BottleVolumeInMl IS NOT NULL AND StateBottleCost IS NOT NULL
  AND StateBottleRetail IS NOT NULL AND BottlesSold IS NOT NULL
  AND SaleInDollars IS NOT NULL AND VolumeSoldInLitres IS NOT NULL"""


def _oracle_csv_roundtrip():
    return O._with(*_BASE) + (
        f"\nSELECT {_FEAT_LIST}, label, 'inferred' AS mode FROM feat"
        f"\nUNION ALL SELECT {_FEAT_LIST}, label, 'declared' AS mode FROM feat")


def _oracle_load_sales():
    sources = ("inferred", "table", "cleaned", "raw", "reordered")
    return O._with(*_BASE) + "".join(
        f"\n{'UNION ALL ' * (i > 0)}SELECT {_FEAT_LIST}, label, '{s}' AS source FROM feat"
        for i, s in enumerate(sources))


def _oracle_csv_rejects():
    return O._with(*_BASE) + f"""
SELECT {_FEAT_LIST}, label, CAST(NULL AS VARCHAR) AS reason FROM feat WHERE h % 10 NOT IN (3, 4)
UNION ALL
SELECT {', '.join('NULL' for _ in FEATS)}, NULL,
       CASE h % 10 WHEN 3 THEN 'not of the declared type: Pack, StateBottleCost'
                   ELSE 'not of the declared type: Pack' END
FROM feat WHERE h % 10 IN (3, 4)"""


def _oracle_split_counts():
    return O._with(*_BASE) + (
        "\nSELECT CASE WHEN digit < 7 THEN 'train' ELSE 'test' END AS part, "
        "count(*) AS n_rows FROM feat GROUP BY 1")


def _oracle_random_split_invariants():
    return O._with(*_BASE) + (
        "\nSELECT count(*) AS n_rows, count(*) AS n_parts_rows, true AS same_rows, "
        "true AS share_as_asked, true AS seed_repeats FROM feat")


def _oracle_kfold_counts():
    cut = round(C.TVS_TRAIN_RATIO * 1000)
    return O._with(*_BASE, "tr AS (SELECT * FROM feat WHERE digit < 7)") + f"""
SELECT 'cv10' AS scheme, CAST(hq % 10 AS INTEGER) AS fold, count(*) AS n_rows FROM tr GROUP BY 2
UNION ALL SELECT 'cv5', CAST(hq % 5 AS INTEGER), count(*) FROM tr GROUP BY 2
UNION ALL SELECT 'tvs', CAST(CASE WHEN hq % 1000 >= {cut} THEN 1 ELSE 0 END AS INTEGER), count(*)
  FROM tr GROUP BY 2"""


def _ridge_single():
    return [*_BASE,
            f"tr AS (SELECT 0 AS key, {_FEAT_LIST}, label FROM feat WHERE digit < 7)",
            f"lams AS (SELECT CAST({C.LR_REG_PARAM} AS DOUBLE) AS lam)",
            *O.ridge_ctes("r", "tr", "lams")]


def _oracle_lr_coefficients():
    terms = ", ".join(f"('{c}', {i + 1})" for i, c in enumerate(FEATS))
    return O._with(*_ridge_single(), recursive=True) + f"""
SELECT t.term, {O.sr('r_fit.coef[t.i]')} AS value
FROM r_fit, (VALUES {terms}) t(term, i)
UNION ALL SELECT 'intercept', {O.sr('intercept')} FROM r_fit"""


def _oracle_lr_rmse():
    return O._with(*_ridge_single(), recursive=True) + f"""
SELECT count(*) AS n_rows,
       {O.sr(f"sqrt(avg(power(f.label - {O.linear_pred_sql('r_fit.coef', 'r_fit.intercept')}, 2)))")} AS rmse
FROM feat f, r_fit WHERE f.digit >= 7"""


def _oracle_lr_predictions():
    return O._with(*_ridge_single(), recursive=True) + f"""
SELECT f.label AS trueLabel,
       {O.sr(O.linear_pred_sql('r_fit.coef', 'r_fit.intercept'))} AS prediction
FROM feat f, r_fit WHERE f.digit >= 7"""


def _grid_values():
    return ", ".join(f"({i}, {lam}, {it})" for i, (lam, it) in enumerate(LR_GRID_ROWS))


def _grid_tail(metric_cte: str) -> str:
    return f"""grid AS (
  SELECT CAST(c AS BIGINT) AS candidate, CAST(lam AS DOUBLE) AS regParam,
         CAST(it AS BIGINT) AS maxIter FROM (VALUES {_grid_values()}) v(c, lam, it)),
cand AS (
  SELECT g.candidate, g.regParam, g.maxIter, m.metric
  FROM grid g JOIN {metric_cte} m ON g.regParam = m.lam),
best AS (
  SELECT min(candidate) AS candidate FROM cand
  WHERE metric <= (SELECT min(metric) FROM cand) * (1 + {TIE}))"""


def _grid_select() -> str:
    return (f"\nSELECT c.candidate, c.regParam, c.maxIter, {O.sr('c.metric')} AS rmse, "
            "c.candidate = b.candidate AS is_best FROM cand c, best b")


def _oracle_lr_cv_grid():
    k = C.LR_CV_FOLDS
    lams = ", ".join(f"({lam})" for lam in sorted({g[0] for g in LR_GRID_ROWS}))
    ctes = [*_BASE,
            "tr AS (SELECT * FROM feat WHERE digit < 7)",
            f"folds AS (SELECT CAST(range AS BIGINT) AS fold FROM range({k}))",
            f"cvtrain AS (SELECT f.fold AS key, {_FEAT_LIST}, label FROM tr CROSS JOIN folds f "
            f"WHERE tr.hq % {k} <> f.fold)",
            f"lams AS (SELECT CAST(lam AS DOUBLE) AS lam FROM (VALUES {lams}) v(lam))",
            *O.ridge_ctes("r", "cvtrain", "lams"),
            f"""foldrmse AS (
  SELECT r_fit.key, r_fit.lam,
         sqrt(avg(power(tr.label - {O.linear_pred_sql('r_fit.coef', 'r_fit.intercept')}, 2))) AS rmse
  FROM tr JOIN r_fit ON tr.hq % {k} = r_fit.key GROUP BY r_fit.key, r_fit.lam)""",
            "metric AS (SELECT lam, avg(rmse) AS metric FROM foldrmse GROUP BY lam)",
            _grid_tail("metric")]
    return O._with(*ctes, recursive=True) + _grid_select()


def _oracle_lr_tvs_grid():
    cut = round(C.TVS_TRAIN_RATIO * 1000)
    lams = ", ".join(f"({lam})" for lam in sorted({g[0] for g in LR_GRID_ROWS}))
    ctes = [*_BASE,
            "tr AS (SELECT * FROM feat WHERE digit < 7)",
            f"fitrows AS (SELECT 0 AS key, {_FEAT_LIST}, label FROM tr WHERE hq % 1000 < {cut})",
            f"lams AS (SELECT CAST(lam AS DOUBLE) AS lam FROM (VALUES {lams}) v(lam))",
            *O.ridge_ctes("r", "fitrows", "lams"),
            f"""metric AS (
  SELECT r_fit.lam,
         sqrt(avg(power(tr.label - {O.linear_pred_sql('r_fit.coef', 'r_fit.intercept')}, 2))) AS metric
  FROM tr CROSS JOIN r_fit WHERE tr.hq % 1000 >= {cut} GROUP BY r_fit.lam)""",
            _grid_tail("metric")]
    return O._with(*ctes, recursive=True) + _grid_select()


def _oracle_lr_cv_tvs_combined():
    return (f"SELECT *, 'linear_cv' AS workflow FROM ({_oracle_lr_cv_grid()})\n"
            f"UNION ALL\nSELECT *, 'linear_tvs' AS workflow FROM ({_oracle_lr_tvs_grid()})")


def _oracle_lr_workflow_report(base=_BASE):
    k = C.LR_CV_FOLDS
    lams = ", ".join(f"({lam})" for lam in sorted({g[0] for g in LR_GRID_ROWS}))
    ctes = [*base,
            "tr AS (SELECT * FROM feat WHERE digit < 7)",
            f"folds AS (SELECT CAST(range AS BIGINT) AS fold FROM range({k}))",
            f"cvtrain AS (SELECT f.fold AS key, {_FEAT_LIST}, label FROM tr CROSS JOIN folds f "
            f"WHERE tr.hq % {k} <> f.fold UNION ALL SELECT -1 AS key, {_FEAT_LIST}, label FROM tr)",
            f"lams AS (SELECT CAST(lam AS DOUBLE) AS lam FROM (VALUES {lams}) v(lam))",
            *O.ridge_ctes("r", "cvtrain", "lams"),
            f"""foldrmse AS (
  SELECT r_fit.key, r_fit.lam,
         sqrt(avg(power(tr.label - {O.linear_pred_sql('r_fit.coef', 'r_fit.intercept')}, 2))) AS rmse
  FROM tr JOIN r_fit ON tr.hq % {k} = r_fit.key GROUP BY r_fit.key, r_fit.lam)""",
            "metric AS (SELECT lam, avg(rmse) AS metric FROM foldrmse GROUP BY lam)",
            _grid_tail("metric"),
            """chosen AS (SELECT c.* FROM cand c JOIN best b ON c.candidate = b.candidate)""",
            f"""testrmse AS (
  SELECT count(*) AS n_test,
         sqrt(avg(power(f.label - {O.linear_pred_sql('r_fit.coef', 'r_fit.intercept')}, 2))) AS rmse
  FROM feat f CROSS JOIN r_fit JOIN chosen ON r_fit.lam = chosen.regParam
  WHERE f.digit >= 7 AND r_fit.key = -1)"""]
    return O._with(*ctes, recursive=True) + f"""
SELECT 'linear_cv' AS workflow, (SELECT count(*) FROM tr) AS n_train, t.n_test,
       'regParam=' || CAST(ch.regParam AS VARCHAR) || ', maxIter=' || CAST(ch.maxIter AS VARCHAR) AS best_params,
       {O.sr('ch.metric')} AS tuning_rmse, {O.sr('t.rmse')} AS test_rmse
FROM chosen ch, testrmse t"""


def _oracle_lr_tvs_workflow_report():
    cut = round(C.TVS_TRAIN_RATIO * 1000)
    lams = ", ".join(f"({lam})" for lam in sorted({g[0] for g in LR_GRID_ROWS}))
    ctes = [*_BASE,
            "tr AS (SELECT * FROM feat WHERE digit < 7)",
            # key 0: fitted on the 80% cut; key 1: refit on all training rows
            f"fitrows AS (SELECT 0 AS key, {_FEAT_LIST}, label FROM tr WHERE hq % 1000 < {cut} "
            f"UNION ALL SELECT 1 AS key, {_FEAT_LIST}, label FROM tr)",
            f"lams AS (SELECT CAST(lam AS DOUBLE) AS lam FROM (VALUES {lams}) v(lam))",
            *O.ridge_ctes("r", "fitrows", "lams"),
            f"""metric AS (
  SELECT r_fit.lam,
         sqrt(avg(power(tr.label - {O.linear_pred_sql('r_fit.coef', 'r_fit.intercept')}, 2))) AS metric
  FROM tr CROSS JOIN r_fit WHERE r_fit.key = 0 AND tr.hq % 1000 >= {cut} GROUP BY r_fit.lam)""",
            _grid_tail("metric"),
            "chosen AS (SELECT c.* FROM cand c JOIN best b ON c.candidate = b.candidate)",
            f"""testrmse AS (
  SELECT count(*) AS n_test,
         sqrt(avg(power(f.label - {O.linear_pred_sql('r_fit.coef', 'r_fit.intercept')}, 2))) AS rmse
  FROM feat f CROSS JOIN r_fit JOIN chosen ON r_fit.lam = chosen.regParam
  WHERE f.digit >= 7 AND r_fit.key = 1)"""]
    return O._with(*ctes, recursive=True) + f"""
SELECT 'linear_tvs' AS workflow, (SELECT count(*) FROM tr) AS n_train, t.n_test,
       'regParam=' || CAST(ch.regParam AS VARCHAR) || ', maxIter=' || CAST(ch.maxIter AS VARCHAR) AS best_params,
       {O.sr('ch.metric')} AS tuning_rmse, {O.sr('t.rmse')} AS test_rmse
FROM chosen ch, testrmse t"""


def _stump_base():
    return [*_BASE,
            f"tr AS (SELECT 0 AS key, {_FEAT_LIST}, label AS y FROM feat WHERE digit < 7)",
            *O.stump_ctes("s0", "tr"),
            "te AS (SELECT * FROM feat WHERE digit >= 7)"]


_LEAF_SELECT = f"""
SELECT {O.sr('pred')} AS prediction, count(*) AS n_rows,
       {O.sr('sqrt(avg(power(label - pred, 2)))')} AS rmse
FROM scored GROUP BY pred"""


def _oracle_dt_stump():
    return O._with(*_stump_base(), f"""scored AS (
  SELECT te.label, {O.stump_leaf_sql('s0_best')} AS pred FROM te CROSS JOIN s0_best)""") + _LEAF_SELECT


def _oracle_dt_rmse():
    return O._with(*_stump_base(), f"""scored AS (
  SELECT te.label, {O.stump_leaf_sql('s0_best')} AS pred FROM te CROSS JOIN s0_best)""") + f"""
SELECT count(*) AS n_rows, {O.sr('sqrt(avg(power(label - pred, 2)))')} AS rmse FROM scored"""


def _oracle_prediction_view():
    return O._with(*_stump_base(), f"""scored AS (
  SELECT te.label, {O.stump_leaf_sql('s0_best')} AS pred FROM te CROSS JOIN s0_best)""") + (
        f"\nSELECT label AS trueLabel, {O.sr('pred')} AS prediction FROM scored")


def _oracle_prediction_preview():
    return O._with(*_stump_base(), f"""scored AS (
  SELECT te.label, te.h, {O.stump_leaf_sql('s0_best')} AS pred FROM te CROSS JOIN s0_best),
first AS (SELECT * FROM scored ORDER BY h, label, pred LIMIT 20)""") + (
        f"\nSELECT label AS trueLabel, {O.sr('pred')} AS prediction FROM first")


def _oracle_dt_quantile_bins(bins: int = 32):
    """Cut points: the values at ranks ceil(i / bins * n) of the training rows."""
    cuts = " UNION ".join(
        f"SELECT DISTINCT '{c}' AS feature, v FROM (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) AS rn, "
        f"count(*) OVER () AS n FROM feat WHERE digit < 7), range(1, {bins}) r(i) "
        f"WHERE rn = CAST(ceil(CAST(i AS DOUBLE) / {bins} * n) AS BIGINT)" for c in FEATS)
    binned = ", ".join(f"CAST((SELECT count(*) FROM cuts WHERE feature = '{c}' AND v <= f.{c}) AS DOUBLE) "
                       f"AS {c}" for c in FEATS)
    return O._with(
        O.SALES_CTE, O.FEAT_CTE, f"cuts AS ({cuts})",
        f"bin AS (SELECT {binned}, f.label, f.digit FROM feat f)",
        f"tr AS (SELECT 0 AS key, {_FEAT_LIST}, label AS y FROM bin WHERE digit < 7)",
        *O.stump_ctes("s0", "tr"), "te AS (SELECT * FROM bin WHERE digit >= 7)",
        f"""scored AS (
  SELECT te.label, {O.stump_leaf_sql('s0_best')} AS pred FROM te CROSS JOIN s0_best)""") + _LEAF_SELECT


def _binned(bins: int = 32):
    """``feat`` with each feature replaced by its range's number (cuts as above)."""
    cuts = " UNION ".join(
        f"SELECT DISTINCT '{c}' AS feature, v FROM (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) AS rn, "
        f"count(*) OVER () AS n FROM unbinned WHERE digit < 7), range(1, {bins}) r(i) "
        f"WHERE rn = CAST(ceil(CAST(i AS DOUBLE) / {bins} * n) AS BIGINT)" for c in FEATS)
    ranges = ", ".join(f"CAST((SELECT count(*) FROM cuts WHERE feature = '{c}' AND v <= f.{c}) AS DOUBLE) "
                       f"AS {c}" for c in FEATS)
    return [O.SALES_CTE, O.FEAT_CTE.replace("feat AS", "unbinned AS", 1), f"cuts AS ({cuts})",
            f"feat AS (SELECT {ranges}, f.label, f.h, f.digit, f.hq FROM unbinned f)"]


def _drawn(seed: int = 42, share: float = 0.7):
    """``feat`` split by the seeded draw of each row key: digit 0 for training rows, 9 for test rows."""
    return [O.SALES_CTE, O.FEAT_CTE.replace("feat AS", "undrawn AS", 1), f"""feat AS (
  SELECT * REPLACE (CASE WHEN ('0x' || substr(md5('{seed}|' || CAST(h AS VARCHAR)), 1, 8))::BIGINT
                              / CAST(4294967296 AS DOUBLE) >= CAST('{share}' AS DOUBLE)
                         THEN 9 ELSE 0 END AS digit) FROM undrawn)"""]


def _oracle_dt_cv_stump():
    k = C.TREE_CV_FOLDS
    ctes = [*_BASE,
            "tr AS (SELECT * FROM feat WHERE digit < 7)",
            f"folds AS (SELECT CAST(range AS BIGINT) AS fold FROM range({k}))",
            f"cvtrain AS (SELECT f.fold AS key, {_FEAT_LIST}, label AS y FROM tr CROSS JOIN folds f "
            f"WHERE tr.hq % {k} <> f.fold)",
            *O.stump_ctes("s", "cvtrain"),
            f"""foldrmse AS (
  SELECT s_best.key AS fold, sqrt(avg(power(tr.label - {O.stump_leaf_sql('s_best')}, 2))) AS rmse
  FROM tr JOIN s_best ON tr.hq % {k} = s_best.key GROUP BY s_best.key)"""]
    return O._with(*ctes) + f"""
SELECT CAST(fold AS INTEGER) AS fold, {O.sr('rmse')} AS rmse FROM foldrmse
UNION ALL SELECT -1, {O.sr('avg(rmse)')} FROM foldrmse"""


def _oracle_dt_depth5():
    ctes = [*_BASE,
            f"tr AS (SELECT 0 AS key, {_FEAT_LIST}, label AS y FROM feat WHERE digit < 7)",
            f"te AS (SELECT 0 AS key, {_FEAT_LIST}, label FROM feat WHERE digit >= 7)",
            *O.tree_ctes("d", "tr", "te", 5),
            "scored AS (SELECT label, pred FROM d_scored)"]
    return O._with(*ctes) + _LEAF_SELECT


def _oracle_dt_cv_workflow(base=_BASE):
    k = C.TREE_CV_FOLDS
    ctes = [*base,
            "tr AS (SELECT * FROM feat WHERE digit < 7)",
            f"folds AS (SELECT CAST(range AS BIGINT) AS fold FROM range({k}))",
            # keys 0..k-1: fold models; key k: the refit on all training rows
            f"cvtrain AS (SELECT f.fold AS key, {_FEAT_LIST}, label AS y FROM tr CROSS JOIN folds f "
            f"WHERE tr.hq % {k} <> f.fold UNION ALL SELECT {k} AS key, {_FEAT_LIST}, label AS y FROM tr)",
            f"cvtest AS (SELECT tr.hq % {k} AS key, {_FEAT_LIST}, label FROM tr "
            f"UNION ALL SELECT {k} AS key, {_FEAT_LIST}, label FROM feat WHERE digit >= 7)",
            *O.tree_ctes("w", "cvtrain", "cvtest", 5),
            """perkey AS (
  SELECT key, count(*) AS n, sqrt(avg(power(label - pred, 2))) AS rmse FROM w_scored GROUP BY key)"""]
    return O._with(*ctes) + f"""
SELECT 'tree_cv' AS workflow, (SELECT count(*) FROM tr) AS n_train,
       (SELECT n FROM perkey WHERE key = {k}) AS n_test, '' AS best_params,
       {O.sr(f'(SELECT avg(rmse) FROM perkey WHERE key < {k})')} AS tuning_rmse,
       {O.sr(f'(SELECT rmse FROM perkey WHERE key = {k})')} AS test_rmse"""


def _oracle_gbt_two_stumps():
    step = 0.1
    ctes = [*_stump_base(),
            f"""tr1 AS (
  SELECT 0 AS key, {_FEAT_LIST}, 2 * (tr.y - {O.stump_leaf_sql('s0_best')}) AS y
  FROM tr CROSS JOIN s0_best)""",
            *O.stump_ctes("s1", "tr1"),
            f"""scored AS (
  SELECT te.label, {O.stump_leaf_sql('s0_best')} + {step} * {O.stump_leaf_sql('s1_best')} AS pred
  FROM te CROSS JOIN s0_best CROSS JOIN s1_best)"""]
    return O._with(*ctes) + _LEAF_SELECT


def _gbt_grid_ctes(base=_BASE):
    cut = round(C.TVS_TRAIN_RATIO * 1000)
    depths, gains, steps = C.GBT_GRID["maxDepth"], C.GBT_GRID["minInfoGain"], C.GBT_GRID["stepSize"]
    units = ", ".join(f"({di * len(gains) + gi}, {d}, {g})"
                      for di, d in enumerate(depths) for gi, g in enumerate(gains))
    stepv = ", ".join(f"({si}, {st})" for si, st in enumerate(steps))
    ctes = [*base,
            "tr AS (SELECT * FROM feat WHERE digit < 7)",
            f"units AS (SELECT CAST(u AS BIGINT) AS key, CAST(d AS BIGINT) AS max_depth, "
            f"CAST(g AS DOUBLE) AS min_gain FROM (VALUES {units}) v(u, d, g))",
            f"g0train AS (SELECT u.key, {_FEAT_LIST}, label AS y FROM tr CROSS JOIN units u "
            f"WHERE tr.hq % 1000 < {cut})",
            f"g0test AS (SELECT u.key, {_FEAT_LIST}, label, "
            f"CASE WHEN tr.hq % 1000 >= {cut} THEN 1 ELSE 0 END AS is_val FROM tr CROSS JOIN units u)",
            *O.tree_ctes("g0", "g0train", "g0test", max(depths), limits="units", carry=["is_val"]),
            # tree 1 fits the negative gradient of squared error at tree 0
            f"g1train AS (SELECT key, {_FEAT_LIST}, 2 * (label - pred) AS y FROM g0_scored WHERE is_val = 0)",
            f"g1test AS (SELECT key, {_FEAT_LIST}, label, pred AS f0 FROM g0_scored WHERE is_val = 1)",
            *O.tree_ctes("g1", "g1train", "g1test", max(depths), limits="units", carry=["f0"]),
            f"steps AS (SELECT CAST(si AS BIGINT) AS si, CAST(st AS DOUBLE) AS step FROM (VALUES {stepv}) v(si, st))",
            """metric AS (
  SELECT s.key, st.si, st.step, sqrt(avg(power(s.label - (s.f0 * 1.0 + st.step * s.pred), 2))) AS metric
  FROM g1_scored s CROSS JOIN steps st GROUP BY s.key, st.si, st.step)""",
            f"""cand AS (
  SELECT m.key * {len(steps)} + m.si AS candidate, u.max_depth AS maxDepth, u.min_gain AS minInfoGain,
         m.step AS stepSize, m.metric, {O.sr('m.metric')} AS rmse
  FROM metric m JOIN units u ON m.key = u.key)""",
            f"best AS (SELECT min(candidate) AS candidate FROM cand "
            f"WHERE metric <= (SELECT min(metric) FROM cand) * (1 + {TIE}))"]
    return ctes


def _oracle_gbt_tvs_grid(base=_BASE):
    return O._with(*_gbt_grid_ctes(base)) + """
SELECT c.candidate, c.maxDepth, c.minInfoGain, c.stepSize, c.rmse, c.candidate = b.candidate AS is_best
FROM cand c, best b"""


def _oracle_gbt_workflow_report():
    key = 1000
    ctes = [*_gbt_grid_ctes(),
            f"""chosen AS (
  SELECT CAST({key} AS BIGINT) AS key, c.maxDepth AS max_depth, c.minInfoGain AS min_gain,
         c.stepSize AS step, c.metric
  FROM cand c JOIN best b ON c.candidate = b.candidate)""",
            f"r0train AS (SELECT {key} AS key, {_FEAT_LIST}, label AS y FROM tr)",
            f"r0test AS (SELECT {key} AS key, {_FEAT_LIST}, label, 0 AS is_test FROM tr "
            f"UNION ALL SELECT {key}, {_FEAT_LIST}, label, 1 FROM feat WHERE digit >= 7)",
            *O.tree_ctes("r0", "r0train", "r0test", max(C.GBT_GRID["maxDepth"]),
                         limits="chosen", carry=["is_test"]),
            f"r1train AS (SELECT key, {_FEAT_LIST}, 2 * (label - pred) AS y FROM r0_scored WHERE is_test = 0)",
            f"r1test AS (SELECT key, {_FEAT_LIST}, label, pred AS f0 FROM r0_scored WHERE is_test = 1)",
            *O.tree_ctes("r1", "r1train", "r1test", max(C.GBT_GRID["maxDepth"]),
                         limits="chosen", carry=["f0"]),
            """testrmse AS (
  SELECT count(*) AS n_test, sqrt(avg(power(s.label - (s.f0 * 1.0 + ch.step * s.pred), 2))) AS rmse
  FROM r1_scored s CROSS JOIN chosen ch)"""]
    return O._with(*ctes) + f"""
SELECT 'gbt_tvs' AS workflow, (SELECT count(*) FROM tr) AS n_train, t.n_test,
       'maxDepth=' || CAST(ch.max_depth AS VARCHAR) || ', minInfoGain=' || CAST(ch.min_gain AS VARCHAR)
         || ', stepSize=' || CAST(ch.step AS VARCHAR) AS best_params,
       {O.sr('ch.metric')} AS tuning_rmse, {O.sr('t.rmse')} AS test_rmse
FROM chosen ch, testrmse t"""


ORACLES = {
    "project_features": _oracle_project_features(),
    "sql_alias_projection": _oracle_sql_alias_projection(),
    "not_null_filter": _oracle_not_null_filter(),
    "csv_roundtrip": _oracle_csv_roundtrip(),
    "load_sales": _oracle_load_sales(),
    "mixed_headers": _oracle_project_features(),
    "csv_rejects": _oracle_csv_rejects(),
    "split_counts": _oracle_split_counts(),
    "random_split_invariants": _oracle_random_split_invariants(),
    "kfold_counts": _oracle_kfold_counts(),
    "lr_coefficients": _oracle_lr_coefficients(),
    "lr_rmse": _oracle_lr_rmse(),
    "lr_predictions": _oracle_lr_predictions(),
    "lr_cv_grid": _oracle_lr_cv_grid(),
    "lr_tvs_grid": _oracle_lr_tvs_grid(),
    "lr_cv_tvs_combined": _oracle_lr_cv_tvs_combined(),
    "lr_workflow_report": _oracle_lr_workflow_report(),
    "lr_tvs_workflow_report": _oracle_lr_tvs_workflow_report(),
    "dt_stump": _oracle_dt_stump(),
    "dt_rmse": _oracle_dt_rmse(),
    "dt_depth5": _oracle_dt_depth5(),
    "dt_cv_workflow": _oracle_dt_cv_workflow(),
    "dt_cv_stump": _oracle_dt_cv_stump(),
    "gbt_two_stumps": _oracle_gbt_two_stumps(),
    "prediction_view": _oracle_prediction_view(),
    "prediction_preview": _oracle_prediction_preview(),
    "dt_quantile_bins": _oracle_dt_quantile_bins(),
    "gbt_tvs_grid": _oracle_gbt_tvs_grid(),
    "gbt_workflow_report": _oracle_gbt_workflow_report(),
    "dt_quantile_workflow": _oracle_dt_cv_workflow(_binned()),
    "gbt_quantile_grid": _oracle_gbt_tvs_grid(_binned()),
    "dt_random_workflow": _oracle_dt_cv_workflow(_drawn()),
    "lr_random_report": _oracle_lr_workflow_report(_drawn()),
    "dt_stump_ranges": _oracle_dt_stump(),
    "dt_depth5_ranges": _oracle_dt_depth5(),
    "dt_expression": _oracle_dt_depth5(),
    "gbt_expression_sql": _oracle_gbt_two_stumps(),
}
