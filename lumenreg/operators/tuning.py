"""Hyper-parameter tuning: k-fold cross-validation and a held-out cut.

Three engines behind one result type:

* ``tune_ridge`` — closed-form ridge from grouped moments (see ``ridge``):
  one aggregation pass for the whole grid x folds (and the test rows).
* ``tune_trees`` — trees and boosted trees grown from histograms: all folds,
  candidates and the refit in one counting pass a level (see ``histogram_trees``).
* ``tune_estimator`` — any MLlib estimator. Folds come from a fold column (a
  hash of the row key), so every (candidate, fold) fit is independent; fits
  run concurrently from a thread pool (Spark schedules their jobs side by
  side), metrics are the mean validation RMSE per candidate, the first
  candidate wins ties, and the best one is refit on all training rows —
  the semantics of ``CrossValidator`` / ``TrainValidationSplit``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from lumenreg.config import FEATURE_COLS, LABEL_COL, PREDICTION_COL
from lumenreg.operators import histogram_trees as H
from lumenreg.operators import ridge as R
from lumenreg.operators.binning import BINS
from lumenreg.operators.partitioning import keep
from lumenreg.operators.trees import from_mllib


def build_grid(estimator, spec: dict | None) -> list:
    """ParamGridBuilder over ``{param name: values}`` in the given order."""
    builder = ParamGridBuilder()
    for name, values in (spec or {}).items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def grid_dicts(param_maps: list) -> list[dict]:
    return [{p.name: v for p, v in pm.items()} for pm in param_maps]


def best_index(metrics, larger_is_better: bool = False, rel_tol: float = 1e-12) -> int:
    """First index of the best metric; ties go to the earlier candidate.

    Metrics within ``rel_tol`` (relative) of the best count as tied, so
    candidates that yield the same model (e.g. minInfoGain values that prune
    nothing) resolve to the first one whatever order the engine happened to
    add the squared errors in.
    """
    arr = np.asarray(metrics, dtype=float)
    best = np.nanmax(arr) if larger_is_better else np.nanmin(arr)
    slack = rel_tol * abs(best)
    ok = arr >= best - slack if larger_is_better else arr <= best + slack
    return int(np.flatnonzero(ok)[0])


@dataclass
class TuningResult:
    param_maps: list[dict]
    metrics: list[float]
    best: int
    model: object = None
    split_metrics: list[list[float]] = field(default_factory=list)
    extra: dict = field(default_factory=dict)

    def candidates(self, spark: SparkSession, metric_name: str = "rmse") -> DataFrame:
        """Candidates as a DataFrame: one column per parameter, metric, is_best."""
        names = list(self.param_maps[0].keys()) if self.param_maps and self.param_maps[0] else []
        rows = []
        for i, (pm, m) in enumerate(zip(self.param_maps, self.metrics)):
            rows.append(tuple([i] + [pm[n] for n in names] + [float(m), i == self.best]))
        cols = ["candidate"] + names + [metric_name, "is_best"]
        return spark.createDataFrame(rows, cols)


# --------------------------------------------------------------------------
# closed-form ridge: one pass for the whole grid
# --------------------------------------------------------------------------

def _ridge_params(param_maps: list[dict], default_reg: float):
    regs = []
    for pm in param_maps:
        extra = set(pm) - {"regParam", "maxIter", "tol"}
        if extra or pm.get("elasticNetParam", 0.0):
            raise ValueError(f"closed-form path only tunes regParam (and no-op maxIter), got {sorted(extra)}")
        regs.append(float(pm.get("regParam", default_reg)))
    return regs


def tune_ridge(df: DataFrame, param_maps: list[dict], *, group_col: str,
               splits: list[tuple[list, object]], refit_keys: list,
               default_reg: float = 0.0, standardization: bool = True,
               features: list[str] = FEATURE_COLS, label: str = LABEL_COL,
               moments: dict | None = None) -> TuningResult:
    """Grid search for ridge regression from one grouped-moments pass.

    ``group_col`` assigns every row to a group (fold number, validation flag,
    test marker, ...); ``splits`` lists ``(train group keys, validation key)``;
    ``refit_keys`` are the groups the final model is fitted on. Candidates
    that differ only in ``maxIter`` share one solve (the normal solver does not
    iterate), keeping the first-index tie rule.
    """
    regs = _ridge_params(param_maps, default_reg)
    if moments is None:
        moments = R.grouped_moments(df, group_col, features, label)
    distinct = sorted(set(regs), key=regs.index)
    per_reg, per_reg_splits = {}, {}
    for lam in distinct:
        vals = []
        for train_keys, val_key in splits:
            train = R.Moments.combine(moments[k] for k in train_keys if k in moments)
            fit = R.fit_ridge(train, lam, standardization, features)
            if val_key not in moments:
                raise ValueError(f"validation group {val_key!r} has no rows")
            vals.append(R.group_rmse(moments[val_key], fit))
        per_reg[lam], per_reg_splits[lam] = float(np.mean(vals)), vals
    metrics = [per_reg[lam] for lam in regs]
    best = best_index(metrics)
    full = R.Moments.combine(moments[k] for k in refit_keys if k in moments)
    model = R.fit_ridge(full, regs[best], standardization, features)
    return TuningResult(param_maps, metrics, best, model,
                        [per_reg_splits[lam] for lam in regs], {"moments": moments})


def kfold_splits(k: int) -> list[tuple[list, int]]:
    return [([g for g in range(k) if g != f], f) for f in range(k)]


# --------------------------------------------------------------------------
# trees from histograms
# --------------------------------------------------------------------------

TREE_PARAMS = ("maxDepth", "minInfoGain", "maxIter", "stepSize")


def tune_trees(df: DataFrame, param_maps: list[dict], defaults: dict, *, split_col: str,
               folds: list, boosted: bool, binning: str = "exact", bins: int = BINS,
               accuracy: int | None = None, features: list[str] = FEATURE_COLS,
               label: str = LABEL_COL) -> TuningResult:
    """Grid search for trees or boosted trees on kept training rows.

    Each of ``folds`` (values of ``split_col``) is left out in turn and scored; the model
    is the best candidate's refit on all rows. Passes over the rows grow with the depth
    (and, boosted, the iterations), not with folds or candidates.
    """
    param_maps = param_maps or [{}]
    extra = sorted({name for pm in param_maps for name in pm} - set(TREE_PARAMS))
    if extra:
        raise ValueError(f"trees from histograms have no {extra}; use engine='mllib'")
    if binning == "exact":
        rows = H.kept_rows(df, list(features), label, split_col, exact=True)
    else:
        rows = H.kept_rows(df, list(features), label, split_col, bins, accuracy)
    try:
        rmse, refits = H.tune(rows, [defaults | pm for pm in param_maps], folds,
                              exact=binning == "exact", boosted=boosted, features=list(features))
    finally:
        rows.release()
    metrics = [float(np.mean(r)) for r in rmse]
    best = best_index(metrics)
    return TuningResult(param_maps, metrics, best, refits[best], rmse,
                        {"n_rows": rows.n, "passes": rows.passes})


# --------------------------------------------------------------------------
# generic MLlib estimators
# --------------------------------------------------------------------------

def _rmse_of(model, df: DataFrame, label: str) -> float:
    scored = model.transform(df)
    row = scored.agg(F.sqrt(F.avg(F.pow(F.col(label) - F.col(PREDICTION_COL), 2))).alias("r")).first()
    return float(row["r"])


def _shares_step_size(estimator, param_maps: list) -> bool:
    """True when boosted candidates differing only in stepSize share their trees.

    MLlib fits tree 0 on the label with weight 1 and tree 1 on the negative
    gradient at tree 0's prediction; neither depends on the learning rate,
    which only weights tree 1 (and later trees' inputs). So with at most two
    iterations and no early stopping, one fit per "all but stepSize" group
    serves every stepSize, scored from the individual trees.
    """
    if not isinstance(estimator, GBTRegressor) or len(param_maps) < 2:
        return False
    names = {p.name for pm in param_maps for p in pm}
    if "stepSize" not in names or "maxIter" in names:
        return False
    if estimator.isSet("validationIndicatorCol") and estimator.getValidationIndicatorCol():
        return False
    return estimator.getMaxIter() <= 2


def smallest_split_gain(model) -> float:
    """The least gain of any split of a fitted tree model (infinite without splits).

    A fit whose every split gains at least t is also the fit at ``minInfoGain=t``: a
    higher threshold only removes splits below it.
    """
    return from_mllib(model).smallest_gain()


def _boosted_rmse_by_step(model, df: DataFrame, label: str, steps: list[float]) -> list[float]:
    """Validation RMSE of tree_0 * w_0 + s * tree_1 for every s, in one pass."""
    trees, weights = model.trees, list(model.treeWeights)
    scored = df
    for i, t in enumerate(trees):
        scored = t.copy({t.predictionCol: f"_p{i}"}).transform(scored)
    base = sum((F.col(f"_p{i}") * F.lit(float(weights[i])) for i in range(len(trees) - 1)),
               F.lit(0.0))
    last = F.col(f"_p{len(trees) - 1}") if len(trees) > 1 else F.lit(0.0)
    if len(trees) == 1:
        base = F.col("_p0") * F.lit(float(weights[0]))
    aggs = [F.sqrt(F.avg(F.pow(F.col(label) - (base + F.lit(float(s)) * last), 2))).alias(f"r{j}")
            for j, s in enumerate(steps)]
    row = scored.agg(*aggs).first()
    return [float(row[f"r{j}"]) for j in range(len(steps))]


def tune_estimator(estimator, param_maps: list, df: DataFrame, *,
                   split_col: str, splits: list[tuple[list, object]],
                   label: str = LABEL_COL, parallelism: int = 4,
                   persist: bool = True) -> TuningResult:
    """Fit every (candidate, split) pair, average validation RMSE, refit the best.

    ``df`` must already hold the assembled ``features`` column and the
    ``split_col`` group column. With ``persist`` it is spread over the cores
    if it is smaller than that, persisted (memory, spilling to disk) and
    materialised once before the concurrent fits start, so no two fits
    compute the same partition; without, the caller has done so. Boosted
    candidates that differ only in ``stepSize`` share one fit when that is exact
    (see :func:`_shares_step_size`), and tree candidates that differ only in
    ``minInfoGain`` share the fit at the lowest value as far as its splits' gains
    prove that it is theirs too (see :func:`smallest_split_gain`).
    """
    param_maps = param_maps or [{}]
    cached, n_rows = keep(df) if persist else (df, None)
    try:
        share = _shares_step_size(estimator, param_maps)
        shared = {"stepSize"} if share else set()
        gains = None
        if isinstance(estimator, (DecisionTreeRegressor, GBTRegressor)):
            shared.add("minInfoGain")
            gain_param = estimator.getParam("minInfoGain")
            gains = [float(pm.get(gain_param, estimator.getMinInfoGain())) for pm in param_maps]
        groups: dict = {}
        for ci, pm in enumerate(param_maps):
            key = tuple(sorted((p.name, v) for p, v in pm.items() if p.name not in shared))
            groups.setdefault(key, []).append(ci)
        units = list(groups.values()) if shared else [[ci] for ci in range(len(param_maps))]
        fits: list = []
        jobs = [(ui, si) for ui in range(len(units)) for si in range(len(splits))]
        # a single candidate is the winner whatever the metrics: refit it
        # alongside the split fits instead of after them
        early_refit = len(param_maps) == 1
        if early_refit:
            jobs.append((-1, -1))
        refit: dict = {}

        def run(job):
            ui, si = job
            fits.append(job)
            if ui < 0:
                refit["model"] = estimator.fit(cached, param_maps[0])
                return []
            train_keys, val_key = splits[si]
            train = cached.filter(F.col(split_col).isin(list(train_keys)))
            val = cached.filter(F.col(split_col) == F.lit(val_key))
            out, pending = [], sorted(units[ui], key=lambda ci: gains[ci] if gains else 0)
            while pending:
                lowest = pending[0]
                model = estimator.fit(train, param_maps[lowest])
                served = [ci for ci in pending if not gains or gains[ci] == gains[lowest]]
                if len(served) < len(pending):
                    proven = smallest_split_gain(model)
                    served = [ci for ci in pending if gains[ci] <= max(proven, gains[lowest])]
                if share:
                    step_param = estimator.getParam("stepSize")
                    steps = [param_maps[ci].get(step_param, estimator.getStepSize())
                             for ci in served]
                    values = _boosted_rmse_by_step(model, val, label, steps)
                else:
                    values = [_rmse_of(model, val, label)] * len(served)
                out += [(ci, si, v) for ci, v in zip(served, values)]
                pending = [ci for ci in pending if ci not in served]
                if pending:
                    fits.append(job)
            return out

        per = np.zeros((len(param_maps), len(splits)))
        workers = max(1, min(parallelism, len(jobs)))
        if workers == 1:
            for out in map(run, jobs):
                for ci, si, value in out:
                    per[ci, si] = value
        else:
            pool = ThreadPool(processes=workers)
            try:
                target = inheritable_thread_target(cached.sparkSession)(run)
                for out in pool.imap_unordered(target, jobs):
                    for ci, si, value in out:
                        per[ci, si] = value
            finally:
                pool.close()
                pool.join()
        metrics = per.mean(axis=1).tolist()
        best = best_index(metrics)
        model = refit["model"] if early_refit else estimator.fit(cached, param_maps[best])
    finally:
        if persist:
            cached.unpersist()
    return TuningResult(grid_dicts(param_maps), metrics, best, model, per.tolist(),
                        {"n_rows": n_rows, "fits": len(fits) + (0 if early_refit else 1)})

