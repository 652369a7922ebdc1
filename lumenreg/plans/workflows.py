"""The four sales-regression workflows as Spark plans.

Each takes sales rows (any source), a key hash column (or key columns to
derive it) and returns a :class:`WorkflowResult` whose tables are DataFrames:
predictions (also published as a SQL view), the tuning candidates and a
one-row report. Splits are hash splits of the row key by default, so every run,
engine and retry sees the same rows; any train fraction in steps of 0.0001 is
honoured, others are refused.

* W1 ``linear_cv``  — ridge, 10-fold CV over the regParam x maxIter grid.
* W2 ``linear_tvs`` — ridge, 80/20 train/validation cut, same grid.
* W3 ``tree_cv``    — decision tree (maxBins 77582), 5-fold CV, empty grid.
* W4 ``gbt_tvs``    — boosted trees (2 iterations), 80/20 cut, 32 candidates.

W1/W2 run as **one** aggregation pass (grouped moments, see ``operators.ridge``):
folds, validation cut and test rows are groups of one ``groupBy``. W3/W4 grow the trees
of all folds, candidates and the refit together from histograms of the kept rows (see
``operators.histogram_trees``), or fit MLlib trees on request.

The test rows are scored once, by a column expression, and written to the shared
scratch; the published view reads what was written, and the test RMSE is observed while
it is written. ``WorkflowResult.release`` drops view and files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenreg import config as C
from lumenreg.operators import evaluate as E
from lumenreg.operators import models as M
from lumenreg.operators import tuning as T
from lumenreg.operators.binning import BINNING, BINS, plain_bins, quantile_bins
from lumenreg.operators.partitioning import keep, merged
from lumenreg.operators.prepare import prepare_features
from lumenreg.operators.ridge import Moments, grouped_moments
from lumenreg.operators.split import (TEST_FLAG, rename_label, with_folds, with_holdout,
                                      with_key_hash, with_random_flag, with_test_flag)
from lumenreg.session import remove_scratch

TEST_GROUP = -1
ENGINES = ("histogram", "mllib")


@dataclass
class WorkflowResult:
    name: str
    tuning: T.TuningResult
    predictions: DataFrame
    view: str
    test_rmse: float
    n_train: int
    n_test: int
    model: object = None
    path: str | None = None

    def release(self) -> None:
        """Drop the published view and the files behind it."""
        spark = self.predictions.sparkSession
        spark.catalog.dropTempView(self.view)
        if self.path:
            remove_scratch(spark, self.path)
            self.path = None

    def report(self, spark: SparkSession) -> DataFrame:
        best = self.tuning.param_maps[self.tuning.best] if self.tuning.param_maps else {}
        row = (self.name, self.n_train, self.n_test,
               ", ".join(f"{k}={v}" for k, v in best.items()),
               float(self.tuning.metrics[self.tuning.best]), float(self.test_rmse))
        return spark.createDataFrame(
            [row], "workflow string, n_train long, n_test long, best_params string, "
                   "tuning_rmse double, test_rmse double")


def feature_rows(rows: DataFrame, key_cols: list[str] | None = None, h: str = "h",
                 hash_method: str = "md5") -> DataFrame:
    """Clean sales rows -> feature rows carrying the key hash."""
    if h not in rows.columns:
        if not key_cols:
            raise ValueError("rows have no hash column; pass key_cols to derive it")
        rows = with_key_hash(rows, key_cols, h, hash_method)
    return prepare_features(rows, extra=[h])


def flag_test_rows(features: DataFrame, train_fraction: float, h: str, split: str = "hash",
                   seed: int = 42) -> DataFrame:
    """Rows with ``TEST_FLAG``: by the key hash, or by one seeded random number each.

    Both depend on the row's key alone, so rows can be computed again at any time.
    """
    if split == "hash":
        return with_test_flag(features, train_fraction, h)
    if split == "random":
        return with_random_flag(features, train_fraction, seed, key_cols=[h])
    raise ValueError(f"split must be 'hash' or 'random', got {split!r}")


def _grouped(feats, group, h, train_fraction, split, seed):
    """(rows with ``_grp``, test rows).

    ``_grp`` is ``group`` for training rows and TEST_GROUP for test rows: one scan,
    the test rows are just another group of the aggregation.
    """
    flagged = flag_test_rows(feats, train_fraction, h, split, seed)
    with_group = flagged.withColumn(
        "_grp", F.when(F.col(TEST_FLAG), F.lit(TEST_GROUP)).otherwise(group))
    return with_group, flagged.filter(TEST_FLAG).drop(TEST_FLAG)


def _published(name, tuning, scored, view, n_train, model) -> WorkflowResult:
    pred, path, n_test, rmse = E.publish_durable(E.predictions(scored), view)
    return WorkflowResult(name, tuning, pred, view, rmse, n_train, n_test, model, path)


def _ridge_workflow(spark, name, grouped, splits, refit_keys, grid, view, moments=None):
    with_group, test = grouped
    est = M.linear()
    param_maps = T.grid_dicts(T.build_grid(est, grid))
    res = T.tune_ridge(with_group, param_maps, group_col="_grp", splits=splits,
                       refit_keys=refit_keys, default_reg=C.LR_REG_PARAM, moments=moments)
    moments = res.extra["moments"]
    n_train = int(sum(moments[k].n for k in refit_keys if k in moments))
    scored = res.model.transform(M.assembler().transform(rename_label(test)))
    return _published(name, res, scored, view, n_train, res.model)


def linear_cv(spark: SparkSession, rows: DataFrame, *, k: int = C.LR_CV_FOLDS,
              grid: dict | None = None, key_cols=None, h: str = "h",
              train_fraction: float = C.TRAIN_TEST_WEIGHTS[0], split: str = "hash",
              seed: int = 42, hash_method: str = "md5") -> WorkflowResult:
    """W1: ridge regression tuned by k-fold cross-validation (one pass)."""
    feats = with_folds(feature_rows(rows, key_cols, h, hash_method), k, h, "_fold")
    grouped = _grouped(feats, F.col("_fold"), h, train_fraction, split, seed)
    return _ridge_workflow(spark, "linear_cv", grouped, T.kfold_splits(k), list(range(k)),
                           grid or C.LR_GRID, C.VIEW_NAMES["lr_cv"])


def linear_tvs(spark: SparkSession, rows: DataFrame, *, train_ratio: float = C.TVS_TRAIN_RATIO,
               grid: dict | None = None, key_cols=None, h: str = "h",
               train_fraction: float = C.TRAIN_TEST_WEIGHTS[0], split: str = "hash",
               seed: int = 42, hash_method: str = "md5") -> WorkflowResult:
    """W2: ridge regression tuned on a held-out validation cut (one pass)."""
    feats = with_holdout(feature_rows(rows, key_cols, h, hash_method), train_ratio, h, "_val")
    grouped = _grouped(feats, F.col("_val").cast("int"), h, train_fraction, split, seed)
    return _ridge_workflow(spark, "linear_tvs", grouped, [([0], 1)], [0, 1],
                           grid or C.LR_GRID, C.VIEW_NAMES["lr_tvs"])


def linear_cv_tvs(spark: SparkSession, rows: DataFrame, *, k: int = C.LR_CV_FOLDS,
                  train_ratio: float = C.TVS_TRAIN_RATIO, grid: dict | None = None,
                  key_cols=None, h: str = "h", train_fraction: float = C.TRAIN_TEST_WEIGHTS[0],
                  split: str = "hash", seed: int = 42, hash_method: str = "md5"):
    """W1 and W2 together from ONE scan: returns ``(cv_result, tvs_result)``.

    Rows are grouped by (fold, validation flag) plus the test group — 2k + 1
    groups. W1's fold f sums the two flags of fold f; W2's fit / validation
    parts sum the folds of each flag. Both results equal separate runs.
    """
    feats = with_folds(feature_rows(rows, key_cols, h, hash_method), k, h, "_fold")
    feats = with_holdout(feats, train_ratio, h, "_val")
    group = F.col("_fold") * 2 + F.col("_val").cast("int")
    grouped = _grouped(feats, group, h, train_fraction, split, seed)
    cells = grouped_moments(grouped[0], "_grp")
    combine = Moments.combine
    cv_moments = {f: combine(cells[c] for c in (2 * f, 2 * f + 1) if c in cells)
                  for f in range(k)}
    tvs_moments = {flag: combine(cells[2 * f + flag] for f in range(k) if 2 * f + flag in cells)
                   for flag in (0, 1)}
    for m in (cv_moments, tvs_moments):
        if TEST_GROUP in cells:
            m[TEST_GROUP] = cells[TEST_GROUP]
    grid = grid or C.LR_GRID
    cv = _ridge_workflow(spark, "linear_cv", grouped, T.kfold_splits(k), list(range(k)), grid,
                         C.VIEW_NAMES["lr_cv"], moments=cv_moments)
    tvs = _ridge_workflow(spark, "linear_tvs", grouped, [([0], 1)], [0, 1], grid,
                          C.VIEW_NAMES["lr_tvs"], moments=tvs_moments)
    return cv, tvs


def tree_rows(feats: DataFrame, split_col: str, binning: str = "exact", bins: int = BINS):
    """(rows to cache, scoring stages before the tree) from flagged feature rows.

    A row is its feature vector, label, fold or cut and test flag, nothing more.
    """
    inputs, stages = list(C.FEATURE_COLS), []
    if binning == "quantile":
        bucketizer = quantile_bins(feats.filter(~F.col(TEST_FLAG)), inputs, bins)
        stages, inputs = [bucketizer], bucketizer.getOutputCols()
        feats = plain_bins(bucketizer.transform(feats), bucketizer)
    elif binning != "exact":
        raise ValueError(f"binning must be one of {BINNING}, got {binning!r}")
    stages.append(M.assembler(inputs))
    return stages[-1].transform(feats).select(C.FEATURES_COL, C.LABEL_COL, split_col,
                                              TEST_FLAG), stages


def _engine(engine: str | None, max_bins: int | None) -> str:
    """MLlib if it is asked for, or if a number of its bins is."""
    engine = engine or ("histogram" if max_bins is None else "mllib")
    if engine not in ENGINES:
        raise ValueError(f"engine must be one of {ENGINES}, got {engine!r}")
    if engine == "histogram" and max_bins is not None:
        raise ValueError("max_bins belongs to engine='mllib'; ranges are set by bins")
    return engine


def _tree_workflow(spark, name, feats, estimator, param_maps, split_col, splits, view,
                   parallelism, storage, binning, bins, partitions, engine, accuracy):
    if binning not in BINNING:
        raise ValueError(f"binning must be one of {BINNING}, got {binning!r}")
    # training AND test rows go through one scan and are kept together (flagged), so
    # the source is read once for tuning, refit and scoring
    if engine == "histogram":
        rows = feats.select(*C.FEATURE_COLS, C.LABEL_COL, split_col, TEST_FLAG)
    else:
        rows, stages = tree_rows(feats, split_col, binning, bins)
    kept, n = keep(rows, partitions, storage=storage)
    try:
        train, test = kept.filter(~F.col(TEST_FLAG)), rename_label(kept.filter(TEST_FLAG))
        if engine == "histogram":
            boosted = hasattr(estimator, "getStepSize")
            defaults = {"maxDepth": estimator.getMaxDepth(), "minInfoGain": estimator.getMinInfoGain(),
                        "maxIter": estimator.getMaxIter() if boosted else 1,
                        "stepSize": estimator.getStepSize() if boosted else 1.0}
            res = T.tune_trees(train, T.grid_dicts(param_maps), defaults, split_col=split_col,
                               folds=[out for _, out in splits], boosted=boosted, binning=binning,
                               bins=bins, accuracy=accuracy)
            scored = res.model.transform(M.assembler().transform(test))
            model = res.model  # an expression over the raw columns
        else:
            res = T.tune_estimator(estimator, param_maps, merged(train, n), split_col=split_col,
                                   splits=splits, parallelism=parallelism, persist=False)
            scored = res.model.transform(test)
            model = PipelineModel(stages=[*stages, res.model])  # scores raw sales rows
        out = _published(name, res, scored, view, 0, model)
    finally:
        kept.unpersist()
    out.n_train = n - out.n_test
    return out


def tree_cv(spark: SparkSession, rows: DataFrame, *, k: int = C.TREE_CV_FOLDS,
            max_depth: int = 5, max_bins: int | None = None, grid: dict | None = None,
            key_cols=None, h: str = "h", parallelism: int = 4, seed: int = 1,
            train_fraction: float = C.TRAIN_TEST_WEIGHTS[0], split: str = "hash",
            split_seed: int = 42, storage: str = "cache", binning: str = "exact",
            bins: int = BINS, partitions: int | None = None, hash_method: str = "md5",
            engine: str | None = None, accuracy: int | None = None) -> WorkflowResult:
    """W3: decision-tree regression tuned by k-fold cross-validation.

    ``binning="quantile"`` splits between ``bins`` equal-frequency ranges of each feature
    (cut points to within n / ``accuracy`` ranks), ``"exact"`` between any two values.
    ``engine="mllib"`` (or a number of ``max_bins``) fits MLlib's trees instead;
    ``partitions`` is the partition count of the kept rows.
    """
    engine = _engine(engine, max_bins)
    feats = with_folds(feature_rows(rows, key_cols, h, hash_method), k, h, "fold")
    feats = flag_test_rows(feats, train_fraction, h, split, split_seed)
    est = M.tree(max_bins=max_bins or C.TREE_MAX_BINS, max_depth=max_depth, seed=seed)
    return _tree_workflow(spark, "tree_cv", feats, est, T.build_grid(est, grid), "fold",
                          T.kfold_splits(k), C.VIEW_NAMES["dt_cv"], parallelism, storage,
                          binning, bins, partitions, engine, accuracy)


def gbt_tvs(spark: SparkSession, rows: DataFrame, *, train_ratio: float = C.TVS_TRAIN_RATIO,
            max_bins: int | None = None, max_iter: int = C.GBT_MAX_ITER,
            grid: dict | None = None, key_cols=None, h: str = "h", parallelism: int = 4,
            seed: int = 1, train_fraction: float = C.TRAIN_TEST_WEIGHTS[0],
            split: str = "hash", split_seed: int = 42, storage: str = "cache",
            binning: str = "exact", bins: int = BINS, partitions: int | None = None,
            hash_method: str = "md5", engine: str | None = None,
            accuracy: int | None = None) -> WorkflowResult:
    """W4: gradient-boosted-tree regression tuned on a held-out validation cut."""
    engine = _engine(engine, max_bins)
    feats = with_holdout(feature_rows(rows, key_cols, h, hash_method), train_ratio, h,
                         "is_validation")
    feats = flag_test_rows(feats.withColumn("is_validation", F.col("is_validation").cast("int")),
                           train_fraction, h, split, split_seed)
    est = M.boosted(max_bins=max_bins or C.TREE_MAX_BINS, max_iter=max_iter, seed=seed)
    return _tree_workflow(spark, "gbt_tvs", feats, est,
                          T.build_grid(est, C.GBT_GRID if grid is None else grid),
                          "is_validation", [([0], 1)], C.VIEW_NAMES["gbt_tvs"], parallelism,
                          storage, binning, bins, partitions, engine, accuracy)
