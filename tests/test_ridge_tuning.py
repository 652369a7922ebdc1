"""The fast tuning paths against plain MLlib (brute force) on small fixtures."""

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from lumenreg import config as C
from lumenreg.functions.keys import fold_of
from lumenreg.operators import models as M
from lumenreg.operators import ridge as R
from lumenreg.operators import tuning as T
from lumenreg.operators.prepare import prepare_features
from lumenreg.operators.split import hash_split, with_holdout
from lumenreg.sources.fixture import tpch_sales
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def train(spark):
    f = prepare_features(tpch_sales(spark, SF_SMALL), extra=["h"])
    tr, _ = hash_split(f)
    return M.assembler().transform(tr).cache()


@pytest.mark.parametrize("reg,std", [(0.3, True), (0.01, True), (0.0, True), (0.3, False)])
def test_closed_form_matches_mllib(spark, train, reg, std):
    mom = R.grouped_moments(train, None)[None]
    fit = R.fit_ridge(mom, reg, standardization=std)
    lr = M.linear(reg, 10, standardization=std).fit(train)
    np.testing.assert_allclose(fit.coefficients, np.array(lr.coefficients), rtol=1e-6, atol=1e-9)
    assert fit.intercept == pytest.approx(lr.intercept, rel=1e-7)
    # prediction expression equals MLlib scoring
    both = lr.transform(fit.transform(train, output_col="a")).withColumnRenamed("prediction", "b")
    worst, scale = both.agg(F.max(F.abs(F.col("a") - F.col("b"))),
                            F.max(F.abs(F.col("b")))).first()
    assert worst < 1e-7 * scale


def test_moment_merge_is_exact(spark, train):
    by_fold = R.grouped_moments(train.withColumn("g", fold_of(4, "h")), "g")
    whole = R.grouped_moments(train, None)[None]
    merged = R.Moments.combine(by_fold.values())
    assert merged.n == whole.n
    np.testing.assert_allclose(merged.mean, whole.mean, rtol=1e-12)
    np.testing.assert_allclose(merged.comom, whole.comom, rtol=1e-9)


def test_group_sse_equals_direct(spark, train):
    mom = R.grouped_moments(train, None)[None]
    fit = R.fit_ridge(mom, 0.1)
    direct = fit.transform(train).agg(
        F.sum(F.pow(F.col("label") - F.col("prediction"), 2))).first()[0]
    assert R.group_sse(mom, fit) == pytest.approx(direct, rel=1e-8)


def test_one_pass_cv_matches_crossvalidator(spark, train):
    k = 4
    data = train.withColumn("fold", fold_of(k, "h"))
    lr = M.linear()
    grid = T.build_grid(lr, C.LR_GRID)
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=RegressionEvaluator(),
                        numFolds=k, foldCol="fold").fit(data)
    ours = T.tune_ridge(data, T.grid_dicts(grid), group_col="fold", splits=T.kfold_splits(k),
                        refit_keys=list(range(k)))
    np.testing.assert_allclose(ours.metrics, cv.avgMetrics, rtol=1e-7)
    assert ours.best == int(np.argmin(cv.avgMetrics))
    # duplicates in maxIter resolve to the first candidate
    assert ours.metrics[0] == ours.metrics[1]
    best_lr = cv.bestModel
    np.testing.assert_allclose(ours.model.coefficients, np.array(best_lr.coefficients), rtol=1e-6)


def test_one_pass_tvs_matches_own_loop(spark, train):
    data = with_holdout(train, 0.8).withColumn("g", F.col("is_validation").cast("int"))
    regs = [0.3, 0.1, 0.01]
    ours = T.tune_ridge(data, [{"regParam": r} for r in regs], group_col="g",
                        splits=[([0], 1)], refit_keys=[0, 1])
    fit_rows, val_rows = data.filter("g = 0"), data.filter("g = 1")
    ev = RegressionEvaluator()
    brute = [ev.evaluate(M.linear(r).fit(fit_rows).transform(val_rows)) for r in regs]
    np.testing.assert_allclose(ours.metrics, brute, rtol=1e-7)


def test_tree_tuning_matches_crossvalidator(spark, train):
    k = 3
    data = train.withColumn("fold", fold_of(k, "h"))
    est = M.tree(max_bins=64)
    grid = ParamGridBuilder().addGrid(est.maxDepth, [1, 3]).build()
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=RegressionEvaluator(),
                        numFolds=k, foldCol="fold").fit(data)
    ours = T.tune_estimator(est, grid, data, split_col="fold", splits=T.kfold_splits(k),
                            parallelism=4)
    np.testing.assert_allclose(ours.metrics, cv.avgMetrics, rtol=1e-9)
    assert ours.best == int(np.argmin(cv.avgMetrics))
    assert ours.extra["n_rows"] == data.count()


def test_shared_boosted_trees_match_separate_fits(spark, train):
    data = with_holdout(train, 0.8).withColumn("g", F.col("is_validation").cast("int"))
    est = M.boosted(max_bins=128)
    grid = (ParamGridBuilder().addGrid(est.maxDepth, [1, 2])
            .addGrid(est.stepSize, [0.1, 0.4]).build())
    assert T._shares_step_size(est, grid)
    ours = T.tune_estimator(est, grid, data, split_col="g", splits=[([0], 1)], parallelism=2)
    assert ours.extra["fits"] == 3  # two shared fits + refit, not four + refit
    fit_rows, val_rows = data.filter("g = 0"), data.filter("g = 1")
    ev = RegressionEvaluator()
    brute = [ev.evaluate(est.fit(fit_rows, pm).transform(val_rows)) for pm in grid]
    np.testing.assert_allclose(ours.metrics, brute, rtol=1e-9)
    # more than two iterations: no sharing (later trees depend on the step)
    assert not T._shares_step_size(M.boosted(max_iter=3), grid)


def test_min_info_gain_shares_only_what_is_proven(spark, train):
    data = with_holdout(train, 0.8).withColumn("g", F.col("is_validation").cast("int"))
    est = M.boosted(max_bins=128)
    deep = est.fit(data.filter("g = 0"), {est.maxDepth: 3})
    least = T.smallest_split_gain(deep)
    # two thresholds below every split's gain, one that cuts some off
    grid = T.build_grid(est, {"maxDepth": [3], "minInfoGain": [0.0, least / 2, least * 50],
                              "stepSize": [0.1, 0.4]})
    ours = T.tune_estimator(est, grid, data, split_col="g", splits=[([0], 1)], parallelism=2)
    assert ours.extra["fits"] == 3  # the lowest, the highest, the refit
    ev = RegressionEvaluator()
    brute = [ev.evaluate(est.fit(data.filter("g = 0"), pm).transform(data.filter("g = 1")))
             for pm in grid]
    np.testing.assert_allclose(ours.metrics, brute, rtol=1e-9)
    assert brute[0] != brute[-2]
    tree = M.tree(max_bins=128, max_depth=1).fit(data)
    assert T.smallest_split_gain(tree) > 0


def test_nan_fails_naming_the_column(spark):
    from lumenreg.plans import workflows as W

    rows = tpch_sales(spark, SF_SMALL)
    for part in ("h % 10 < 7", "h % 10 >= 7"):  # training (or validation) and test rows
        first = rows.filter(part).agg(F.min("h")).first()[0]
        bad = rows.withColumn("StateBottleCost", F.when(F.col("h") == first, float("nan"))
                              .otherwise(F.col("StateBottleCost")))
        for workflow in (W.linear_cv, W.linear_tvs, W.linear_cv_tvs):
            with pytest.raises(ValueError, match="NaN.*StateBottleCost"):
                workflow(spark, bad)


@pytest.mark.parametrize("fraction", [0.75, 0.04])
def test_workflows_honour_the_fraction(spark, fraction):
    from lumenreg.plans import workflows as W

    rows = tpch_sales(spark, SF_SMALL)
    small = {"grid": {"maxDepth": [1], "stepSize": [0.1]}, "max_bins": 64}
    for run in (lambda f: W.linear_cv(spark, rows, k=3, train_fraction=f),
                lambda f: W.linear_tvs(spark, rows, train_fraction=f),
                lambda f: W.tree_cv(spark, rows, k=2, max_depth=1, max_bins=64, train_fraction=f),
                lambda f: W.gbt_tvs(spark, rows, train_fraction=f, **small)):
        res = run(fraction)
        assert abs(res.n_train / (res.n_train + res.n_test) - fraction) < 0.02
        with pytest.raises(ValueError):
            run(1.0)


def test_candidates_frame(spark):
    res = T.TuningResult([{"regParam": 0.3}, {"regParam": 0.1}], [2.0, 1.0], 1)
    rows = res.candidates(spark).orderBy("candidate").collect()
    assert [r.is_best for r in rows] == [False, True]
    assert T.best_index([1.0, 1.0, 0.5, 0.5]) == 2
    # last-bit differences between identical models do not decide the winner
    assert T.best_index([2.0, 1.0 + 1e-15, 1.0, 3.0]) == 1
    assert T.best_index([2.0, 1.0 + 1e-9, 1.0]) == 2
    assert T.best_index([0.2, 0.9, 0.9], larger_is_better=True) == 1


def test_singular_and_constant_inputs(spark):
    rows = [(float(i), 2.0 * i, 1.0, 3.0 * i + 1.0) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double, c double, label double")
    mom = R.grouped_moments(df, None, ["a", "b", "c"], "label")[None]
    fit = R.fit_ridge(mom, 0.0, features=["a", "b", "c"])  # a, b collinear; c constant
    assert fit.coefficients[2] == 0.0
    pred = fit.transform(df).agg(F.max(F.abs(F.col("prediction") - F.col("label")))).first()[0]
    assert pred < 1e-6
    with pytest.raises(ValueError, match="no rows"):
        T.tune_ridge(df.withColumn("g", F.lit(0)), [{"regParam": 0.1}], group_col="g",
                     splits=[([0], 1)], refit_keys=[0], features=["a", "b", "c"])
